import re

import odd_documents as odd
import pytest
from pyspark.sql import functions as F

from parcelflow.llm import pii

MENTIONS = [
    ("bob.42@mail8.example.com", "email"),
    ("Anna_Lee+x@sub.Example.ORG", "email"),
    ("42.144.35.254", "ip"),
    ("4111 1111 1111 1111", "card"),
    ("4041894974608795", "card"),
    ("+1 (499) 555-6503", "phone"),
    ("(499) 555-6503", "phone"),
    ("+49 30 1234 5678", "phone"),
    ("Mr. John Smith", "name"),
    ("Mrs Jane Smith", "name"),
    ("Herr MÜLLER", "name"),
    ("Señora María García-López", "name"),
    ("г-жа Иванова", "name"),
    ("κύριος Παπαδόπουλος", "name"),
]
CLEAN = [
    "version 2.0. of 1.2.3 in 2024-05-06, 300.1.2.3, 1.2.3.4.5 and 12345678901",
    "a@b, user@host, @handle, x@y.z1",
    "The mr smith, Mister, Frau.",
    "sha 0b79f3c1e4041894974608795aa, id=ab4041894974608795",
    "",
]


def hidden(spark, texts, secret="k"):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    return [r.text for r in pii.hidden_documents(docs, secret).orderBy("doc_id").collect()]


def form(text):
    return re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", text)))


def test_mentions_are_found_and_typed(spark):
    rows = [(i, f"x {m} y.\n{m}, z") for i, (m, _) in enumerate(MENTIONS)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for r in pii.hidden_documents(docs).collect():
        mention, kind = MENTIONS[r.doc_id]
        assert mention not in r.text, mention
        assert [r[f"n_{k}"] for k in pii.KINDS] == [2 * (k == kind) for k in pii.KINDS], mention
        first, second = re.fullmatch(r"x (.*) y\.\n(.*), z", r.text).groups()
        assert first == second  # one surrogate for one mention
        if kind != "name":
            assert form(first) == form(mention)


def test_clean_texts_stay(spark):
    assert hidden(spark, CLEAN) == CLEAN


def luhn(digits):
    return sum(sum(divmod(int(d) * (2 if k % 2 else 1), 10)) for k, d in enumerate(reversed(digits))) % 10 == 0


def test_numbers_stay_valid(spark):
    got = hidden(spark, ["4111111111111111", "4111111111111112", "200.30.4.255", "378282246310005"])
    assert luhn(got[0]) and not luhn(got[1]) and luhn(got[3]) and got[0][0] == "4"
    assert [len(o) for o in got[2].split(".")] == [3, 2, 1, 3]
    assert all(0 <= int(o) <= 255 for o in got[2].split("."))


def test_one_person_however_written(spark):
    got = hidden(
        spark,
        ["Bob@Example.com", "bob@example.com", "+1 (499) 555-6503", "+1 499.555.6503", "Mr. John Smith", "Mrs Smith", "Mr John SMITH"],
    )
    assert got[0].lower() == got[1] and got[0][0].isupper()
    digits = [re.sub(r"\D", "", g) for g in got[2:4]]
    assert digits[0] == digits[1]
    assert got[4].split()[-1] == got[5].split()[-1] == got[6].split()[-1].capitalize()
    assert got[4].split()[1] == got[6].split()[1]


def test_gender_and_script(spark):
    got = hidden(spark, ["Mr John Smith", "Mrs John Smith", "г-жа Анна Иванова", "г-н Иван Петров", "κυρία Μαρία"])
    assert got[0].split()[1][-1] in "nrsl" and got[1].split()[1][-1] == "a"
    assert got[2].split()[1][-1] == "а" and got[3].split()[1][-1] in "нрмл"
    assert re.fullmatch("[а-яА-Я -]+", got[2]) and re.search("[α-ω]", got[4].split()[1])


def test_the_key_decides(spark):
    assert hidden(spark, ["a.b@example.com"], "k1") != hidden(spark, ["a.b@example.com"], "k2")
    assert hidden(spark, ["a.b@example.com"], "k1") == hidden(spark, ["a.b@example.com"], "k1")


def test_no_two_keys_share_a_surrogate(spark):
    """Half of all addresses of a small form are taken, so most draws collide at first."""
    keys = spark.range(10, 55).select(F.concat(F.lit("ip:1.1.1."), F.col("id").cast("string")).alias("key"))
    small = pii.surrogates(keys, "k").collect()
    assert len({r.surrogate for r in small}) == len(small) == 45
    assert not {r.surrogate for r in small} & {r.key[3:] for r in small}


def test_too_few_surrogates_are_an_error(spark, monkeypatch):
    """All ten numbers of a form are somebody's."""
    monkeypatch.setattr(pii, "MOST_DRAWS", 3)
    keys = spark.range(10).select(F.concat(F.lit("phone:1"), F.col("id").cast("string")).alias("key"))
    with pytest.raises(ValueError):
        pii.surrogates(keys, "k")


def test_more_first_names_than_short_ones(spark):
    """1,280 surrogates of two syllables."""
    names = F.concat(F.lit("f:"), F.translate(F.lpad(F.col("id").cast("string"), 4, "0"), "0123456789", "bcdfghijkl"))
    got = pii.surrogates(spark.range(2000).select(names.alias("key")), "k").collect()
    assert len(got) == len({r.surrogate for r in got}) == 2000
    assert all(r.surrogate.endswith("a") for r in got)


def test_a_form_that_is_used_up_gets_wider(spark, monkeypatch):
    monkeypatch.setattr(pii, "SAME_FORM", 2)
    ids = spark.range(10)
    value = F.col("id").cast("string")
    keys = ids.select(F.concat(F.lit("phone:1"), value).alias("key")).unionAll(
        ids.select(F.concat(value, F.lit("@_.zz")).alias("key")).select(F.concat(F.lit("email:"), "key").alias("key"))
    )
    got = {r.key: r.surrogate for r in pii.surrogates(keys, "k").collect()}
    assert len(got) == 20 and len(set(got.values())) == 20
    assert not {k.split(":")[1] for k in got} & set(got.values())


def test_wider_surrogates_are_written_whole(spark):
    rows = [("A.b@Mail.com", "xya.c@mail.com"), ("+1 (499) 555-6503", "+1234567890199"), ("4111 1111 1111 1111", "42222222222222229")]
    df = spark.createDataFrame(rows, "mention string, surrogate string")
    maps = F.create_map(F.element_at(pii.keys_of(F.col("mention")), 1), "surrogate")
    got = [r[0] for r in df.select(pii.rendered(F.col("mention"), maps)).collect()]
    assert got == ["xyA.c@Mail.com", "+1 (234) 567-890199", "4222 2222 2222 22229"]


def test_odd_documents(spark):
    rows = [*odd.ROWS, (30, None), (31, "a.b@example.com " * 2000), (31, "a.b@example.com " * 2000)]
    docs = odd.documents(spark, rows)
    got = pii.hide(docs)
    assert got.schema.names == docs.schema.names
    assert odd.rows_of(got.where("doc_id IS NULL OR doc_id != 31"), "doc_id", "text") == odd.rows_of(
        docs.where("doc_id IS NULL OR doc_id != 31"), "doc_id", "text"
    )
    many = [r.text.split() for r in got.where("doc_id = 31").collect()]
    assert len(many) == 2 and all(len(m) == 2000 and len(set(m)) == 1 for m in many) and many[0] == many[1]
    assert pii.hide(odd.empty(spark)).count() == 0
    assert pii.hidden_documents(docs).count() == len(rows)


def test_main_path_has_no_python(spark):
    plan = pii.hide(odd.documents(spark, [(1, "a.b@example.com")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("text", ["1" * 60_000, "a" * 60_000 + "@", "a." * 30_000 + "@", "1.2." * 20_000, "+1 " * 20_000])
def test_long_runs_take_linear_time(spark, text):
    assert hidden(spark, [text]) == [text]


def test_bare_names_follow_titled_ones(spark):
    texts = [
        "Mr Oleg Petrov came. Petrov said hello. Oleg's car; PETROV! Petrovsky stayed, so did petrov.",
        "Prof. Dr. Jane O'Brien and O'Brien's aunt, Frau Dr. Anna Roe. Jane, Roe.",
        "Petrov has no form of address here.",
        "Mr J Smith. J is a letter, smith is a trade.",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = pii.hidden_documents(docs, "k").orderBy("doc_id").collect()
    first, last = rows[0].text.split()[1], rows[0].text.split()[2].rstrip(".")
    assert rows[0].text == (
        f"Mr {first} {last} came. {last} said hello. {first}'s car; {last.upper()}! Petrovsky stayed, so did petrov."
    )
    found = re.fullmatch(r"Prof\. Dr\. (\w+) (\w+) and (\w+)'s aunt, Frau Dr\. (\w+) (\w+)\. (\w+), (\w+)\.", rows[1].text)
    jane, obrien, aunt, anna, roe, bare, end = found.groups()
    assert obrien == aunt and jane == bare and roe == end and jane[-1] in "ei" and anna[-1] == "a"
    assert rows[2].text == texts[2]
    assert rows[3].text.endswith(". J is a letter, smith is a trade.") and "Smith" not in rows[3].text
    assert [r.n_bare for r in rows] == [3, 3, 0, 0] and [r.n_name for r in rows] == [1, 2, 0, 1]


def plain_names(text, surrogate_of):
    """Names by one loop over the text, surrogates from a dictionary."""
    case = lambda p, s: s.upper() if len(p) > 1 and p == p.upper() else s.capitalize()
    sex = dict.fromkeys(pii.FEMALE, "f") | dict.fromkeys(pii.MALE, "m")
    titles = sorted([*pii.MALE, *pii.FEMALE, *pii.EITHER], key=len, reverse=True)
    word = r"[^\W\d_]+"
    name = re.compile(rf"(?<!\w)((?:(?:{'|'.join(titles)})\.? )+)({word}(?:[ -]{word})*)")
    out, known, at = [], {}, 0
    for m in name.finditer(text):
        parts = []
        for p in re.findall(word, m[2])[:3]:
            if not p[0].isupper():
                break
            parts.append(p)
        kind = next((sex[t] for t in re.findall(r"[\w-]+", m[1]) if t in sex), "n")
        keys = [f"{kind}:{p.lower()}" for p in parts[:-1]] + [f"s:{parts[-1].lower()}"]
        end = m.start(2) + len(" ".join(parts))
        out += [(text[at : m.start()], False), (m[1], True)]
        out.append((re.sub(word, lambda w, it=iter(keys): case(w[0], surrogate_of[next(it)]), text[m.start(2) : end]), True))
        at = end
        for key in keys:
            if key[0] == "s" or key[2:] not in known:
                known[key[2:]] = surrogate_of[key]
    out.append((text[at:], False))
    bare = lambda w: case(w[0], known[w[0].lower()]) if w[0][0].isupper() and len(w[0]) > 1 and w[0].lower() in known else w[0]
    return "".join(t if done else re.sub(word, bare, t) for t, done in out)


def test_planted_names_against_a_plain_version(spark):
    firsts, lasts = ["Oleg", "Jane", "Иван", "Μαρία", "Ana-Lena", "WILL"], ["Petrov", "Roe", "Иванов", "Δήμου", "Stone"]
    titles = ["Mr", "Mrs.", "Dr", "Prof. Dr.", "Frau Dr.", "г-н", "κυρία"]
    texts = []
    for k in range(210):
        a, b, t = firsts[k % 6], lasts[k % 5], titles[k % 7]
        other = lasts[(k + 1) % 5]
        texts.append(
            f"stone {b} and {other}, {t} {a} {b}; then {b.upper()} left {a}. {titles[(k + 3) % 7]} {other}\n{other}, xx{b} {b}x."
        )
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    mentions = F.regexp_extract_all("text", F.lit(pii.PATTERN), F.lit(0))
    keys = docs.select(F.explode(F.flatten(F.transform(mentions, pii.keys_of))).alias("key")).distinct()
    of_key = {r.key: r.surrogate for r in pii.surrogates(keys, "k").collect()}
    got = {r.doc_id: r for r in pii.hidden_documents(docs, "k").collect()}
    assert {i: r.text for i, r in got.items()} == {i: plain_names(t, of_key) for i, t in enumerate(texts)}
    assert all(r.n_bare >= 3 for r in got.values())


def test_draws_are_spread(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("email:u"), "id", F.lit("@x.org")).alias("key"))
    assert pii._tasks(keys.limit(100)) == 1
    assert pii._tasks(keys) == min(spark.sparkContext.defaultParallelism, 40)
    got = pii.surrogates(keys, "k")
    assert got.count() == 20_000 == got.select("surrogate").distinct().count()
