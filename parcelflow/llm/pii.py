"""Personal data replaced by surrogates, with DataFrame functions only.

Mentions of addresses, numbers and names become keyed replacements of the same type: letters and digits
stand where letters and digits stood, octets and check digits stay valid, names keep their gender's ending
and their script. A mention is reduced to a canonical key first (an address in lower case, the digits of a
number, the single parts of a name), so that one person or number has one surrogate however it is written.

A name is found behind its forms of address. In the same text its parts are then mentions wherever they stand as
capitalised words of two letters or more ("Mr Oleg Petrov came. Petrov said ..."), an ordinary word of the same
letters too. Forms of address without gender give first names that suit either, so a first name behind "Dr" and
the same one behind "Mr" are different keys; the family name is one key.

All keys of the corpus meet in one table. There a candidate is refused when it equals another key's
surrogate or any real key of its type; refused keys draw again until none is left. So different keys have
different surrogates, and no surrogate is somebody else's data. Every text meets the forms once, and only texts
that hold a mention are shuffled.

Names get longer from draw to draw. The other types keep the form of the key for ``SAME_FORM`` draws; keys still
left then draw from a wider form, so that a form that is used up ends no job: an address with letters in front,
a number with digits behind, one more in each draw, and any octets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import saved, texts, whole_row

EMAIL, IP, CARD, PHONE, NAME = KINDS = ("email", "ip", "card", "phone", "name")
KEY = "surrogates"
#: Draws after which a type is taken to have no free surrogates left.
MOST_DRAWS = 40
#: Draws that keep the form of the key.
SAME_FORM = 20
#: Keys that one task draws for: at most, and at least where there are fewer than the cluster has cores for.
MOST_KEYS, LEAST_KEYS = 20_000, 500

# Forms of address by gender.
MALE = ("Mr", "Mister", "Herr", "Herrn", "Señor", "Sr", "Monsieur", "Signor", "господин", "г-н", "κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Señorita", "Madame", "Mme", "Signora", "госпожа", "г-жа", "κυρία", "Mademoiselle", "Mlle", "Madam", "Lady")
EITHER = ("Dr", "Doctor", "Prof", "Professor", "Professorin", "доктор", "д-р", "профессор", "δρ")

# The forms of mentions. No quantifier can start inside what another start has tried,
# so long texts without spaces take linear time.
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# An apostrophe belongs to a name unless only the "s" of a genitive is behind it.
_PART = r"\p{Lu}\p{L}*+(?:['’](?![sS](?!\p{L}))\p{L}++)*+"
_TITLES = rf"(?:(?:{'|'.join([*MALE, *FEMALE, *EITHER])})\.?[  ])"
FORMS = {
    EMAIL: r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}[A-Za-z0-9])?\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])",
    IP: rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9]|\.[0-9])",
    CARD: r"(?<![0-9A-Za-z+-])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z])",
    PHONE: r"(?<![0-9A-Za-z])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9A-Za-z])|(?<![0-9A-Za-z])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])|(?<![0-9A-Za-z.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z])",
    NAME: rf"(?<![\p{{L}}\p{{N}}]){_TITLES}{{1,4}}+{_PART}(?:[ -]{_PART}){{0,2}}",
}
PATTERN = "|".join(f"(?:{FORMS[k]})" for k in KINDS)
BARE = rf"(?<![\p{{L}}\p{{N}}]){_PART}"

# Sounds of names by script, and the ends of male, female and other first names and of family names.
SOUNDS = {
    "latin": ("b c d f g h k l m n p r s t v w".split(), "a e i o u".split(), {"m": ["n", "r", "s", "l"], "f": ["a"], "n": ["e", "i"], "s": ["n", "r", "t", "k"]}),
    "cyrillic": ("б в г д ж з к л м н п р с т".split(), "а е и о у".split(), {"m": ["н", "р", "м", "л"], "f": ["а"], "n": ["е", "и"], "s": ["н", "р", "к", "т"]}),
    "greek": ("β γ δ ζ κ λ μ ν π ρ σ τ".split(), "α ε ι ο υ".split(), {"m": ["ς"], "f": ["α"], "n": ["ι", "ε"], "s": ["ς"]}),
}


# -- mentions ----------------------------------------------------------------


def kind_of(mention: Column) -> Column:
    """The type of a mention, in the order in which the forms are tried."""
    digits = F.regexp_replace(mention, "[^0-9]", "")
    return (
        F.when(mention.contains("@"), EMAIL)
        .when(F.regexp_like(mention, F.lit(r"^\p{L}")), NAME)
        .when(F.regexp_like(mention, F.lit(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")), IP)
        .when(~mention.startswith("+") & (F.length(digits) >= 13), CARD)
        .otherwise(PHONE)
    )


def _named(mention: Column) -> tuple[Column, Column]:
    """The forms of address with the blank behind them, and the name."""
    head = F.regexp_extract(mention, f"^({_TITLES}+)", 1)
    return head, F.substr(mention, F.length(head) + 1)


def gender_of(mention: Column) -> Column:
    """``m`` or ``f`` by the first form of address that has a gender, ``n`` if none has."""
    titles = F.split(_named(mention)[0], r"\.?[  ]")
    gender = lambda t: F.when(t.isin(*FEMALE), "f").when(t.isin(*MALE), "m")
    told = F.filter(F.transform(titles, gender), lambda g: g.isNotNull())
    return F.coalesce(F.get(told, 0), F.lit("n"))


def keys_of(mention: Column) -> Column:
    """What a mention has surrogates for: ``type:canonical`` strings. A name has one for each part: first
    names by gender, the last part as a family name."""
    kind = kind_of(mention)
    parts = F.split(F.lower(_named(mention)[1]), "[ -]")
    first, last = F.slice(parts, 1, F.size(parts) - 1), F.element_at(parts, -1)
    names = F.concat(
        F.transform(first, lambda p: F.concat(gender_of(mention), F.lit(":"), p)),
        F.array(F.concat(F.lit("s:"), last)),
    )
    whole = F.when(kind == EMAIL, F.lower(mention)).when(kind == IP, mention).otherwise(
        F.regexp_replace(mention, "[^0-9+]", "")
    )
    return F.when(kind == NAME, names).otherwise(F.array(F.concat(kind, F.lit(":"), whole)))


# -- surrogates --------------------------------------------------------------


def _bytes(key: Column, draw: int, secret: str) -> Column:
    """128 keyed pseudo-random bytes, as hexadecimal text."""
    blocks = (F.sha2(F.concat(F.lit(f"{secret}\x01{draw}\x01{k}\x01"), key), 256) for k in range(4))
    return F.concat(*blocks)


def _byte(stream: Column, at: Column) -> Column:
    return F.conv(F.substr(stream, (at % 128) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _points(value: Column) -> Column:
    return F.sequence(F.lit(0), F.length(value) - 1)


def _joined(parts: Column) -> Column:
    return F.array_join(parts, "")


def _char(value: Column, at: Column) -> Column:
    return F.substr(value, at + 1, F.lit(1))


def _digit(stream: Column, at: Column, least: int = 0) -> Column:
    return (_byte(stream, at) % (10 - least) + least).cast("string")


def _digits(value: Column, stream: Column) -> Column:
    """Other digits; a sign, the first digit and zeros at the start of the rest stay what they are."""
    lead = F.when(value.startswith("+"), 2).otherwise(1)
    return _joined(
        F.transform(
            _points(value),
            lambda i: F.when(i < lead, _char(value, i)).otherwise(_digit(stream, i)),
        )
    )


def luhn_sum(digits: Column) -> Column:
    """The sum of the digits, every second one from the last but one doubled."""
    n = F.length(digits)

    def worth(i):
        d = _char(digits, i).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when((n - i) % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.transform(_points(digits), worth), F.lit(0), lambda a, b: a + b)


def _more(extra: int, one) -> Column:
    """``extra`` characters of a wider form."""
    return _joined(F.transform(F.sequence(F.lit(1), F.lit(extra)), one)) if extra else F.lit("")


def _more_digits(stream: Column, extra: int) -> Column:
    return _more(extra, lambda i: _digit(stream, i + 70))


def _card(value: Column, stream: Column, extra: int = 0) -> Column:
    """Other digits with the same first one; a valid check digit stays valid."""
    body = F.concat(_digits(F.substr(value, F.lit(1), F.length(value) - 1), stream), _more_digits(stream, extra))
    check = F.pmod(10 - luhn_sum(F.concat(body, F.lit("0"))) % 10, F.lit(10))
    other = F.pmod(check + 1 + _byte(stream, F.lit(100)) % 9, F.lit(10))
    valid = luhn_sum(value) % 10 == 0
    return F.concat(body, F.when(valid, check).otherwise(other).cast("string"))


def _ip(value: Column, stream: Column, extra: int = 0) -> Column:
    """Other octets of the same number of digits; in the wider form of any."""
    octets = F.split(value, r"\.")

    def octet(x, i):
        b = _byte(stream, i * 2) + _byte(stream, i * 2 + 1) * 256
        if extra:
            return (b % 256).cast("string")
        return (
            F.when(F.length(x) == 1, b % 10).when(F.length(x) == 2, b % 90 + 10).otherwise(b % 156 + 100)
        ).cast("string")

    return F.array_join(F.transform(octets, octet), ".")


def _email(value: Column, stream: Column, extra: int = 0) -> Column:
    """Other letters and digits where there are some; the last label of the host stays."""
    host = F.regexp_extract(value, r"(\.[a-z]+)$", 1)
    head = F.substr(value, F.lit(1), F.length(value) - F.length(host))
    letters = F.lit("abcdefghijklmnopqrstuvwxyz")

    def other(i):
        c, b = _char(head, i), _byte(stream, i)
        return (
            F.when(c.between("a", "z"), _char(letters, b % 26))
            .when(c.between("0", "9"), (b % 10).cast("string"))
            .otherwise(c)
        )

    front = _more(extra, lambda i: _char(letters, _byte(stream, i + 70) % 26))
    return F.concat(front, _joined(F.transform(_points(head), other)), host)


def _name(value: Column, gender: str, stream: Column, draw: int = 0) -> Column:
    """A name of syllables in the same script, with an end that fits the gender."""

    def of(script: str) -> Column:
        consonants, vowels, ends = SOUNDS[script]
        c, v, e = (F.array(*map(F.lit, x)) for x in (consonants, vowels, ends[gender]))
        # As many syllables as fit the length, and more where draws need room.
        n = F.greatest(F.lit(2), F.least(F.lit(6), F.length(value) / 2)).cast("int") + draw // 2

        def syllable(i):
            return F.concat(
                F.element_at(c, _byte(stream, i * 2) % len(consonants) + 1),
                F.element_at(v, _byte(stream, i * 2 + 1) % len(vowels) + 1),
            )

        last = F.element_at(e, _byte(stream, F.lit(127)) % len(ends[gender]) + 1)
        if gender in "fn":  # the end takes the place of the last vowel
            body = F.concat(
                _joined(F.transform(F.sequence(F.lit(0), n - 2), syllable)),
                F.element_at(c, _byte(stream, F.lit(120)) % len(consonants) + 1),
            )
        else:
            body = _joined(F.transform(F.sequence(F.lit(0), n - 1), syllable))
        return F.concat(body, last)

    return (
        F.when(F.regexp_like(value, F.lit(r"\p{IsCyrillic}")), of("cyrillic"))
        .when(F.regexp_like(value, F.lit(r"\p{IsGreek}")), of("greek"))
        .otherwise(of("latin"))
    )


def candidate(key: Column, draw: int, secret: str) -> Column:
    """The surrogate that a ``type:canonical`` key draws, without its type."""
    kind, value = F.substring_index(key, ":", 1), F.substr(key, F.instr(key, F.lit(":")) + 1)
    stream, extra = _bytes(key, draw, secret), max(0, draw + 1 - SAME_FORM)
    return (
        F.when(kind == EMAIL, _email(value, stream, extra))
        .when(kind == IP, _ip(value, stream, extra))
        .when(kind == CARD, _card(value, stream, extra))
        .when(kind == PHONE, F.concat(_digits(value, stream), _more_digits(stream, extra)))
        .when(kind == "m", _name(value, "m", stream, draw))
        .when(kind == "f", _name(value, "f", stream, draw))
        .when(kind == "n", _name(value, "n", stream, draw))
        .otherwise(_name(value, "s", stream, draw))
    )


def _tasks(keys: DataFrame) -> int:
    """Tasks that draw for these keys of a written table."""
    n = keys.count()
    return max(1, -(-n // MOST_KEYS), min(keys.sparkSession.sparkContext.defaultParallelism, n // LEAST_KEYS))


def surrogates(keys: DataFrame, secret: str = KEY) -> DataFrame:
    """``key, surrogate`` for a table of distinct keys, no two with the same surrogate of one type and none
    with a surrogate that is itself a key. In each draw, of the keys that want one surrogate the least has it.
    Raises an error when the wider forms have no free surrogates either, as for more addresses than IPv4 has."""
    taken, done, left = keys.select(F.col("key").alias("full")), [], keys
    for draw in range(MOST_DRAWS):
        spread = left.repartition(_tasks(left), "key")
        wanted = spread.withColumn("surrogate", candidate(F.col("key"), draw, secret)).withColumn(
            "full", F.concat(F.substring_index("key", ":", 1), F.lit(":"), F.col("surrogate"))
        )
        free = wanted.join(taken, "full", "left_anti")
        won = saved(
            free.groupBy("full").agg(F.min_by(F.struct("key", "surrogate"), "key").alias("w")).select("full", "w.*")
        )
        done.append(won.select("key", "surrogate"))
        taken = taken.unionAll(won.select("full"))
        left = saved(left.join(won, "key", "left_anti").select("key"))
        if left.isEmpty():
            break
    else:
        raise ValueError("more keys than surrogates of their form")
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return found


# -- texts -------------------------------------------------------------------


def _written_as(part: Column, surrogate: Column) -> Column:
    """The surrogate of a part of a name in the case of the part."""
    loud = (F.length(part) > 1) & (part == F.upper(part))
    return F.when(loud, F.upper(surrogate)).otherwise(F.initcap(surrogate))


def rendered(mention: Column, of_key: Column) -> Column:
    """The mention with the surrogates of its keys, written as the mention is."""
    kind, keys = kind_of(mention), keys_of(mention)
    whole = F.element_at(of_key, F.element_at(keys, 1))

    def cased():
        # Letters of a wider form stand in front.
        front = F.length(whole) - F.length(mention)
        same = F.transform(
            _points(mention),
            lambda i: F.when(
                _char(mention, i) != F.lower(_char(mention, i)), F.upper(_char(whole, i + front))
            ).otherwise(_char(whole, i + front)),
        )
        return F.concat(F.substr(whole, F.lit(1), front), _joined(same))

    def spaced():
        # The n-th digit of the mention becomes the n-th of the surrogate; digits of a wider form stand behind.
        digits = F.regexp_replace(whole, r"\+", "")
        before = F.transform(
            _points(mention),
            lambda i: F.length(F.regexp_replace(F.substr(mention, F.lit(1), i), "[^0-9]", "")),
        )
        same = F.transform(
            _points(mention),
            lambda i: F.when(
                _char(mention, i).between("0", "9"), _char(digits, F.element_at(before, i + 1))
            ).otherwise(_char(mention, i)),
        )
        # The count before a place leaves its own digit out.
        used = F.length(F.regexp_replace(mention, "[^0-9]", ""))
        return F.concat(_joined(same), F.substr(digits, used + 1, F.length(digits)))

    def named():
        head, name = _named(mention)
        parts = F.split(name, "[ -]")
        marks = F.concat(F.regexp_extract_all(name, F.lit("[ -]"), F.lit(0)), F.array(F.lit("")))
        return F.concat(
            head,
            _joined(
                F.zip_with(
                    F.zip_with(parts, keys, lambda p, k: F.struct(p.alias("p"), F.element_at(of_key, k).alias("s"))),
                    marks,
                    lambda x, m: F.concat(_written_as(x["p"], x["s"]), m),
                )
            ),
        )

    return F.when(kind == EMAIL, cased()).when(kind == IP, whole).when(kind == NAME, named()).otherwise(spaced())


def _parts(text: Column, pattern: str) -> tuple[Column, Column]:
    """Matches, and the texts before, between and after them."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)


def _woven(between: Column, matches: Column) -> Column:
    """A text from the pieces around its matches and what stands for the matches."""
    return _joined(F.zip_with(between, F.concat(matches, F.array(F.lit(""))), lambda a, b: F.concat(a, b)))


def _names_in(keys: Column) -> Column:
    """Keys of the parts of names that a bare word can mean, family names first."""
    long = F.filter(keys, lambda k: F.regexp_like(k, F.lit("^[mfns]:..")))
    return F.concat(
        F.filter(long, lambda k: k.startswith("s:")), F.filter(long, lambda k: ~k.startswith("s:"))
    )


def _bare_names(piece: Column) -> Column:
    """``piece`` of a text with surrogates for the bare parts of the text's names."""
    words, between = _parts(piece, BARE)

    def other(word: Column) -> Column:
        at = F.array_position("parts", F.lower(word)).cast("int")
        surrogate = F.element_at("of_key", F.element_at("names", at))
        return F.when(at > 0, _written_as(word, surrogate)).otherwise(word)

    return _woven(between, F.transform(words, other))


def _count_bare(pieces: Column) -> Column:
    """How many bare parts of the text's names the pieces of a text hold."""
    words = F.flatten(F.transform(pieces, lambda p: F.regexp_extract_all(p, F.lit(BARE), F.lit(0))))
    return F.size(F.filter(words, lambda w: F.array_contains("parts", F.lower(w))))


def replaced(docs: DataFrame, secret: str = KEY) -> DataFrame:
    """``row``, all columns of ``docs`` with surrogates in ``text``; ``kinds``, the types of the mentions
    in order; ``bare``, how many parts of their names stand elsewhere in the text. Rows without a mention pass
    unchanged, null texts as null."""
    rows = docs.select(whole_row(docs).alias("row"), F.col("text").alias("text"))
    mentions, between = _parts(F.col("text"), PATTERN)
    none = F.array().cast("array<string>")
    met = saved(
        rows.select("row", "text", F.coalesce(mentions, none).alias("mentions"))
        .select(
            "row",
            "mentions",
            F.when(F.size("mentions") > 0, between).alias("between"),
            F.array_distinct(F.flatten(F.transform("mentions", keys_of))).alias("keys"),
        )
        .withColumn("names", _names_in(F.col("keys")))
        .withColumn("parts", F.transform("names", lambda k: F.substring(k, 3, 1 << 30)))
        .withColumn("number", F.monotonically_increasing_id())
    )
    hits = met.where(F.size("mentions") > 0)
    asked = hits.select("number", F.explode("keys").alias("key"))
    found = surrogates(saved(asked.select("key").distinct()), secret)
    maps = asked.join(found, "key").groupBy("number").agg(
        F.map_from_entries(F.collect_list(F.struct("key", "surrogate"))).alias("of_key")
    )
    new = F.transform("mentions", lambda m: rendered(m, F.col("of_key")))
    named = F.size("parts") > 0
    rest = F.when(named, F.transform("between", _bare_names)).otherwise(F.col("between"))
    changed = hits.join(maps, "number").select(
        F.col("row").withField("text", _woven(rest, new)).alias("row"),
        F.transform("mentions", kind_of).alias("kinds"),
        F.when(named, _count_bare(F.col("between"))).otherwise(0).alias("bare"),
    )
    same = met.where(F.size("mentions") == 0).select("row", none.alias("kinds"), F.lit(0).alias("bare"))
    return changed.unionByName(same)


def hide(docs: DataFrame, secret: str = KEY) -> DataFrame:
    """``docs`` with surrogates in place of personal data; same rows, same columns."""
    return replaced(docs, secret).select("row.*")


def hidden_documents(docs: DataFrame, secret: str = KEY) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the ``text`` with surrogates, the number of mentions of each
    type (``n_email`` and so on) and ``n_bare``, that of bare parts of names. Null and empty texts give empty ones."""
    found = replaced(texts(docs), secret)

    def count(kind: str) -> Column:
        return F.size(F.filter("kinds", lambda k: k == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("row.doc_id", "row.text", *(count(k) for k in KINDS), F.col("bare").cast("bigint").alias("n_bare"))
