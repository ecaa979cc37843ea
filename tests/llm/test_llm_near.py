import random
from collections import Counter, defaultdict

import numpy as np
import odd_documents as odd

from parcelflow.llm import near_dedup as near

SF_DIR = "/root/testdata/sf0.01"


def table_of_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edits_against_the_whole_table(monkeypatch):
    rng = random.Random(1)
    for band in (near.BAND, 2):
        monkeypatch.setattr(near, "BAND", band)
        for _ in range(1500):
            a = rng.choices("abc", k=rng.randint(0, 14))
            b = [rng.choice("abc") if rng.random() < 0.3 else x for x in a if rng.random() > 0.2]
            most, want = rng.randint(0, 8), table_of_edits(a, b)
            assert near.edits(a, b, most) == min(want, most + 1)
            assert near.edits_by_bits(a, b) == want


def test_sketches_keep_order_and_occurrences():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 2**63, 300).astype(np.uint64)
    same = lambda a, b: (near.sketches(a) == near.sketches(b)).mean()
    assert same(words, words) == 1
    assert same(words, np.concatenate([words[150:], words[:150]])) < 0.8  # the same shingles but few
    assert same(words, np.concatenate([words, words])) < 0.6
    assert near.occurrences(np.array([5, 7, 5, 5, 7])).tolist() == [0, 0, 1, 2, 1]


def classes_of(spark, rows):
    got = near.near_duplicates(odd.documents(spark, rows)).collect()
    assert len(got) == len(rows)
    return got


def test_links_of_a_table(spark):
    """All pairs that share a tenth of their shingles, aligned, against classes."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = {r.doc_id: r for r in near.near_duplicates(docs).collect()}
    ids = defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        ids[r.text or ""].append(r.doc_id)
    words = {v[0]: near.words_of(t) for t, v in ids.items()}
    runs = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, w in words.items() if w}
    by_run = defaultdict(list)
    for i, run in runs.items():
        for r in run:
            by_run[r].append(i)
    common = Counter((a, b) for v in by_run.values() for k, b in enumerate(v) for a in v[:k])
    parent = {i: i for v in ids.values() for i in v}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for v in ids.values():
        for i in v:
            parent[root(i)] = root(v[0])
    close = 0
    for (a, b), n in common.items():
        if n / (len(runs[a]) + len(runs[b]) - n) >= 0.1 and near.similarity(words[a], words[b]):
            close += 1
            parent[root(a)] = root(b)
    want = defaultdict(set)
    for i in parent:
        want[root(i)].add(i)
    have = defaultdict(set)
    for i, r in got.items():
        have[r.class_id].add(i)
    assert close > 10
    assert {frozenset(v) for v in have.values()} == {frozenset(v) for v in want.values()}
    assert all(r.class_size == len(have[r.class_id]) for r in got.values())


def text(rng, n):
    return rng.choices([f"w{k}" for k in range(5000)], k=n)


def test_a_large_group_of_near_copies_and_a_common_passage(spark):
    rng = random.Random(3)
    base, passage = text(rng, 200), text(rng, 60)
    rows = []
    for i in range(300):  # near copies, three words apart from the base
        words = list(base)
        for _ in range(3):
            words[rng.randrange(200)] = f"new{rng.random()}"
        rows.append((i, " ".join(words)))
    for i in range(300, 700):  # texts that share a passage only
        rows.append((i, " ".join(text(rng, 60) + passage + text(rng, 60))))
    for i in range(700, 720):  # pairs of near copies among them
        rows.append((i, rows[i - 400][1] + " more words"))
    got = {r.doc_id: r for r in classes_of(spark, rows)}
    assert {got[i].class_id for i in range(300)} == {0}
    assert all(got[i].class_id == i for i in range(300, 700))
    assert all(got[i].class_id == i - 400 for i in range(700, 720))
    assert got[5].class_size == 300 and got[700].class_size == 2 and got[300].n_links == 1


def test_pairs_behind_a_passage_of_thousands(spark):
    """Pairs at 0.8 to 0.9 that share at least one sketch, most of them in the passage only."""
    rng = random.Random(7)
    passage, rows, pairs = text(rng, 100), [], []
    for i in range(2000):
        rows.append((i, " ".join(text(rng, 50) + passage + text(rng, 50))))
    for i in range(2000, 2100):
        words = rows[i - 2000][1].split()
        for k in rng.sample([*range(50), *range(150, 200)], rng.choice([20, 30, 35, 40])):
            words[k] = f"new{rng.random()}"
        rows.append((i, " ".join(words)))
        pairs.append((i - 2000, i))
    hashes = {i: np.array([near.xxhash.xxh64_intdigest(w) for w in t.split()], np.uint64) for i, t in rows}
    met = [p for p in pairs if (near.sketches(hashes[p[0]]) == near.sketches(hashes[p[1]])).any()]
    got = {r.doc_id: r.class_id for r in classes_of(spark, rows)}
    assert len(met) > 90
    assert [p for p in met if got[p[0]] != got[p[1]]] == []
    assert len(set(got.values())) >= 2000


def test_pairs_of_few_words_behind_a_passage(spark):
    """Ten words make all that is not in the passage, so runs of two words are common everywhere."""
    rng = random.Random(11)
    passage, few = text(rng, 60), [f"few{k}" for k in range(10)]
    rows, pairs = [(i, " ".join(passage + rng.choices(few, k=60))) for i in range(1000)], []
    hashes = lambda words: np.array([near.xxhash.xxh64_intdigest(w) for w in words], np.uint64)
    for i in range(1000, 1150):
        base = rows[i - 1000][1].split()
        while True:
            words = list(base)
            for k in rng.sample(range(60, 120), rng.randint(20, 27)):
                words[k] = rng.choice(few)
            alike = near.similarity(base, words)
            if 0.8 <= alike <= 0.85 and (near.sketches(hashes(base)) == near.sketches(hashes(words))).any():
                break
        rows.append((i, " ".join(words)))
        pairs.append((i - 1000, i))
    got = {r.doc_id: r.class_id for r in classes_of(spark, rows)}
    assert [p for p in pairs if got[p[0]] != got[p[1]]] == []
    assert len(set(got.values())) == 1000


def test_runs_of_many_texts_are_one_row_for_those_that_lie_together(spark, monkeypatch):
    rng = random.Random(11)
    passage = [f"p{k}" for k in range(30)]
    rows = []
    for k in range(200):
        own = rng.choices([f"w{x}" for x in range(400)], k=12)
        rows.append((k, k // 3, " ".join(passage + own + (["twice"] * 3 if k % 5 else []))))
    held = spark.createDataFrame(rows, "id bigint, class bigint, text string").repartition(2).localCheckpoint()
    holders = defaultdict(set)
    for id_, class_, text in rows:
        for run in near.labelled_runs(near.hashed(near.words_of(text)), 2).view(np.int64).tolist():
            holders[run].add((id_, class_))
    several = {r: len({c for _, c in h}) > 1 for r, h in holders.items()}
    for most in (50, 3, 300):
        monkeypatch.setattr(near, "COMMON", most)
        want_known, want_own = defaultdict(list), Counter()
        for run, texts in holders.items():
            for id_, _ in texts:
                if not several[run]:
                    want_own[id_] += 1
                elif len(texts) <= most:
                    want_known[id_].append((len(texts), run))
        runs = near.runs_of(held, 2)
        got = {r.id: r for r in near.shared_runs(runs).collect()}
        assert {k: [tuple(x) for x in r.known] for k, r in got.items() if r.known} == {
            k: sorted(v) for k, v in want_known.items()
        }
        assert {k: r.own for k, r in got.items() if r.own} == want_own
        assert runs.count() < sum(map(len, holders.values())) / 2


def test_contracted_links_connect_the_same(spark):
    rng = random.Random(12)
    pairs = [tuple(rng.sample(range(300), 2)) for _ in range(600)]
    node = lambda k: f"{k:04d}".encode()
    links = spark.createDataFrame([(node(a), node(b)) for a, b in pairs], "a binary, b binary").repartition(2)
    parent = {k: k for pair in pairs for k in pair}
    for _ in parent:
        for a, b in pairs:
            parent[a] = parent[b] = min(parent[a], parent[b])
    got = near.contracted(links)
    assert got.count() < len(pairs) and got.where("a <= b").count() == 0
    for found in (near.components(got), near.components(links)):
        assert {bytes(r.node): bytes(r["class"]) for r in found.collect()} == {node(k): node(v) for k, v in parent.items()}


def test_texts_of_common_words_alone(spark, monkeypatch):
    """No run of words is rare, whatever its length, so blocks of texts are compared; every link counts."""
    monkeypatch.setattr(near, "COMMON", 1)
    monkeypatch.setattr(near, "BLOCK", 16)
    rng = random.Random(13)
    passage, few = text(rng, 60), [f"few{k}" for k in range(10)]
    rows = [(i, " ".join(passage + rng.choices(few, k=rng.randint(45, 75)))) for i in range(100)]
    for i in range(100, 140):
        words = rows[i - 100][1].split()
        for k in rng.sample(range(60, len(words)), rng.randint(1, len(words) // 5)):
            words[k] = rng.choice(few)
        rows.append((i, " ".join(words)))
    words = {i: t.split() for i, t in rows}
    of = {i: near.sketches(np.array([near.xxhash.xxh64_intdigest(w) for w in ws], np.uint64)) for i, ws in words.items()}
    links = [
        (a, b)
        for a in words
        for b in range(a + 1, len(rows))
        if (of[a] == of[b]).any() and near.similarity(words[a], words[b])
    ]
    got = {r.doc_id: r.class_id for r in classes_of(spark, rows)}
    assert len(links) > 30
    assert [p for p in links if got[p[0]] != got[p[1]]] == []
    assert len(set(got.values())) > 80


def test_edits_of_each_against_bits():
    rng = random.Random(23)
    for _ in range(200):
        many = [rng.choices("abcd", k=rng.randint(1, 90)) for _ in range(rng.randint(1, 9))]
        b = rng.choices("abcde", k=rng.randint(1, 90))
        assert near.edits_of_each(many)(b).tolist() == [near.edits_by_bits(a, b) for a in many]


def test_links_of_blocks_against_all_pairs(monkeypatch):
    """Classes that any link connects are connected, whatever the columns held at a time."""
    monkeypatch.setattr(near, "COLUMNS", 32)
    rng = random.Random(17)
    base = [text(rng, 40) for _ in range(6)]
    texts = [" ".join(rng.choice(base[0]) if rng.random() < 0.14 else w for w in rng.choice(base)) for _ in range(40)]
    rows = near.pd.DataFrame(
        [(bytes([i]), i, len(t.split()), t, i % 2) for i, t in enumerate(texts)],
        columns=["node", "class", "n_words", "text", "side"],
    )
    for one in (True, False):
        got = list(near.links_of_blocks(rows, one))
        assert all(a < b and s == near.similarity(texts[a[0]].split(), texts[b[0]].split()) >= 0.8 for a, b, s in got)
        group = {i: i for i in range(40)}
        for a, b, _ in got:
            group = {i: group[a[0]] if g == group[b[0]] else g for i, g in group.items()}
        pairs = [(a, b) for a in range(40) for b in range(a) if one or (a + b) % 2]
        links = [p for p in pairs if near.similarity(*(texts[i].split() for i in p))]
        assert len(links) > 20 and all(group[a] == group[b] for a, b in links)


def test_components_of_a_long_path(spark):
    rng = random.Random(19)
    nodes = [rng.randbytes(16) for _ in range(300)]
    links = spark.createDataFrame(list(zip(nodes, nodes[1:])), "a binary, b binary")
    assert {(bytes(r.node), bytes(r["class"])) for r in near.components(links).collect()} == {(n, min(nodes)) for n in nodes}


def test_a_chain_is_one_class(spark):
    rng = random.Random(4)
    words, rows = text(rng, 100), []
    for i in range(40):
        rows.append((i, " ".join(words)))
        for k in range(4):
            words[(i * 4 + k) % 100] = f"new{i}-{k}"
    assert {r.class_id for r in classes_of(spark, rows)} == {0}


def test_odd_documents(spark):
    got = near.near_duplicates(odd.documents(spark)).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(odd.ROWS)
    assert by_id[1].class_id == by_id[2].class_id == 1 and by_id[1].class_size == 3
    assert by_id[6].class_id == by_id[7].class_id == 6  # long texts
    assert by_id[3].class_id == by_id[4].class_id == 3  # null counts as empty
    assert by_id[5].class_size == 1
    kept = near.keep_one_of_each(odd.documents(spark))
    assert kept.schema == odd.documents(spark).schema
    assert odd.rows_of(kept, "doc_id") == sorted([(1,), (3,), (5,), (6,), (8,), (9,), (2**53 + 1,), (None,)], key=repr)
    for empty in (odd.empty(spark), odd.documents(spark, [(1, None), (2, "")])):
        assert near.near_duplicates(empty).where("n_links > 0").count() == 0
    assert near.keep_one_of_each(odd.empty(spark)).count() == 0
