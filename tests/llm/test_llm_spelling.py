import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import odd_documents as odd
import pytest

from parcelflow.llm import spelling
from parcelflow.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.01"
COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def edits(word, letters):
    """All words one edit away."""
    cut = [(word[:k], word[k:]) for k in range(len(word) + 1)]
    near = {a + b[1:] for a, b in cut if b}
    near |= {a + c + b[1:] for a, b in cut if b for c in letters} | {a + c + b for a, b in cut for c in letters}
    return near - {word}


def expected(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] += 1
    known = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    letters = sorted({c for w in known for c in w})
    form, near_of = {}, {}
    for w, n in known.items():
        near_of[w] = [v for v in edits(w, letters) if v in known] if len(w) < 200 else [
            v for v in known if abs(len(v) - len(w)) <= 1 and spelling.one_apart(w.encode("latin-1"), v.encode("latin-1"))
        ]
        best = min(near_of[w], key=lambda v: (-known[v], v), default=None)
        form[w] = best if best and known[best] >= 10 * n else None
    out = []
    for w, n in known.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near_of[w]), known.get(form[w])))
    return sorted(out, key=repr)


def test_query_against_all_edits_and_sql(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    got = odd.rows_of(QUERIES["op12_spelling_variants"](spark, SF_DIR), *COLUMNS)
    assert got == expected(rows) and any(r[1] for r in got)
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
        twin = db.sql(SQL["op12_spelling_variants"])
        assert set(twin.columns) == set(COLUMNS)
        assert sorted(twin.project(",".join(COLUMNS)).fetchall(), key=repr) == got


def crowd(seed=4):
    """Many words of the same letters, chains of forms, long words, words that differ by accents."""
    rng = random.Random(seed)
    found = Counter()
    for _ in range(300):
        found["".join(rng.choices("abÀé", k=7))] += rng.randint(1, 40)
    for _ in range(200):
        word = rng.choice(list(found))
        found[rng.choice(sorted(edits(word, "abcé")))] += rng.randint(1, 3)
    for length in (31, 32, 33, 34, 60):
        base = "".join(rng.choices("abcdefgh", k=length))
        found[base] += 500
        found[base[:5] + "z" + base[5:]] += 50
        found[base[:5] + "z" + base[6:]] += 5
        found[base[:9] + "xz" + base[9:]] += 4
        found[base[:-1]] += 2
    return [(k, " ".join([word] * n)) for k, (word, n) in enumerate(found.items())]


@pytest.mark.parametrize("place, pairs", [(4000, 1 << 16), (5, 7), (1, 1000)])
def test_crowded_places_lose_nothing(spark, monkeypatch, place, pairs):
    monkeypatch.setattr(spelling, "PLACE", place)
    monkeypatch.setattr(spelling, "TASK", 100)
    rows = crowd()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = spelling.saved(spelling.words(docs))
    assert odd.rows_of(spelling.variants(docs), *COLUMNS) == expected(rows)
    depth = spelling.depth_of(spelling.place_sizes(found))
    assert depth == (spelling.LEVELS if place == 1 else depth)


def test_search_in_small_steps_meets_all_pairs(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(spelling, "STEPS", 3)
    monkeypatch.setattr(spelling, "PAIRS", 5)
    rng = random.Random(8)
    found = sorted({"".join(rng.choices("abcé", k=rng.randint(7, 8))) for _ in range(150)})
    frame = pd.DataFrame(
        [(0, spent, w, 1) for spent in (spelling.HERE, spelling.NOTHING) for w in found],
        columns=["cell", "spent", "word", "n"],
    )
    got = {frozenset((frame["word"][i], frame["word"][j])) for a, b in spelling.pairs_of(frame, 0) for i, j in zip(a, b)}
    assert got == {frozenset((a, b)) for a in found for b in found if b in edits(a, "abcé")}


def test_one_apart():
    rng = random.Random(1)
    for _ in range(3000):
        a = "".join(rng.choices("ab", k=rng.randint(1, 5)))
        b = "".join(rng.choices("ab", k=rng.randint(1, 5)))
        want = b in edits(a, "ab")
        assert spelling.one_apart(a.encode(), b.encode()) == want
        if len(a) <= len(b):
            letters = spelling.Letters([a.encode(), b.encode()])
            got = spelling.verified(letters, np.array([0]), letters, np.array([1]))[0] if len(b) - len(a) < 2 else False
            assert got == want


def test_odd_documents(spark):
    got = odd.rows_of(spelling.variants(odd.documents(spark)), *COLUMNS)
    assert got == expected(odd.ROWS)
    assert spelling.variants(odd.empty(spark)).count() == 0
    docs = odd.documents(spark, [(1, None), (2, ""), (None, "short words only")])
    assert spelling.variants(docs).count() == 0
