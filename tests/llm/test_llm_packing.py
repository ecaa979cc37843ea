import random
import zlib
from collections import defaultdict

import numpy as np
import odd_documents as odd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from parcelflow.llm import packing

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


def ids_of(reference, text):
    return [*reference.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def test_ids_are_those_of_tokenizers(reference):
    rng = random.Random(3)
    parts = ["<|endoftext|>", "<|endof", "'s", " ", "  ", "\n", "é", "日本", "1", "!", "ab", "\x85", "\xa0", "\U0001f600", "'LL"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(2000)]
    ours = packing.tokenizer(public_tokenizers.path(packing.VOCABULARY))
    for text, want in zip(texts, reference.encode_batch(texts, add_special_tokens=False)):
        assert ours.encode_to_numpy(text, allowed_special="all").tolist() == want.ids, text


@pytest.mark.parametrize("n", [1, 2047, 2048, 2049, 4096, 5000])
def test_cuts(n):
    cut = packing.cuts(n)
    assert [s for s, _ in cut] == list(np.cumsum([0, *(k for _, k in cut)])[:-1])
    assert sum(k for _, k in cut) == n and all(k == 2048 for _, k in cut[1:]) and 0 < cut[0][1] <= 2048


def check_places(rows, most=packing.LENGTH):
    """Sequences without gaps and not too long; how many there are."""
    bins = defaultdict(list)
    for length, sequence, offset in rows:
        bins[sequence].append((offset, length))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= most
    return len(bins)


def bins_of(lengths, most=100):
    bins = packing.fill_bins(np.array(lengths), most)
    assert sorted(length for items in bins.items for length, _ in items) == sorted(lengths)
    assert all(sum(length for length, _ in items) == fill <= most for items, fill in zip(bins.items, bins.fill))
    return bins


def test_two_for_one_exchange_empties_a_bin():
    bins = packing.Bins(100)
    bins.items = [[(20, 1), (60, 0)], [(15, 3), (25, 2)]]
    bins.fill = [80, 40]
    assert bins.improve(0, 1)  # 15 + 25 for 20 fill the first bin
    assert bins.fill == [100, 20]
    bins.items, bins.fill = [[(70, 0)], [(30, 1)]], [70, 30]
    assert bins.improve(0, 1) and bins.fill == [100, 0]  # a move empties the other


def test_search_never_needs_more_bins_than_best_fit():
    rng = np.random.default_rng(4)
    for _ in range(20):
        lengths = rng.integers(20, 100, 60)
        plain = packing.Bins(100)
        plain.best_fit(np.sort(lengths)[::-1])
        assert sum(f > 0 for f in bins_of(lengths).fill) <= len(plain.fill)


@pytest.mark.parametrize("group", [packing.GROUP, 40])
def test_documents_of_the_smallest_table(spark, reference, group):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = packing.pack(packing.piece_digests(packing.pieces(docs)), group=group).collect()
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
    total = 0
    for doc_id, text in docs.select("doc_id", "text").collect():
        ids, end = ids_of(reference, text), 0
        for r in sorted(by_doc.pop(doc_id), key=lambda r: r.piece):
            assert r.start == end
            end += r.length
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : end], "<u4").tobytes())
        assert end == len(ids)
        total += end
    assert not by_doc
    n = check_places([(r.length, r.sequence_id, r.offset) for r in got])
    assert n <= -(-total // packing.LENGTH) * (1.01 if group > 40 else 1.05) + 1


def test_odd_documents(spark, reference):
    got = packing.pack_documents(odd.documents(spark)).collect()
    n_pieces = sum(len(packing.cuts(len(ids_of(reference, t)))) for _, t in odd.ROWS)
    assert len(got) == n_pieces
    assert sum(r.length for r in got) == sum(len(ids_of(reference, t)) for _, t in odd.ROWS)
    check_places([(r.length, r.sequence_id, r.offset) for r in got])
    assert packing.pack_documents(odd.empty(spark)).count() == 0


def test_pack_replaces_columns_of_its_names(spark):
    items = spark.range(5).selectExpr("id", "cast(7 as bigint) AS length", "'x' AS offset", "1 AS _item")
    got = packing.pack(items, most=10)
    assert got.columns == ["id", "length", "sequence_id", "offset"] and got.count() == 5
