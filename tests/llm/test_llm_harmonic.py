import random
import zlib
from collections import defaultdict

import numpy as np
import odd_documents as odd
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parcelflow.llm import harmonic
from parcelflow.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(harmonic.VOCABULARY))


@pytest.fixture(scope="module")
def encoder():
    return harmonic.Encoder(public_tokenizers.path(harmonic.VOCABULARY))


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, harmonic.END_ID]


def test_ids_are_those_of_tokenizers(library, encoder):
    rng = random.Random(5)
    parts = [" ", "\n", "\t", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", " ", " ", "　", "​", "<|endoftext|>"]
    parts += ["<|STARTOFTEXT|>", "'s", "'LL", "e", "́", "É", "İ", "Σ", "ΑΣ", "12", "!?", "日本", "ǅ", "\U0001f600", "ab"]
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 9)))
        assert words_of(encoder, text) == ids_of(library, text)[:-1], repr(text)


def words_of(encoder, text):
    return np.frombuffer(encoder(text), "<u4").tolist()


def test_code_points(library, encoder):
    points = [chr(c) for c in [*range(0x3100), *range(0x3100, 0x110000, 17)] if not 0xD800 <= c < 0xE000]
    for k in range(0, len(points), 20_000):
        text = " ".join(f"a{c}b" for c in points[k : k + 20_000])
        assert words_of(encoder, text) == ids_of(library, text)[:-1], hex(k)


def test_runs_of_letters_and_marks(library, encoder):
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyzaeiourstnlABCÀÖØéñßÿüç"
    for _ in range(40):
        words = ["".join(rng.choices(letters, k=rng.randint(1, 14))) for _ in range(1500)]
        text = " ".join(w + "".join(rng.choices("!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'0123", k=rng.randint(0, 3))) for w in words)
        assert words_of(encoder, text) == ids_of(library, text)[:-1]


def test_words_of_the_documents(library, encoder):
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()
    text = " ".join({w for t in texts for w in (t or "").split()})
    assert words_of(encoder, text) == ids_of(library, text)[:-1]


def test_a_full_cache_starts_afresh(library, monkeypatch):
    monkeypatch.setattr(harmonic, "CACHED", 3)
    encoder = harmonic.Encoder(public_tokenizers.path(harmonic.VOCABULARY))
    for k in range(20):
        text = f"один two, {k}’s four’s одиннадцать! " + "ж" * 100
        assert words_of(encoder, text) == ids_of(library, text)[:-1]
        assert len(encoder.known) <= 3


@pytest.mark.parametrize("n", [1, 2, 3, 1023, 2047, 2048, 2049, 4096, 5000, 10_239])
def test_cuts(n):
    found = harmonic.cuts(n)
    assert [s for s, _ in found] == [0, *np.cumsum([k for _, k in found])[:-1]]
    assert sum(k for _, k in found) == n
    assert all(k & (k - 1) == 0 and k <= 2048 for _, k in found)


def test_bins_of_one_task_leave_no_padding():
    rng = random.Random(2)
    for _ in range(200):
        bins, closed, lengths = harmonic.Bins(64), [], []
        for _ in range(rng.randint(0, 60)):
            for _, length in harmonic.cuts(rng.randint(1, 200), 64):
                lengths.append(length)
                closed.append(bins.add(length, None))
        full = [b for b in closed if b]
        assert all(sum(k for k, _ in b) == 64 and len(b) == 64 // b[0][0] for b in full)
        rest = [[k for k, _ in b] for b in bins.rest()]
        assert sorted([k for b in full for k, _ in b] + [k for b in rest for k in b]) == sorted(lengths)
        sums = [sum(b) for b in rest]
        assert all(s & (s - 1) == 0 and s <= 64 for s in sums)
        short = [s for s in sums if s < 64]
        assert len(short) == len(set(short))


def check(rows, wanted):
    """Every id of every document once, sequences without gaps; the ids that padding adds."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for doc_id, start, length, crc, n, sequence, offset in rows:
        by_doc[doc_id].append((start, length, crc, n))
        by_sequence[sequence].append((offset, length))
    pieces = sorted(p for found in by_doc.values() for p in found)
    want = []
    for ids in wanted:
        binary = np.array(ids, "<u4").tobytes()
        want += [(s, k, zlib.crc32(binary[4 * s : 4 * (s + k)]), len(ids)) for s, k in harmonic.cuts(len(ids))]
    assert pieces == sorted(want)
    padding = 0
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= harmonic.LENGTH
        padding += 0 if end & (end - 1) == 0 else harmonic.LENGTH - end
    return padding, len(by_sequence)


COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def test_query_places_every_id_without_padding(spark, library):
    got = QUERIES["op11_harmonic_packing"](spark, SF_DIR).select(*COLUMNS).collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    wanted = [ids_of(library, r.text) for r in docs]
    padding, sequences = check(got, wanted)
    assert padding == 0 and sequences <= sum(map(len, wanted)) / harmonic.LENGTH + 12 * 8
    by_doc = {r.doc_id: r.doc_tokens for r in got}
    assert by_doc == {r.doc_id: len(ids) for r, ids in zip(docs, wanted)}


def test_sequences_hold_the_ids_of_their_pieces(spark):
    pieces = harmonic.pack(odd.documents(spark))
    found = {r.sequence_id: r for r in harmonic.sequences(pieces).collect()}
    for r in pieces.collect():
        whole = found[r.sequence_id]
        assert whole.ids[4 * r.offset : 4 * (r.offset + r.length)] == r.ids
        assert len(whole.ids) == 4 * whole.length
    uneven = spark.createDataFrame(
        [(7, 3, 0, b"abcdabcdabcd"), (7, 2, 3, b"efghefgh"), (8, 4, 0, b"x" * 16)],
        "sequence_id bigint, length bigint, offset bigint, ids binary",
    )
    got = {r.sequence_id: r.ids for r in harmonic.sequences(uneven, 9, 8).collect()}
    assert got == {7: b"abcdabcdabcdefghefgh" + b"\x09\0\0\0" * 3, 8: b"x" * 16}
    assert harmonic.padded(F.lit(5)) is not None


def test_odd_documents(spark, library):
    got = harmonic.piece_digests(harmonic.pack(odd.documents(spark))).select(*COLUMNS).collect()
    assert check(got, [ids_of(library, t) for _, t in odd.ROWS])[0] == 0
    assert sorted({str(r.doc_id) for r in got}) == sorted({str(i) for i, _ in odd.ROWS})
    assert harmonic.pack(odd.empty(spark)).count() == 0
    with pytest.raises(ValueError):
        harmonic.pack(odd.empty(spark), most=100)
