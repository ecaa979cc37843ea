import hashlib
import random

import numpy as np
import odd_documents as odd
import public_tokenizers
import pytest
import tiktoken

from parcelflow.llm import bpe

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def path():
    return public_tokenizers.path(bpe.RANKS)


@pytest.fixture(scope="module")
def reference(path):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(path), special_tokens={}
    )


def check(texts, path, reference):
    encoder, decoder = bpe.Encoder(path), bpe.Decoder(path)
    for text, pieces in zip(texts, bpe.slices(texts)):
        assert "".join(pieces) == text
        ids = np.frombuffer(encoder(pieces), "<u4").astype(np.int64)
        assert ids.tolist() == reference.encode_ordinary(text), text
        assert decoder(ids) == text.encode()


def test_random_texts(path, reference):
    rng = random.Random(7)
    parts = ["'s", "'re", "'", "'ll", "l", " ", "  ", "\n", "\t", "a", "Bc", "1", "²", "!", "é", "日本", "　", "\x85", "\x1c", "s", "t", "\U0001f600", "'ve", "''", "\r\n", "\xa0", "\x00", "don't"]
    check(["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(5000)], path, reference)


def test_every_code_point(path, reference):
    """In front of contractions, behind a blank, between numbers, beside a mark."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    lines = [f"{c}'s {c}'ll1{c}2 {c}!{c}" for c in points]
    check(["\n".join(lines[k : k + 1000]) for k in range(0, len(lines), 1000)], path, reference)


def test_letters_newer_than_python(path, reference):
    check([f"{c}'s {c}'ll 1{c}2" for c in "\u1c8a\ua7cb\U000105c0"], path, reference)


def test_long_pieces(path, reference):
    check(["x" * 3000, "ab" * 2000 + " " * 700, "\n" * 900, "é!" * 800, "", "a" * bpe.LONG + "b"], path, reference)


def test_blocks_and_cache_do_not_matter(path, reference, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 3)
    monkeypatch.setattr(bpe, "CACHED", 5)
    check(["it's a dog's 'life' we'll see  twice" * 20, "x"], path, reference)


def test_offsets(path):
    encoder, decoder = bpe.Encoder(path), bpe.Decoder(path)
    text = "naïve café 日本語"
    ids = np.frombuffer(encoder(next(bpe.slices([text]))), "<u4").astype(np.int64)
    offsets = decoder.offsets(ids)
    for k in range(len(ids)):
        assert text.encode()[offsets[k] :].startswith(decoder(ids[k : k + 1]))


@pytest.mark.parametrize("kind", ["table", "odd", "empty"])
def test_query_rows(spark, reference, kind):
    docs = {
        "table": lambda: spark.read.parquet(f"{SF_DIR}/documents.parquet"),
        "odd": lambda: odd.documents(spark),
        "empty": lambda: odd.empty(spark),
    }[kind]()
    got = odd.rows_of(
        bpe.round_trip_digests(bpe.decode(bpe.encode(docs))), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"
    )
    want = []
    for doc_id, text in docs.select("doc_id", "text").collect():
        ids = reference.encode_ordinary(text or "")
        packed = np.array(ids, "<u4").tobytes()
        want.append(
            (doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        )
    assert got == sorted(want, key=repr)
