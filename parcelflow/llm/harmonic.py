"""Harmonic packing of tokenised documents: every class of lengths fills bins of its own.

The class of a length is how many such pieces a sequence takes, so a bin of class k is closed when it
has k pieces, whatever they are. Documents are cut so that nothing is lost by that: into full pieces
and, for the rest, pieces of one half, a quarter, an eighth ... of a sequence, one for each binary digit
of its length. A bin of class k then holds exactly a full sequence. Each task fills its own bins from the
documents that it reads and holds less than one sequence a class; nothing is shuffled. What a task holds
when its documents end makes full sequences across classes and at last sequences whose lengths are
powers of two, which need no padding either.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parcelflow.llm.common import batches, texts
from parcelflow.llm.packing import byte_letters

#: Ids of a sequence, a power of two.
LENGTH = 2048
VOCABULARY = "word_bpe_49k.json"
#: Put after each document.
END_ID = 1
#: Words that a task keeps with their ids, and the longest one of them.
CACHED, LONGEST = 200_000, 64

# Plain characters need no normalisation but lower case, and their classes are the same in every version of
# Unicode. The vocabulary cuts words between letters, digits and marks, and digits one by one; an apostrophe
# may begin a contraction, and a bar be part of a special token.
MARKS = re.escape("!\"#$%&()*+,-./:;<=>?@[\\]^_`{}~")
OTHER = re.compile(f"[^ a-zA-Zß-öø-ÿÀ-ÖØ-Þ0-9{MARKS}]")
RUNS = re.compile(f"[{MARKS}]+|[0-9]")

PIECES = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


class Encoder:
    """Ids of texts as ``tokenizers`` gives them without special tokens around.

    The vocabulary drops white space and merges nothing across it, so the ids of a text are those of its
    words. Words of Latin letters, digits and marks are cut into runs here, merged by ``tiktoken`` with a blank
    behind each run, which stands for the word end of the vocabulary; its merges cost a fraction of the
    library's. All other words go through the library itself (tests compare both).
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special, end = {t["content"] for t in spec["added_tokens"]}, spec["model"]["end_of_word_suffix"]
        as_byte, ranks = {c: b for b, c in byte_letters().items()}, {}
        for token, number in spec["model"]["vocab"].items():
            if token not in special:
                ranks[bytes(as_byte[c] for c in token.removesuffix(end)) + b" " * token.endswith(end)] = number
        self.merges = tiktoken.Encoding(path, pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}

    def alone(self, word: str) -> bytes:
        """The library's own ids, little-endian unsigned 32-bit; of short words through a bounded cache."""
        found = self.known.get(word)
        if found is None:
            found = np.array(self.library.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
            if len(word) <= LONGEST:
                if len(self.known) >= CACHED:
                    self.known.clear()
                self.known[word] = found
        return found

    def merged(self, text: str) -> bytes:
        """The ids of a text of plain words with blanks between."""
        runs = RUNS.sub(r" \g<0> ", text.lower())
        return self.merges.encode_to_numpy(f"{runs} ").astype("<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        text = text.replace("\n", " ").replace("\t", " ").replace("\r", " ")
        parts, start = [], 0
        while found := OTHER.search(text, start):
            word = text.rfind(" ", start, found.start()) + 1 or start
            end = text.find(" ", found.end())
            end = len(text) if end < 0 else end
            parts += self.merged(text[start:word]), self.alone(text[word:end])
            start = end
        parts.append(self.merged(text[start:] if start else text))
        return b"".join(parts)


def cuts(n: int, most: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: full ones, then falling powers of two."""
    found = [(start, most) for start in range(0, n - most + 1, most)]
    start = n // most * most
    while start < n:
        length = 1 << ((n - start).bit_length() - 1)
        found.append((start, length))
        start += length
    return found


class Bins:
    """The bins of one task: items of lengths that are powers of two, at most ``most``.

    ``add`` returns a bin, a list of items in order, when the item closes it; ``rest`` returns those of
    all items that are left.
    """

    def __init__(self, most: int = LENGTH):
        self.most = most
        self.held: dict[int, list[tuple[int, object]]] = {}

    def add(self, length: int, item) -> list[tuple[int, object]] | None:
        kind = self.most // length
        held = self.held.setdefault(kind, [])
        held.append((length, item))
        return self.held.pop(kind) if len(held) == kind else None

    def rest(self) -> Iterator[list[tuple[int, object]]]:
        """Longest items first, their sums meet every power of two that is not less than the next item."""
        items = [x for kind in sorted(self.held) for x in self.held[kind]]
        self.held = {}
        left, room, bin_ = sum(length for length, _ in items), 0, []
        for length, item in items:
            room = room or min(self.most, 1 << (left.bit_length() - 1))
            bin_.append((length, item))
            room -= length
            left -= length
            if not room:
                yield bin_
                bin_ = []


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, most: int = LENGTH) -> DataFrame:
    """The pieces of each row of ``docs`` with their places: ``doc_id, start, length, ids`` (binary,
    little-endian unsigned 32-bit), ``doc_tokens, sequence_id, offset``.

    Every document ends with id 1, so a null or empty text is one piece of one id. Rows need no key; null
    and repeated ids are documents of their own, and other columns don't matter. An empty table gives an
    empty result. ``most`` is a power of two. Every sequence has ``most`` ids, but for the last ones of each
    partition of ``docs``, at most one for every smaller power of two.
    """
    if most < 1 or most & (most - 1):
        raise ValueError("most must be a power of two")
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("start", pa.int64()),
            ("length", pa.int64()),
            ("ids", pa.binary()),
            ("doc_tokens", pa.int64()),
            ("sequence_id", pa.int64()),
            ("offset", pa.int64()),
        ]
    )

    def rows(incoming: Iterator[pa.RecordBatch]):
        encoder, end = Encoder(public_tokenizers.path(vocabulary)), np.array([END_ID], "<u4").tobytes()
        bins, sequence = Bins(most), TaskContext.get().partitionId() << 33
        for batch in incoming:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder(text.as_py()) + end
                n = len(ids) // 4
                for start, length in cuts(n, most):
                    piece = (doc_id, start, length, ids[4 * start : 4 * (start + length)], n)
                    closed = bins.add(length, piece)
                    if closed:
                        yield from placed(closed, sequence)
                        sequence += 1
        for closed in bins.rest():
            yield from placed(closed, sequence)
            sequence += 1

    return texts(docs).mapInArrow(lambda incoming: batches(rows(incoming), schema), PIECES)


def placed(bin_: list[tuple[int, tuple]], sequence: int) -> Iterator[tuple]:
    """The pieces of a closed bin, one after the other."""
    offset = 0
    for length, piece in bin_:
        yield *piece, sequence, offset
        offset += length


def padded(length: Column, most: int = LENGTH) -> Column:
    """How long a sequence of this many ids is with padding: a power of two has none."""
    return F.when(length.bitwiseAND(length - 1) == 0, length).otherwise(F.lit(most).cast("bigint"))


def sequences(pieces: DataFrame, pad_id: int = 0, most: int = LENGTH) -> DataFrame:
    """``sequence_id, length, ids``: the sequences that ``pack`` filled as training reads them, padded with
    ``pad_id`` where their length (without padding) is no power of two. One task holds one sequence at a time."""
    pad = F.lit(np.array([pad_id], "<u4").tobytes())
    whole = pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"),
    )
    more = F.array_repeat(pad, (padded(F.col("length"), most) - F.col("length")).cast("int"))
    every = F.concat(F.transform("parts", lambda part: part["ids"]), more)
    joined = F.aggregate(every, F.lit(b""), lambda ids, part: F.concat(ids, part))
    return whole.select("sequence_id", "length", joined.alias("ids"))


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The pieces with the crc32 of their ids instead of the ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
