"""Best-fit packing of tokenised documents with a swap-based local search.

Documents become ids, longer ones pieces; full pieces are sequences of their own. The other
pieces are dealt by a hash into groups of a bounded number, each packed by itself: best fit in
order of falling length, then a local search over the bins that are not full. It moves a piece,
exchanges one for one or two for one between two bins whenever the sum of squared fills rises,
so that full bins get fuller and empty ones disappear. The bins that stay open are dealt again
into fewer groups until one is left, so no group is ever larger than ``GROUP``.
"""

from __future__ import annotations

import json
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import batches, saved, texts

LENGTH = 2048
VOCABULARY = "byte_bpe_50k.json"
#: Put after each document.
END_ID = 0
#: Pieces that one task packs at a time.
GROUP = 30_000
#: Bins that one local search looks at; the rounds of search over them.
SEARCH_BINS, SEARCH_ROUNDS = 400, 4
#: Bins filled to this share are left alone.
DONE = 0.999


# -- ids ---------------------------------------------------------------------


def tokenizer(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a ``tokenizers`` file.

    Ids and special strings are those that ``tokenizers`` gives for ``add_special_tokens=False``
    (tests compare them); its own encoder takes five times the CPU time of this one.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocab, special = spec["model"]["vocab"], {t["content"]: t["id"] for t in spec["added_tokens"]}
    as_byte = {c: b for b, c in byte_letters().items()}
    ranks = {bytes(as_byte[c] for c in t): i for t, i in vocab.items() if t not in special}
    return tiktoken.Encoding(
        path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
    )


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies: itself, or for
    the others the next one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def cuts(n: int, most: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: full ones but for the first."""
    first = n % most or min(n, most)
    return [(0, first), *((s, most) for s in range(first, n, most))]


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, most: int = LENGTH) -> DataFrame:
    """The pieces of each row of ``docs``: ``doc_id, piece, start, length, ids`` (binary,
    little-endian unsigned 32-bit). Every document ends with id 0, so a null or empty text is
    one piece of one id."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("piece", pa.int32()),
            ("start", pa.int64()),
            ("length", pa.int64()),
            ("ids", pa.binary()),
        ]
    )

    def rows(incoming: Iterator[pa.RecordBatch]):
        encoder = tokenizer(public_tokenizers.path(vocabulary))
        for batch in incoming:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = encoder.encode_to_numpy(text.as_py(), allowed_special="all")
                ids = np.append(found, END_ID).astype("<u4")
                for k, (start, length) in enumerate(cuts(len(ids), most)):
                    yield doc_id, k, start, length, ids[start : start + length].tobytes()

    return texts(docs).mapInArrow(
        lambda incoming: batches(rows(incoming), schema),
        "doc_id bigint, piece int, start bigint, length bigint, ids binary",
    )


# -- bins --------------------------------------------------------------------


class Bins:
    """Bins of items of known length; ``items[b]`` is sorted by length."""

    def __init__(self, most: int):
        self.most = most
        self.items: list[list[tuple[int, int]]] = []
        self.fill: list[int] = []

    def best_fit(self, lengths: np.ndarray) -> None:
        """Each item, longest first, into the fullest bin that has room."""
        room: list[tuple[int, int]] = []  # (free, bin), sorted
        for item in np.argsort(-lengths, kind="stable").tolist():
            length = int(lengths[item])
            at = bisect_left(room, (length, -1))
            if at == len(room):
                self.items.append([])
                self.fill.append(0)
                bin_ = len(self.items) - 1
            else:
                bin_ = room.pop(at)[1]
            insort(self.items[bin_], (length, item))
            self.fill[bin_] += length
            if self.fill[bin_] < self.most:
                insort(room, (self.most - self.fill[bin_], bin_))

    def search(self, bins: list[int], rounds: int) -> None:
        """Between any two of these bins: the change that raises the squared fill most, until
        no change raises it or the rounds are over. Bins that become empty drop out."""
        for _ in range(rounds):
            changed = False
            order = sorted((b for b in bins if self.items[b]), key=lambda b: (-self.fill[b], b))
            for n, into in enumerate(order):
                for of in reversed(order[n + 1 :]):
                    if self.fill[into] == self.most:
                        break
                    if self.items[of] and self.items[into]:
                        changed |= self.improve(into, of)
            if not changed:
                return

    def improve(self, a: int, b: int) -> bool:
        """One change that fills the fuller of two bins further: of all moves and exchanges that
        fit, the one that brings most. The sum of squares rises with every gain of the fuller
        bin, since the sum of both fills stays."""
        if self.fill[a] < self.fill[b]:
            a, b = b, a
        room = self.most - self.fill[a]
        gain, out, come = 0, [], []
        at = bisect_right(self.items[b], (room, 1 << 60))
        if at:  # move
            gain, come = self.items[b][at - 1][0], [self.items[b][at - 1]]
        for x in self.items[a]:  # exchange one for one
            if gain == room:
                break
            at = bisect_right(self.items[b], (room + x[0], 1 << 60))
            if at and self.items[b][at - 1][0] - x[0] > gain:
                gain, out, come = self.items[b][at - 1][0] - x[0], [x], [self.items[b][at - 1]]
        for x in self.items[a]:  # two for one
            if gain == room:
                break
            low, high, want = 0, len(self.items[b]) - 1, room + x[0]
            while low < high:  # the best pair up to ``want``
                both = self.items[b][low][0] + self.items[b][high][0]
                if both > want:
                    high -= 1
                    continue
                if both - x[0] > gain:
                    gain, out = both - x[0], [x]
                    come = [self.items[b][low], self.items[b][high]]
                low += 1
        if not gain:
            return False
        for source, target, what in ((b, a, come), (a, b, out)):
            for item in what:
                self.items[source].remove(item)
                insort(self.items[target], item)
        self.fill[a] += gain
        self.fill[b] -= gain
        return True


def fill_bins(lengths: np.ndarray, most: int = LENGTH) -> Bins:
    """Best fit, then the local search over windows of open bins."""
    bins = Bins(most)
    bins.best_fit(lengths)
    open_ = [b for b in range(len(bins.fill)) if bins.fill[b] < DONE * most]
    open_.sort(key=lambda b: bins.fill[b])
    for at in range(0, len(open_), SEARCH_BINS):
        bins.search(open_[at : at + SEARCH_BINS], SEARCH_ROUNDS)
    return bins


def _pack_group(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values(["length", "item"], ascending=[False, True], ignore_index=True)
    most = int(frame["most"].iloc[0])
    bins = fill_bins(frame["length"].to_numpy(), most)
    number = np.empty(len(frame), np.int64)
    offset = np.empty(len(frame), np.int64)
    full = np.empty(len(frame), bool)
    for b, items in enumerate(bins.items):
        place = 0
        for length, item in reversed(items):
            number[item], offset[item], full[item] = b, place, bins.fill[b] >= DONE * most
            place += length
    return pd.DataFrame(
        {"item": frame["item"], "length": frame["length"], "grp": key[0], "bin": number, "offset": offset, "full": full}
    )


# -- packing -----------------------------------------------------------------


def pack(items: DataFrame, most: int = LENGTH, group: int = GROUP) -> DataFrame:
    """Place rows with a ``length`` of 1 to ``most`` into sequences.

    Returns all columns of ``items`` with ``sequence_id`` and ``offset`` (in place of columns of these names); a sequence holds at most
    ``most``, its offsets have no gaps. Rows need no key: each gets a number when it is written.
    The result has no row for an empty table.
    """
    items = items.drop("_item", "sequence_id", "offset")
    numbered = saved(items.withColumn("_item", F.monotonically_increasing_id()))
    lengths = numbered.select(F.col("_item").alias("item"), "length")
    alone = lengths.where(F.col("length") == most).select(
        "item", F.lit(0).alias("round"), F.col("item").alias("grp"), F.lit(0).cast("long").alias("bin"), F.lit(0).cast("long").alias("offset")
    )
    left = lengths.where(F.col("length") < most)
    n, level, done = left.count(), 0, [alone]
    while n:
        level += 1
        groups = -(-n // group)
        dealt = left.withColumn(
            "grp", F.pmod(F.xxhash64("item", F.lit(level)), F.lit(groups))
        ).withColumn("most", F.lit(most))
        placed = saved(
            dealt.groupBy("grp").applyInPandas(
                _pack_group,
                "item bigint, length bigint, grp bigint, bin bigint, offset bigint, full boolean",
            )
        )
        last = groups == 1
        stay = placed if last else placed.where("full")
        done.append(stay.select("item", F.lit(level).alias("round"), "grp", "bin", "offset"))
        left = placed.where(~F.col("full")).select("item", "length")
        before, n = n, 0 if last else left.count()
        if n > before * 0.9:  # hardly a bin was filled: dealing them again would bring nothing
            done.append(
                placed.where(~F.col("full")).select("item", F.lit(level).alias("round"), "grp", "bin", "offset")
            )
            n = 0
    places = done[0]
    for more in done[1:]:
        places = places.unionByName(more)
    # Full pieces keep their number; bins get negative ones of round, group and bin.
    of_bin = -((F.col("grp") * (1 << 22) + F.col("bin")) * 64 + F.col("round"))
    places = places.select(
        F.col("item").alias("_item"),
        F.when(F.col("round") == 0, F.col("item")).otherwise(of_bin).alias("sequence_id"),
        F.col("offset"),
    )
    return numbered.join(places, "_item").drop("_item")


def pack_documents(docs: DataFrame, vocabulary: str = VOCABULARY, most: int = LENGTH) -> DataFrame:
    """Sequences of token ids: the columns of ``pieces`` with ``sequence_id`` and ``offset``."""
    return pack(pieces(docs, vocabulary, most), most)


def piece_digests(found: DataFrame) -> DataFrame:
    """Pieces with the CRC-32 of their ids in place of the ids."""
    return found.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
