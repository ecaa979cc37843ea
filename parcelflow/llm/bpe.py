"""Byte-level BPE: pre-tokens found by a vectorised automaton, merged through a cache, decoded.

Pre-tokenisation runs no regular expression. Every code point gets the class of its letter,
number, space or other kind; a look at the next two code points turns classes into symbols of an
automaton with eight states. What a block of symbols does to the state is a function from states
to states; such functions compose associatively, so all blocks are composed side by side, a scan
over blocks gives the state in which each block begins, and a second pass over all blocks at once
marks where pre-tokens begin. The slices between the marks go through a cache of merged pairs.
"""

from __future__ import annotations

import base64
import heapq
import struct
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import batches, grouped_texts, texts

RANKS = "byte_bpe_50k.tiktoken"
#: Code points that one pass of the automaton takes, and those of a block in it.
PASS, BLOCK = 1 << 18, 64
#: Pre-tokens that each half of the cache holds, and the longest one that it keeps.
CACHED, LONGEST = 250_000, 64
#: Bytes from which pairs are merged through a heap.
LONG = 48

# -- pre-tokens --------------------------------------------------------------

# Classes of code points.
LETTER, NUMBER, SPACE, BLANK, OTHER, BREAK = range(6)

#: A code point beyond Unicode that stands between texts.
EDGE = 0x110000

# Symbols: a letter, a number, another, an apostrophe with one or two letters that make a
# contraction, a blank and another space before a text, a space before a space or the end, a new text.
S_LETTER, S_NUMBER, S_OTHER, S_SHORT, S_LONG, S_GLUE, S_LONE, S_RUN, S_EDGE = range(9)

# States: a pre-token has just ended, we are in letters, numbers, others, behind a blank that goes
# with what follows, in a run of spaces, one or two letters before the end of a contraction.
ENDED, LETTERS, NUMBERS, OTHERS, GLUED, RUN, ONE_MORE, TWO_MORE = range(8)
STATES = 8


@cache
def classes() -> np.ndarray:
    """The class of each code point, as the tokenizer library knows them and not as the running Python does:
    of all code points, a vocabulary of single bytes encodes only those of a class."""
    every = "".join(chr(c) for c in range(EDGE) if not 0xD800 <= c < 0xE000)
    single = {bytes([b]): b for b in range(256)}
    table = np.full(EDGE + 1, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        only = tiktoken.Encoding(pattern, pat_str=pattern, mergeable_ranks=single, special_tokens={})
        found = bytes(only.encode_ordinary(every)).decode().encode("utf-32-le")
        table[np.frombuffer(found, "<u4")] = kind
    table[0x20], table[EDGE] = BLANK, BREAK
    return table


@cache
def automaton() -> tuple[np.ndarray, np.ndarray]:
    """The next state, and whether a pre-token begins, by symbol and state."""
    to = np.empty((9, STATES), np.uint8)
    begins = np.ones((9, STATES), bool)
    for symbol, state in ((S_LETTER, LETTERS), (S_NUMBER, NUMBERS), (S_OTHER, OTHERS)):
        to[symbol] = state
        begins[symbol, [state, GLUED]] = False
    to[S_LETTER, ONE_MORE], to[S_LETTER, TWO_MORE] = ENDED, ONE_MORE
    begins[S_LETTER, [ONE_MORE, TWO_MORE]] = False
    for symbol, state in ((S_SHORT, ONE_MORE), (S_LONG, TWO_MORE)):
        to[symbol] = state
        to[symbol, [OTHERS, GLUED]] = OTHERS  # within others it is one of them
        begins[symbol, [OTHERS, GLUED]] = False
    to[S_GLUE], to[S_LONE], to[S_RUN], to[S_EDGE] = GLUED, ENDED, RUN, ENDED
    begins[S_RUN, RUN] = False
    return to, begins


def symbols(points: np.ndarray) -> np.ndarray:
    """The symbol of each code point; ``points`` ends with an edge."""
    kind = classes()[points]
    after = np.append(kind[1:], BREAK)
    out = np.full(len(points), S_OTHER, np.uint8)
    out[kind == LETTER] = S_LETTER
    out[kind == NUMBER] = S_NUMBER
    space = (kind == SPACE) | (kind == BLANK)
    run = space & ((after == SPACE) | (after == BLANK) | (after == BREAK))
    out[space & (kind == BLANK)] = S_GLUE
    out[space & (kind == SPACE)] = S_LONE
    out[run] = S_RUN
    out[kind == BREAK] = S_EDGE
    quote = np.flatnonzero(points[:-1] == 0x27)
    if len(quote):
        one = points[quote + 1]
        two = np.where(quote + 2 < len(points), points[np.minimum(quote + 2, len(points) - 1)], EDGE)
        out[quote[np.isin(one, [ord(c) for c in "stmd"])]] = S_SHORT
        e, l = ord("e"), ord("l")
        long = ((one == ord("r")) | (one == ord("v"))) & (two == e) | (one == l) & (two == l)
        out[quote[long]] = S_LONG
    return out


def states_before(sym: np.ndarray) -> np.ndarray:
    """The state of the automaton before each symbol, by a scan over blocks."""
    to, _ = automaton()
    n = -(-len(sym) // BLOCK)
    grid = np.full((n, BLOCK), S_EDGE, np.uint8)
    grid.ravel()[: len(sym)] = sym
    grid = np.ascontiguousarray(grid.T)  # symbols of one position of all blocks together
    flat = to.ravel()
    does = np.tile(np.arange(STATES, dtype=np.uint8), (n, 1))
    for row in grid:  # what each block does to each state
        does = flat[row[:, None].astype(np.int16) * STATES + does]
    step = 1
    while step < n:  # what all blocks up to each one do: an inclusive scan
        does[step:] = np.take_along_axis(does[step:], does[:-step].astype(np.intp), axis=1)
        step *= 2
    state = np.empty(n, np.uint8)
    state[0], state[1:] = ENDED, does[:-1, ENDED]
    before = np.empty((BLOCK, n), np.uint8)
    for at, row in enumerate(grid):
        before[at] = state
        state = flat[row.astype(np.int16) * STATES + state]
    return before.T.ravel()[: len(sym)]


def begins(points: np.ndarray) -> np.ndarray:
    """Where a pre-token begins, or a text ends, in code points with an edge behind each text."""
    sym = symbols(points)
    return np.flatnonzero(automaton()[1][sym, states_before(sym)])


def slices(group: list[str]) -> Iterator[list[str]]:
    """The pre-tokens of each text of the group."""
    whole = (chr(0).join(group) + chr(0)).encode("utf-32-le")
    points = np.frombuffer(whole, "<u4").copy()
    ends = np.cumsum([len(t) + 1 for t in group]) - 1
    points[ends] = EDGE
    marks = begins(points)
    last = np.searchsorted(marks, ends)
    first = 0
    for k, text in enumerate(group):
        own = (marks[first : last[k] + 1] - (ends[k] - len(text))).tolist()
        yield [text[a:b] for a, b in zip(own, own[1:])]
        first = last[k] + 1


# -- pairs -------------------------------------------------------------------


@cache
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def merged(piece: bytes, rank_of: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token: the pair of lowest rank, the first of equals, is joined until
    none is left."""
    if piece in rank_of:
        return [rank_of[piece]]
    if len(piece) > LONG:
        return merged_long(piece, rank_of)
    none, get = 1 << 30, rank_of.get
    bounds = list(range(len(piece) + 1))
    found = [get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
    while found:
        low = min(found)
        if low == none:
            break
        i = found.index(low)
        del bounds[i + 1], found[i]
        if i < len(found):
            found[i] = get(piece[bounds[i] : bounds[i + 2]], none)
        if i:
            found[i - 1] = get(piece[bounds[i - 1] : bounds[i + 1]], none)
    return [rank_of[piece[a:b]] for a, b in zip(bounds, bounds[1:])]


def merged_long(piece: bytes, rank_of: dict[bytes, int]) -> list[int]:
    """As ``merged``, through a heap of pairs and links between parts."""
    n = len(piece)
    end = list(range(1, n + 1))  # of the part that begins here; 0: none does
    before = list(range(-1, n - 1))
    heap: list[tuple[int, int, int, int]] = []

    def offer(a: int) -> None:
        b = end[a]
        if b < n:
            rank = rank_of.get(piece[a : end[b]])
            if rank is not None:
                heapq.heappush(heap, (rank, a, b, end[b]))

    for a in range(n - 1):
        offer(a)
    while heap:
        _, a, b, stop = heapq.heappop(heap)
        if end[a] != b or end[b] != stop:
            continue
        end[a], end[b] = stop, 0
        if stop < n:
            before[stop] = a
        offer(a)
        if before[a] >= 0:
            offer(before[a])
    ids, a = [], 0
    while a < n:
        ids.append(rank_of[piece[a : end[a]]])
        a = end[a]
    return ids


class Encoder:
    """Ids of pre-tokens as little-endian unsigned 32-bit bytes, kept in two halves of a cache:
    when the younger is full, it becomes the older, and the older goes."""

    def __init__(self, path: str):
        self.rank_of = ranks(path)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def __call__(self, pieces: list[str]) -> bytes:
        get = self.young.get
        found = [get(p) for p in pieces]
        if None in found:
            for at, ids in enumerate(found):
                if ids is None:
                    found[at] = self.young.get(pieces[at]) or self.miss(pieces[at])
        return b"".join(found)

    def miss(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            found = merged(piece.encode(), self.rank_of)
            ids = struct.pack(f"<{len(found)}I", *found)
        if len(piece) <= LONGEST:
            if len(self.young) >= CACHED:
                self.old, self.young = self.young, {}
            self.young[piece] = ids
        return ids


class Decoder:
    """Bytes of ids, gathered from one array of all tokens."""

    def __init__(self, path: str):
        by_id = sorted((i, t) for t, i in ranks(path).items())
        size = by_id[-1][0] + 1
        self.length = np.zeros(size, np.int64)
        for i, token in by_id:
            self.length[i] = len(token)
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(t for _, t in by_id), np.uint8)

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """Where the bytes of each id begin in the decoded text."""
        length = self.length[ids]
        return np.cumsum(length) - length

    def __call__(self, ids: np.ndarray, offsets: np.ndarray | None = None) -> bytes:
        length = self.length[ids]
        if offsets is None:
            offsets = np.cumsum(length) - length
        at = np.repeat(self.start[ids] - offsets, length)
        at += np.arange(len(at))
        return self.flat[at].tobytes()


# -- operators ---------------------------------------------------------------


def encode(docs: DataFrame, vocabulary: str = RANKS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and ``ids`` (binary, little-endian unsigned 32-bit).

    Ids are those of ordinary encoding without special tokens. Null and empty texts have none.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def rows(incoming):
        encoder = Encoder(public_tokenizers.path(vocabulary))
        for ids, group in grouped_texts(incoming, PASS):
            for doc_id, pieces in zip(ids, slices(group)):
                yield doc_id, encoder(pieces)

    return texts(docs).mapInArrow(
        lambda incoming: batches(rows(incoming), schema), "doc_id bigint, ids binary"
    )


def decode(encoded: DataFrame, vocabulary: str = RANKS) -> DataFrame:
    """``doc_id, ids, decoded`` (the bytes of the ids) and ``offsets`` (binary, little-endian unsigned
    64-bit: where the bytes of each id begin)."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary()), ("offsets", pa.binary())]
    )

    def rows(incoming):
        decoder = Decoder(public_tokenizers.path(vocabulary))
        for batch in incoming:
            for doc_id, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                packed = packed.as_py()
                ids = np.frombuffer(packed, "<u4").astype(np.int64)
                offsets = decoder.offsets(ids)
                yield doc_id, packed, decoder(ids, offsets), offsets.astype("<u8").tobytes()

    return encoded.select("doc_id", "ids").mapInArrow(
        lambda incoming: batches(rows(incoming), schema),
        "doc_id bigint, ids binary, decoded binary, offsets binary",
    )


def round_trip_digests(decoded: DataFrame) -> DataFrame:
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
