"""N-gram language model by deleted interpolation.

p_0 is uniform, and p_n(w | context) = a f(w | context) + (1 - a) p_(n-1)(w | shorter context), where
f is the maximum-likelihood estimate and the weight a depends on how often the context was seen (one
weight for each power of two). A sixteenth of the training documents is deleted: expectation
maximisation learns the weights on it against the counts of the rest, and the counts of all training
documents then make the model.

The corpus is cut into chunks of documents. A chunk asks for the counts of its distinct n-grams, sorted
by hash and dealt to ranges of hashes; a range adds up what the chunks bring and answers each of them;
the answers meet the chunk again, where texts are scored. So an n-gram is shuffled once for each chunk
that holds it, however often it occurs there, and no task holds more than a chunk or a range. N-grams
are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import batches, crc_of_id, saved, texts

#: Longest n-gram.
ORDER = 2
#: Code points of a chunk, and distinct n-grams that a range of hashes answers, about.
CHUNK, RANGE = 1 << 21, 1 << 20
#: One of so many training documents is deleted to learn the weights on.
DELETED = 16
ITERATIONS = 10
#: Buckets of context counts, by powers of two; bucket 0 has the contexts never seen.
BUCKETS = 40
#: No weight comes closer to one, so that no text gets probability zero.
MOST = 1 - 1e-6

RESULT = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")

_MIX, _START = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x5851F42D4C957F2D)


# -- arrays ------------------------------------------------------------------


def squeezed(values: np.ndarray) -> bytes:
    """Integers by planes of bytes, compressed: the empty upper planes cost nothing."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def unsqueezed(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def tokens(text: str) -> list[bytes]:
    """Words in lower case (A-Z only) between blanks, tabs and line ends, then the end, ``b""``."""
    found = text.encode().lower().split()
    found.append(b"")
    return found


def grams(ids: np.ndarray, words: list[bytes], sizes: np.ndarray, order: int) -> list[np.ndarray]:
    """Hashes of the n-grams that end at each token, for n = 1 to ``order``. Before a text stands a
    start, so its first tokens have n-grams of every length."""
    of_word = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)[ids]
    first = np.cumsum(sizes) - sizes
    found, before = [of_word], _START
    for n in range(2, order + 1):
        context = np.empty_like(of_word)
        context[1:] = found[-1][:-1]
        context[first] = before
        before = _mixed(np.array([before]), _START)[0]
        found.append(_mixed(context, of_word))
    return found


def _mixed(context: np.ndarray, word) -> np.ndarray:
    h = (context * _MIX) ^ word
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


# -- chunks ------------------------------------------------------------------

_CHUNK = pa.schema(
    [
        ("deleted", pa.bool_()),
        ("doc_ids", pa.list_(pa.string())),
        ("train", pa.list_(pa.bool_())),
        ("sizes", pa.list_(pa.int64())),
        ("words", pa.binary()),
        ("ids", pa.binary()),
    ]
)


class _Chunk:
    """Documents gathered into a chunk; words are numbered as they come, so that frequent ones get
    small numbers."""

    def __init__(self, deleted: bool):
        self.deleted, self.doc_ids, self.train, self.sizes = deleted, [], [], []
        self.words: dict[bytes, int] = {b"": 0}
        self.ids: list[np.ndarray] = []
        self.points = 0

    def add(self, doc_id, train: bool, text: str) -> None:
        found = tokens(text)
        words = self.words
        for word in set(found).difference(words):
            words[word] = len(words)
        self.ids.append(np.fromiter(map(words.__getitem__, found), np.uint32, len(found)))
        self.doc_ids.append(None if doc_id is None else str(doc_id))
        self.train.append(train)
        self.sizes.append(len(found))
        self.points += len(text) + 1

    def row(self) -> tuple:
        words = zstandard.compress(b"\n".join(self.words), 3)
        return self.deleted, self.doc_ids, self.train, self.sizes, words, squeezed(np.concatenate(self.ids))


def chunks(docs: DataFrame, size: int = CHUNK) -> DataFrame:
    """Documents, with ``train`` and ``deleted`` flags, as written rows of about ``size`` code points."""

    def rows(incoming: Iterator[pa.RecordBatch]):
        held = {deleted: _Chunk(deleted) for deleted in (False, True)}
        for batch in incoming:
            for doc_id, train, deleted, text in zip(*(c.to_pylist() for c in batch.columns)):
                held[deleted].add(doc_id, train, text)
                if held[deleted].points >= size:
                    yield held[deleted].row()
                    held[deleted] = _Chunk(deleted)
        yield from (c.row() for c in held.values() if c.doc_ids)

    made = docs.select("doc_id", "train", "deleted", "text").mapInArrow(
        lambda incoming: batches(rows(incoming), _CHUNK, 1),
        "deleted boolean, doc_ids array<string>, train array<boolean>, sizes array<bigint>, words binary, ids binary",
    )
    return saved(made.withColumn("chunk", F.monotonically_increasing_id()))


def _opened(row, order: int) -> tuple[np.ndarray, list[np.ndarray]]:
    sizes = np.asarray(row["sizes"], np.int64)
    words = zstandard.decompress(row["words"]).split(b"\n")
    return sizes, grams(unsqueezed(row["ids"]).astype(np.int64), words, sizes, order)


# -- counts ------------------------------------------------------------------


def asked(chunked: DataFrame, ranges: int, order: int) -> DataFrame:
    """For each chunk, length of n-gram and range of hashes: the distinct hashes, rising, and how often
    training documents of the chunk hold each."""
    schema = pa.schema(
        [
            ("chunk", pa.int64()),
            ("deleted", pa.bool_()),
            ("n", pa.int32()),
            ("range", pa.int64()),
            ("hashes", pa.binary()),
            ("counts", pa.binary()),
        ]
    )
    edges = np.array([(k << 64) // ranges for k in range(1, ranges)], np.uint64)

    def rows(incoming: Iterator[pa.RecordBatch]):
        for batch in incoming:
            for row in batch.to_pylist():
                sizes, found = _opened(row, order)
                train = np.repeat(np.array(row["train"], np.float64), sizes)
                for n, hashes in enumerate(found, 1):
                    distinct, at = np.unique(hashes, return_inverse=True)
                    count = np.bincount(at, train, len(distinct)).astype(np.uint64)
                    cut = [0, *np.searchsorted(distinct, edges).tolist(), len(distinct)]
                    for k, (a, b) in enumerate(zip(cut, cut[1:])):
                        if a < b:
                            steps = np.diff(distinct[a:b], prepend=np.uint64(0))
                            yield row["chunk"], row["deleted"], n, k, squeezed(steps), squeezed(count[a:b])

    return chunked.select("chunk", "deleted", "train", "sizes", "words", "ids").mapInArrow(
        lambda incoming: batches(rows(incoming), schema, 64),
        "chunk bigint, deleted boolean, n int, range bigint, hashes binary, counts binary",
    )


def _answer(frame: pd.DataFrame) -> pd.DataFrame:
    hashes = [np.cumsum(unsqueezed(h)) for h in frame["hashes"]]
    counts = np.concatenate([unsqueezed(c) for c in frame["counts"]]).astype(np.float64)
    sizes = [len(h) for h in hashes]
    distinct, at = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.bincount(at, counts, len(distinct)).astype(np.uint64)
    deleted = np.repeat(frame["deleted"].to_numpy(np.float64), sizes)
    gone = np.bincount(at, counts * deleted, len(distinct)).astype(np.uint64)
    ends = np.cumsum(sizes)
    parts = [at[e - s : e] for s, e in zip(sizes, ends)]
    out = pd.DataFrame(
        {
            "chunk": frame["chunk"],
            "n": frame["n"],
            "range": frame["range"],
            "total": [squeezed(total[p]) for p in parts],
            "gone": [squeezed(gone[p]) if d else b"" for p, d in zip(parts, frame["deleted"])],
            "tokens": 0,
            "kept_tokens": 0,
            "distinct": 0,
        }
    )
    # The sums of the range go with its first answer.
    out.loc[0, ["tokens", "kept_tokens", "distinct"]] = [
        int(total.sum()),
        int((total - gone).sum()),
        int((total > 0).sum()),
    ]
    return out


def answers(chunked: DataFrame, order: int, range_size: int = RANGE) -> DataFrame:
    """The counts that each chunk asked for, in the order of its hashes: of all training documents
    (``total``), and of the deleted ones (``gone``) where the chunk holds those."""
    size = chunked.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, b: a + b))).first()[0] or 0
    ranges = max(1, -(-size // range_size))
    return saved(
        asked(chunked, ranges, order)
        .groupBy("n", "range")
        .applyInPandas(
            _answer,
            "chunk bigint, n int, range bigint, total binary, gone binary, tokens bigint, kept_tokens bigint, distinct bigint",
        )
    )


class Sums:
    """Training tokens, distinct ones and documents, with and without the deleted documents."""

    def __init__(self, chunked: DataFrame, answered: DataFrame):
        row = answered.where("n = 1").agg(F.sum("tokens"), F.sum("kept_tokens"), F.sum("distinct")).first()
        self.tokens, self.kept_tokens, self.distinct = (int(x or 0) for x in row)
        trained = F.size(F.filter("train", lambda t: t))
        row = chunked.agg(F.sum(trained), F.sum(F.when(~F.col("deleted"), trained))).first()
        self.docs, self.kept_docs = (int(x or 0) for x in row)


# -- model -------------------------------------------------------------------


def buckets(context: np.ndarray) -> np.ndarray:
    """0 for a context never seen, then one for each power of two."""
    return np.where(context > 0, np.minimum(np.log2(np.maximum(context, 1)).astype(int) + 1, BUCKETS - 1), 0)


def estimates(row, replies: pd.DataFrame, order: int, sums: Sums, kept: bool) -> tuple[list, list, np.ndarray, np.ndarray]:
    """For each token of a chunk: f and bucket of each length of n-gram, and the count of the token;
    with ``kept``, of counts without the deleted documents. Also the sizes of texts."""
    sizes, found = _opened(row, order)
    first = np.cumsum(sizes) - sizes
    n_tokens, n_docs = (sums.kept_tokens, sums.kept_docs) if kept else (sums.tokens, sums.docs)
    replies = replies.sort_values(["n", "range"])
    context = np.full(len(found[0]), float(n_tokens))
    shares, places, counted = [], [], []
    for n, hashes in enumerate(found, 1):
        part = replies[replies["n"] == n]
        total = np.concatenate([unsqueezed(t) for t in part["total"]]).astype(np.float64)
        if kept:
            total -= np.concatenate([unsqueezed(g) for g in part["gone"]]).astype(np.float64)
        count = total[np.unique(hashes, return_inverse=True)[1]]
        counted.append(count)
        shares.append(np.divide(count, context, out=np.zeros_like(count), where=context > 0))
        places.append(buckets(context))
        # The n-gram before each token is the context of the next length.
        context = np.empty_like(count)
        context[1:] = count[:-1]
        context[first] = n_docs
    return shares, places, counted[0], sizes


def probabilities(shares: list, places: list, weights: np.ndarray, distinct: int) -> list[np.ndarray]:
    """p_0 to p_n of each token."""
    p = [np.full(len(shares[0]), 1.0 / (distinct + 1))]
    for n, (f, b) in enumerate(zip(shares, places)):
        a = weights[n][b]
        p.append(a * f + (1 - a) * p[-1])
    return p


def responsibilities(shares: list, places: list, times, weights: np.ndarray, distinct: int) -> np.ndarray:
    """What an iteration adds up, by length and bucket, over tokens that occur ``times``: the chance that
    a token came from the estimate of that length, and that it came from this one or a shorter one."""
    p = probabilities(shares, places, weights, distinct)
    out = np.zeros((len(shares), BUCKETS, 2))
    reach = np.ones(len(p[0]))  # the chance that no longer length made the token
    for n in range(len(shares) - 1, -1, -1):
        own = reach * weights[n][places[n]] * shares[n] / p[n + 1]
        out[n, :, 0] = np.bincount(places[n], own * times, BUCKETS)
        out[n, :, 1] = np.bincount(places[n], reach * times, BUCKETS)
        reach = np.maximum(reach - own, 0.0)
    return out


def first_weights(order: int) -> np.ndarray:
    weights = np.full((order, BUCKETS), 0.5)
    weights[:, 0] = 0.0
    return weights


def learned(weights: np.ndarray, added: np.ndarray) -> np.ndarray:
    """Weights after an iteration; buckets without tokens keep theirs."""
    reached = added[:, :, 1] > 0
    new = weights.copy()
    new[reached] = np.minimum(added[:, :, 0][reached] / added[:, :, 1][reached], MOST)
    new[:, 0] = 0.0
    return new


def _meet(chunked: DataFrame, answered: DataFrame):
    return chunked.groupBy("chunk").cogroup(
        answered.select("chunk", "n", "range", "total", "gone").groupBy("chunk")
    )


def fit_weights(chunked: DataFrame, answered: DataFrame, order: int, sums: Sums) -> np.ndarray:
    """Weights by length and bucket, from the deleted documents, whose estimates are written once and
    read in each iteration. Without such documents all weights are one half."""

    def held(chunk: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        if not len(chunk):
            return pd.DataFrame({"shares": [], "places": [], "times": []})
        shares, places, _, _ = estimates(chunk.iloc[0], replies, order, sums, kept=True)
        # Equal tokens are one row with their number.
        table = np.rec.fromarrays([*(f.astype("<f4") for f in shares), *(p.astype("u1") for p in places)])
        distinct, times = np.unique(table, return_counts=True)
        columns = [distinct[name] for name in distinct.dtype.names]
        return pd.DataFrame(
            {
                "shares": [np.concatenate(columns[:order]).tobytes()],
                "places": [np.concatenate(columns[order:]).tobytes()],
                "times": [times.astype("<u4").tobytes()],
            }
        )

    part = chunked.where("deleted")
    table = saved(
        _meet(part, answered.where("length(gone) > 0")).applyInPandas(
            held, "shares binary, places binary, times binary"
        )
    )
    weights = first_weights(order)
    for _ in range(ITERATIONS):
        added = _added(table, weights, order, sums.distinct)
        weights = learned(weights, added)
    return weights


def _added(table: DataFrame, weights: np.ndarray, order: int, distinct: int) -> np.ndarray:
    def rows(incoming: Iterator[pa.RecordBatch]):
        out = np.zeros((order, BUCKETS, 2))
        for batch in incoming:
            for row in batch.to_pylist():
                shares = np.frombuffer(row["shares"], "<f4").reshape(order, -1).astype(np.float64)
                places = np.frombuffer(row["places"], "u1").reshape(order, -1).astype(np.int64)
                times = np.frombuffer(row["times"], "<u4")
                out += responsibilities(list(shares), list(places), times, weights, distinct)
        for n, b in np.argwhere(out[:, :, 1] > 0).tolist():
            yield n, b, float(out[n, b, 0]), float(out[n, b, 1])

    schema = pa.schema([("n", pa.int32()), ("b", pa.int32()), ("own", pa.float64()), ("reach", pa.float64())])
    sums = (
        table.mapInArrow(lambda incoming: batches(rows(incoming), schema), "n int, b int, own double, reach double")
        .groupBy("n", "b")
        .agg(F.sum("own"), F.sum("reach"))
        .collect()  # at most order x BUCKETS rows
    )
    out = np.zeros((order, BUCKETS, 2))
    for n, b, own, reach in sums:
        out[n, b] = own, reach
    return out


def score_documents(docs: DataFrame, order: int = ORDER, chunk: int = CHUNK, range_size: int = RANGE) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Documents whose crc32(doc_id) modulo 7 is 2 are held out; the others are learned from. Null and empty
    texts have one token, their end. ``base_score`` is the add-one unigram model, ``score`` the model above,
    both as log10 of the text's probability. An empty table gives no rows.
    """
    held_out = F.pmod(crc_of_id(), F.lit(7)) == 2
    deleted = ~held_out & (F.pmod(F.xxhash64("doc_id"), F.lit(DELETED)) == 0)
    chunked = chunks(texts(docs).withColumns({"train": ~held_out, "deleted": deleted}), chunk)
    answered = answers(chunked, order, range_size)
    sums = Sums(chunked, answered)
    weights = fit_weights(chunked, answered, order, sums)

    def scored(rows: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame(columns=RESULT)
        row = rows.iloc[0]
        shares, places, count, sizes = estimates(row, replies, order, sums, kept=False)
        p = probabilities(shares, places, weights, sums.distinct)[-1]
        first = np.cumsum(sizes) - sizes
        base = np.log10((count + 1) / (sums.tokens + sums.distinct + 1))
        return pd.DataFrame(
            {
                "doc_id": pd.array([None if i is None else int(i) for i in row["doc_ids"]], "Int64"),
                "held_out": ~np.asarray(row["train"], bool),
                "n_tokens": sizes,
                "n_known": np.add.reduceat((count > 0).astype(np.int64), first),
                "train_tokens": sums.tokens,
                "base_score": np.add.reduceat(base, first),
                "score": np.add.reduceat(np.log10(p), first),
            }
        )

    return _meet(chunked, answered).applyInPandas(
        scored,
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    )
