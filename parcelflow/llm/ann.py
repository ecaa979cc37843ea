"""Exact nearest neighbours by inner product through tiles of quantised blocks.

Vectors are scaled to 8-bit integers, each with its own step. Only these codes, with the step, the length and the
length of what rounding took off, are cut into blocks of queries and of candidates. Each pair of blocks is a tile,
multiplied as integers; the lengths give bounds on the real product of each pair. In a tile, and again over all
tiles of a query, the k-th largest lower bound decides which pairs survive: those whose upper bound reaches it.
Survivors fetch their vectors by key, are computed again in double precision, and heaps merge them.

Equal vectors are one candidate with its smallest ids, as many as any list can take, so a vector
that a third of all rows share costs no more than one.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType
from pyspark.sql.window import Window

from parcelflow.llm.common import saved

NEAREST = 20
#: Most distinct candidate vectors and queries of a tile, and bytes of the codes of a block.
CANDIDATES, QUERIES, BLOCK = 1 << 16, 1 << 14, 1 << 24
#: Fewer candidates than that make no tile of their own, and so many tiles there are for tasks to share.
LEAST, TILES = 1 << 14, 64
#: Products that a tile holds at a time, and survivors held when tiles are merged.
PRODUCTS, SURVIVORS = 1 << 20, 1 << 21


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows with an id whose vector is neither null, empty nor zero and whose components are all finite."""
    v = F.col(column)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(
        F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)
    )


def _packed(vectors: DataFrame, column: str) -> tuple[DataFrame, str]:
    """``vec_id, n, vector``, the components as bytes, and their type. Both zeros are one."""
    kind = vectors.schema[column].dataType
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    dtype = "<f4" if single else "<f8"

    def rows(incoming: Iterator[pa.RecordBatch]):
        for batch in incoming:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(dtype) + np.dtype(dtype).type(0)
            n = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            ends = np.cumsum(n)
            vector = pa.array([values[e - m : e].tobytes() for e, m in zip(ends, n)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int32()), vector], names=["vec_id", "n", "vector"]
            )

    plain = vectors.select(F.col("vec_id").cast("bigint"), F.col(column).cast("array<float>" if single else "array<double>"))
    return plain.mapInArrow(rows, "vec_id bigint, n int, vector binary"), dtype


def _matrix(vectors: list[bytes], dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), dtype).reshape(len(vectors), -1).astype(np.float64)


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """8-bit integers, the step of each row, its length after rounding, and the length of the difference."""
    step = np.abs(vectors).max(axis=1) / 127
    step[step == 0] = 1.0
    codes = np.rint(vectors / step[:, None])
    rounded = codes * step[:, None]
    return codes.astype(np.int8), step, _lengths(rounded), _lengths(vectors - rounded)


def _lengths(rows: np.ndarray) -> np.ndarray:
    """Euclidean lengths, scaled so that small and large components neither vanish nor overflow, and a little up."""
    most = np.abs(rows).max(axis=1, initial=0.0)
    scale = np.where(most > 0, most, 1.0)
    return np.sqrt(((rows / scale[:, None]) ** 2).sum(axis=1)) * scale * (1 + 1e-9)


def product_bounds(q: tuple, c: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all inner products of two quantised blocks.

    With x = a + d, y = b + e, of which a and b are rounded: x.y differs from a.b by at most
    |a| |e| + |d| |b| + |d| |e|; a little more allows for the sums of doubles. Integer sums stay below
    2^24 up to 1000 components and are split beyond.
    """
    (a, s, a_length, a_rest), (b, t, b_length, b_rest) = q, c
    n = a.shape[1]
    product = np.zeros((len(a), len(b)))
    for at in range(0, n, 1000):
        product += a[:, at : at + 1000].astype(np.float32) @ b[:, at : at + 1000].astype(np.float32).T
    product *= s[:, None] * t[None, :]
    slack = a_length[:, None] * b_rest + a_rest[:, None] * (b_length + b_rest)
    slack += (a_length + a_rest)[:, None] * ((b_length + b_rest) * ((n + 4) * 4e-16))
    return product - slack, product + slack


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row in double precision; equal vectors give equal numbers wherever they stand."""
    return (a * b).sum(axis=1)


def _coded(rows: DataFrame, dtype: str) -> DataFrame:
    """``key, block, n`` of the rows with codes in place of vectors."""

    def coded(incoming: Iterator[pd.DataFrame]):
        for frame in incoming:
            for _, part in frame.groupby("n", sort=False):
                codes, step, length, rest = quantised(_matrix(part["vector"].tolist(), dtype))
                yield part[["key", "block", "n"]].assign(
                    codes=[row.tobytes() for row in codes], step=step, length=length, rest=rest
                )

    return rows.select("key", "block", "n", "vector").mapInPandas(
        coded, "key bigint, block int, n int, codes binary, step double, length double, rest double"
    )


def _block(frame: pd.DataFrame) -> tuple:
    codes = np.frombuffer(b"".join(frame["codes"]), np.int8).reshape(len(frame), -1)
    return codes, *(frame[c].to_numpy() for c in ("step", "length", "rest"))


def tile(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    """The survivors of each query within a tile: keys and both bounds, as bytes."""
    out: list[tuple] = []
    if len(queries) and len(candidates):
        q, c = _block(queries), _block(candidates)
        asked, keys = queries["key"].to_numpy(), candidates["key"].to_numpy()
        step = max(1, PRODUCTS // len(keys))
        # One more than k: a query's own vector may be among them with no other id.
        kth = min(k + 1, len(keys)) - 1
        for first in range(0, len(asked), step):
            low, high = product_bounds(tuple(x[first : first + step] for x in q), c)
            least = -np.partition(-low, kth, axis=1)[:, kth]
            for r, query in enumerate(asked[first : first + step].tolist()):
                alive = np.flatnonzero(high[r] >= least[r])
                out.append((query, keys[alive].tobytes(), low[r, alive].tobytes(), high[r, alive].tobytes()))
    return pd.DataFrame(out, columns=["query_id", "keys", "low", "high"])


def surviving(frame: pd.DataFrame, k: int) -> pd.DataFrame:
    """The pairs that survive over all tiles of a query."""
    queries, keys = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for own, part in frame.groupby("query_id", sort=False):
        low = np.frombuffer(b"".join(part["low"]))
        kth = min(k + 1, len(low)) - 1
        alive = np.frombuffer(b"".join(part["high"])) >= -np.partition(-low, kth)[kth]
        keys.append(np.unique(np.frombuffer(b"".join(part["keys"]), np.int64)[alive]))
        queries.append(np.full(len(keys[-1]), own, np.int64))
    return pd.DataFrame({"query_id": np.concatenate(queries), "key": np.concatenate(keys)})


def _scored(pairs: DataFrame, dtype: str) -> DataFrame:
    """``query_id, score, vec_id`` of pairs with both vectors and the ``ids`` of the candidate."""

    def scored(incoming: Iterator[pd.DataFrame]):
        for frame in incoming:
            for _, part in frame.groupby("n", sort=False):
                x, y = (_matrix(part[c].tolist(), dtype) for c in ("asked", "vector"))
                found = part[["query_id"]].assign(score=exact_products(x, y), vec_id=part["ids"]).explode("vec_id")
                found["vec_id"] = found["vec_id"].astype("int64")
                yield found[found["vec_id"] != found["query_id"]]

    return pairs.select("query_id", "n", "asked", "vector", "ids").mapInPandas(
        scored, "query_id bigint, score double, vec_id bigint"
    )


def merged(frame: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` nearest of each query among its survivors."""
    out = []
    for own, part in frame.groupby("query_id", sort=False):
        pairs = set(zip((-part["score"]).tolist(), part["vec_id"].tolist()))
        for rank, (minus, i) in enumerate(heapq.nsmallest(k, pairs), 1):
            out.append((own, rank, i, -minus))
    return pd.DataFrame(out, columns=["query_id", "rank", "vec_id", "score"]).astype(
        {"query_id": "int64", "rank": "int32", "vec_id": "int64", "score": "float64"}
    )


def _parts(key: str, n: int):
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def nearest(
    vectors: DataFrame,
    is_query,
    k: int = NEAREST,
    column: str = "embedding",
    candidates: int = CANDIDATES,
    queries: int = QUERIES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` vectors of the largest inner product with each row
    for which ``is_query`` (of ``vec_id``) holds, without its own id; ties go to the smaller id.

    Vectors that are not ``usable`` take no part; vectors are compared with those of their own
    number of components. Repeated rows count once. No query or no candidate: no rows.
    """
    rows, dtype = _packed(usable(vectors, column), column)
    # The smallest k + 1 ids of each vector; Spark cuts the groups before it shuffles them.
    by_vector = Window.partitionBy("vector").orderBy("vec_id")
    distinct = saved(
        rows.withColumn("_rank", F.dense_rank().over(by_vector))
        .where(F.col("_rank") <= k + 1)
        .groupBy("vector")
        .agg(F.collect_set("vec_id").alias("ids"), F.first("n").alias("n"))
        .withColumn("key", F.monotonically_increasing_id())
    )
    asked = saved(rows.where(is_query).dropDuplicates(["vec_id", "vector"]))
    n_distinct, most = distinct.agg(F.count("*"), F.max("n")).first()
    n_asked = asked.count()
    side = max(1, min(candidates, BLOCK // (most or 1)))
    c_blocks = max(1, -(-n_distinct // side), min(TILES, n_distinct // LEAST))
    q_blocks = max(1, -(-n_asked // max(1, min(queries, BLOCK // (most or 1)))))
    left = _coded(
        asked.select(F.col("vec_id").alias("key"), _parts("vec_id", q_blocks).alias("block"), "n", "vector"), dtype
    ).withColumnRenamed("block", "qb").withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))))
    right = _coded(
        distinct.withColumn("block", _parts("key", c_blocks)), dtype
    ).withColumnRenamed("block", "cb").withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    tiles = left.groupBy("n", "qb", "cb").cogroup(right.groupBy("n", "qb", "cb"))
    found = tiles.applyInPandas(lambda q, c: tile(q, c, k), "query_id bigint, keys binary, low binary, high binary")
    # So many queries in a part that what tiles found for them, some 2 k pairs each, can be held.
    together = max(1, min(1024, SURVIVORS // (2 * k * c_blocks)))
    pairs = saved(
        found.groupBy(_parts("query_id", -(-n_asked // together) or 1)).applyInPandas(
            lambda frame: surviving(frame, k), "query_id bigint, key bigint"
        )
    )
    both = pairs.join(distinct, "key").join(
        asked.select(F.col("vec_id").alias("query_id"), "n", F.col("vector").alias("asked")), ["query_id", "n"]
    )
    return _scored(both, dtype).groupBy(_parts("query_id", -(-n_asked // 1024) or 1)).applyInPandas(
        lambda frame: merged(frame, k), "query_id bigint, rank int, vec_id bigint, score double"
    )
