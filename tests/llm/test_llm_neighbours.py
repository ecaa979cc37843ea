import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelflow.llm import ann

SF_DIR = "/root/testdata/sf0.001"


def brute(rows, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and usable(v)]
    found = set()
    for i, q in ok:
        if i % 20:
            continue
        near = {(-float((q * c).sum()), j) for j, c in ok if j != i and len(c) == len(q)}
        found |= {(i, rank, j, -s) for rank, (s, j) in enumerate(sorted(near)[:k], 1)}
    return sorted(found)


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def search(spark, rows, k, **sizes):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, score string").repartition(3)
    got = ann.nearest(df, F.col("vec_id") % 20 == 0, k, **sizes)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, got.collect()))


def test_smallest_table(spark):
    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    got = sorted(map(tuple, ann.nearest(vectors, F.col("vec_id") % 20 == 0).collect()))
    assert got == brute(rows, ann.NEAREST)


@pytest.mark.parametrize("sizes", [{}, {"candidates": 7, "queries": 2}])
def test_ties_copies_and_unusable_vectors(spark, sizes):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(120)]
    rows += [(200 + i, [1.0, 2.0, 0.0, -1.0]) for i in range(60)]  # one common vector, some of them queries
    rows += [(400, None), (401, []), (402, [0.0] * 4), (403, [1.0, None, 1.0, 1.0]), (404, [float("nan")] * 4)]
    rows += [(420, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4), (440, [1.0, 2.0]), (441, [3.0, 1.0])]
    rows += rows[:5]
    assert search(spark, [(i, v, "x") for i, v in rows], 6, **sizes) == brute(rows, 6)


def test_large_and_small_components(spark):
    rng = np.random.default_rng(9)
    rows = [(i, np.float32(rng.normal(size=5) * 10.0 ** rng.integers(-8, 9)).tolist()) for i in range(100)]
    assert search(spark, [(i, v, None) for i, v in rows], 20) == brute(rows, 20)


def test_nothing_to_search(spark):
    assert search(spark, [], 5) == []
    assert search(spark, [(20, [1.0], "x")], 5) == []
    assert search(spark, [(1, [1.0], "x"), (2, [2.0], "x")], 5) == []


def test_bounds_hold():
    rng = np.random.default_rng(10)
    a, b = rng.normal(size=(30, 1500)) * 3, rng.normal(size=(40, 1500))
    low, high = ann.product_bounds(ann.quantised(a), ann.quantised(b))
    real = a @ b.T
    assert (low <= real).all() and (real <= high).all()
