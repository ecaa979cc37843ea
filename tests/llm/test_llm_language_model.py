import math
import zlib
from collections import Counter

import numpy as np
import odd_documents as odd
import pytest
from pyspark.sql import functions as F

from parcelflow.llm import language_model as lm

SF_DIR = "/root/testdata/sf0.001"


def tokens(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            out += [word] if word else []
            word = ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    return [*out, "END"]


def grams(text, order):
    """For each token: the n-grams that end there, and their contexts, for n = 1 to ``order``."""
    seq = ["START"] * (order - 1) + tokens(text)
    return [[tuple(seq[i - n + 1 : i + 1]) for n in range(1, order + 1)] for i in range(order - 1, len(seq))]


class Plain:
    """The same model by dictionaries, one token at a time."""

    def __init__(self, rows, deleted, order):
        self.order, self.rows = order, rows
        train = [(i, t) for i, t in rows if not self.held_out(i)]
        self.all = self.count(train)
        kept = self.count([(i, t) for i, t in train if i not in deleted])
        self.distinct = sum(1 for g in self.all if len(g) == 1 and g != ("START",))
        self.weights = np.full((order, lm.BUCKETS), 0.5)
        self.weights[:, 0] = 0
        for _ in range(lm.ITERATIONS):
            added = np.zeros((order, lm.BUCKETS, 2))
            for i, t in train:
                if i in deleted:
                    for each in grams(t, order):
                        self.share_out(each, kept, added)
            for n in range(order):
                for b in range(1, lm.BUCKETS):
                    if added[n, b, 1]:
                        self.weights[n, b] = min(added[n, b, 0] / added[n, b, 1], lm.MOST)

    @staticmethod
    def held_out(i):
        return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2

    def count(self, rows):
        out = Counter()
        for _, t in rows:
            for n in range(1, self.order):
                out[("START",) * n] += 1
            for each in grams(t, self.order):
                out.update(each)
                out["tokens"] += 1
        return out

    def steps(self, each, counts):
        p, out = 1 / (self.distinct + 1), []
        for n, gram in enumerate(each):
            context = counts[gram[:-1]] if n else counts["tokens"]
            f = counts[gram] / context if context else 0.0
            b = min(int(math.log2(context)) + 1, lm.BUCKETS - 1) if context else 0
            p = self.weights[n, b] * f + (1 - self.weights[n, b]) * p
            out.append((f, b, p))
        return out

    def share_out(self, each, counts, added):
        reach = 1.0
        for n, (f, b, p) in reversed(list(enumerate(self.steps(each, counts)))):
            own = reach * self.weights[n, b] * f / p
            added[n, b] += own, reach
            reach = max(reach - own, 0.0)

    def row(self, i, t):
        counts, base, score = self.all, 0.0, 0.0
        each = grams(t, self.order)
        for g in each:
            base += math.log10((counts[g[0]] + 1) / (counts["tokens"] + self.distinct + 1))
            score += math.log10(self.steps(g, counts)[-1][2])
        known = sum(counts[g[0]] > 0 for g in each)
        return i, self.held_out(i), len(each), known, counts["tokens"], base, score


def check(spark, docs, order, **sizes):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    flagged = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(lm.DELETED)) == 0)
    plain = Plain(rows, {r.doc_id for r in flagged.collect()}, order)
    got = odd.rows_of(lm.score_documents(docs, order, **sizes), *lm.RESULT)
    want = sorted((plain.row(i, t) for i, t in rows), key=repr)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want):
        assert a[5:] == pytest.approx(b[5:], rel=1e-4)  # weights are learned on single precision
        assert a[5] == pytest.approx(b[5], rel=1e-11)
    return got


@pytest.mark.parametrize("order, sizes", [(2, {}), (3, {"chunk": 20_000, "range_size": 3000})])
def test_smallest_table(spark, order, sizes):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(3)
    got = check(spark, docs, order, **sizes)
    held_out = [r for r in got if r[1]]
    assert sum(r[6] for r in held_out) > sum(r[5] for r in held_out)


def test_odd_documents(spark):
    check(spark, odd.documents(spark), 2)
    assert lm.score_documents(odd.empty(spark)).count() == 0


def test_probabilities_of_a_context_sum_to_one():
    rng = np.random.default_rng(4)
    weights = rng.random((2, lm.BUCKETS))
    counts, pair = rng.integers(1, 9, 6), rng.integers(0, 5, 6)
    f1, f2 = counts / counts.sum(), pair / pair.sum()
    places = [np.full(6, 3), np.full(6, 2)]
    known = lm.probabilities([f1, f2], places, weights, 6)[-1].sum()
    unknown = lm.probabilities([np.zeros(1), np.zeros(1)], [p[:1] for p in places], weights, 6)[-1][0]
    assert known + unknown == pytest.approx(1)
