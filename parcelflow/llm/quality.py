"""Document quality from heuristic labellers without labels.

Labellers look at one side of a text each and vote junk, good or nothing. Expectation maximisation over
the counts of all vote patterns estimates how often each labeller votes what on good and on junk texts,
and with that the posterior of each pattern. The posteriors of a bounded sample are the targets of a
linear scorer over hashed shapes of tokens, which then scores every text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import about, batches, find_package, grouped_texts, saved, texts, whole_row

JUNK, NOTHING, GOOD = 0, 1, 2

#: Texts that the scorer learns from, about, if there are more.
SAMPLE = 20_000
BUCKETS = 1 << 12
EPOCHS, RATE, DECAY = 150, 0.1, 1e-5
EM_ROUNDS = 60
#: A document stays if the scorer gives it this chance of being good.
THRESHOLD = 0.5
CACHED = 200_000
GROUP_POINTS = 1 << 20

# Marks that ordinary prose has at the end of words.
PROSE = frozenset(".,;:!?'\"()-")


# -- what is seen of a text --------------------------------------------------

# Columns of the record of a token.
LETTERS, UPPER, SIGNS, SHOUT, BARE, SHAPE = range(6)


def shape(token: str) -> str:
    """Letters as a or A, digits as 9, other characters as they are; runs as one, or two for longer."""
    out = []
    for c in token:
        s = ("A" if c.isupper() else "a") if c.isalpha() else "9" if c.isdigit() else c
        if len(out) < 2 or out[-1] != s or out[-2] != s:
            out.append(s)
    return "".join(out)


def record(token: str) -> list[int]:
    word = token.rstrip(".,")
    if word.isalpha() and len(token) - len(word) < 2 and (word.islower() or word[1:].islower()):
        # The common case of a plain word, with or without a mark.
        first = "" if word[0].islower() else "A"
        form = first + "a" * min(2, len(word) - len(first)) + token[len(word) :]
        if first and not word[0].isupper():
            form = shape(token)
        return [len(word), int(word[0].isupper()), 0, 0, 0, _bucket(form)]
    letters = [c for c in token if c.isalpha()]
    signs = sum(1 for c in token if not c.isalnum() and c not in PROSE)
    last = token[-1]
    return [
        len(letters),
        sum(c.isupper() for c in letters),
        signs,
        int(len(token) > 1 and not last.isalnum() and token[-2] == last),
        int(not any(c.isalnum() for c in token)),
        _bucket(shape(token)),
    ]


def _bucket(form: str) -> int:
    return zlib.crc32(form.encode()) % (BUCKETS - len(EXTRA))


# Features besides shapes: in the last buckets.
EXTRA = ("same as the token before", "seen earlier in the text")


class Reader:
    """Records of tokens, kept by token."""

    def __init__(self):
        self.known: dict[str, int] = {}
        self.table = np.zeros((1024, 6), np.int64)

    def records(self, group: list[list[str]]) -> list[np.ndarray]:
        new = [t for t in set().union(*group) if t not in self.known]
        if len(self.known) + len(new) > CACHED:
            self.known, new = {}, list(set().union(*group))
        size = len(self.known) + len(new)
        if size > len(self.table):
            grown = np.zeros((max(size, 2 * len(self.table)), 6), np.int64)
            grown[: len(self.known)] = self.table[: len(self.known)]
            self.table = grown
        for t in new:
            self.table[len(self.known)] = record(t)
            self.known[t] = len(self.known)
        return [np.array([self.known[t] for t in tokens], np.int64) for tokens in group]


class View:
    """One text as the labellers and the scorer see it."""

    def __init__(self, text: str, tokens: list[str], ids: np.ndarray, table: np.ndarray):
        self.text, self.tokens, self.n = text, tokens, len(ids)
        self.ids, self.rows = ids, table[ids]
        self.sums = self.rows[:, :SHAPE].sum(axis=0)
        self.same = int((ids[1:] == ids[:-1]).sum()) if self.n > 1 else 0

    def share(self, column: int) -> float:
        return self.sums[column] / max(1, self.n)

    def void(self) -> bool:
        return not self.sums[LETTERS]

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """Buckets and the roots of their shares; the extra features count places, not tokens."""
        n = max(1, self.n)
        bucket, times = np.unique(self.rows[:, SHAPE], return_counts=True)
        again = self.n - len(np.unique(self.ids))
        extra = np.array([self.same, again])
        bucket = np.append(bucket, BUCKETS - len(EXTRA) + np.arange(len(EXTRA)))
        return bucket, np.sqrt(np.append(times, extra) / n)


# -- labellers ---------------------------------------------------------------


def _band(value: float, good: float, junk: float) -> int:
    """Good up to one bound, junk from another on, nothing between."""
    return GOOD if value <= good else JUNK if value >= junk else NOTHING


def shouting(v: View) -> int:
    return _band(v.sums[UPPER] / max(1, v.sums[LETTERS]), 0.2, 0.4) if v.n >= 3 else NOTHING


def odd_signs(v: View) -> int:
    return _band(v.share(SIGNS), 0.1, 0.35) if v.n >= 3 else NOTHING


def piled_marks(v: View) -> int:
    return _band(v.share(SHOUT), 0.05, 0.2) if v.n >= 3 else NOTHING


def loose_signs(v: View) -> int:
    return _band(v.share(BARE), 0.05, 0.15) if v.n >= 3 else NOTHING


def stuttering(v: View) -> int:
    return _band(v.same / max(1, v.n - 1), 0.1, 0.3) if v.n >= 8 else NOTHING


def pressing(v: View) -> int:
    """How far the text can be compressed; short texts hardly can."""
    if len(v.text) < 400:
        return NOTHING
    data = v.text.encode()
    return _band(1 - len(zlib.compress(data, 1)) / len(data), 0.72, 0.85)


def sentences(v: View) -> int:
    """Words per sentence end."""
    if v.n < 20:
        return NOTHING
    ends = v.text.count(". ") + v.text.count(".\n") + v.text.endswith(".")
    words = v.n / max(1, ends)
    return GOOD if 2 <= words <= 40 and ends else JUNK if words > 150 or not ends else NOTHING


LABELLERS = (shouting, odd_signs, piled_marks, loose_signs, stuttering, pressing, sentences)


def views(reader: Reader, group: list[str]) -> Iterator[View]:
    tokens = [t.split() for t in group]
    for text, own, ids in zip(group, tokens, reader.records(tokens)):
        yield View(text, own, ids, reader.table)


def votes(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``votes`` (one digit for each of ``LABELLERS``), the hashed
    ``buckets`` and ``parts`` of the text, and whether it is ``void``, without a letter."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("votes", pa.string()),
            ("buckets", pa.list_(pa.int32())),
            ("parts", pa.list_(pa.float32())),
            ("void", pa.bool_()),
        ]
    )

    def rows(incoming: Iterator[pa.RecordBatch]):
        reader = Reader()
        for ids, group in grouped_texts(incoming, GROUP_POINTS):
            for doc_id, view in zip(ids, views(reader, group)):
                bucket, part = view.features()
                given = "".join(str(f(view)) for f in LABELLERS)
                yield doc_id, given, bucket, part.astype(np.float32), view.void()

    return texts(docs).mapInArrow(
        lambda incoming: batches(rows(incoming), schema),
        "doc_id bigint, votes string, buckets array<int>, parts array<float>, void boolean",
    )


# -- accuracies --------------------------------------------------------------


class LabelModel:
    """Prior of good texts and, by labeller and class, the chances of its votes where it votes. Not to
    vote says nothing: it comes from the length of a text rather than from its class."""

    def __init__(self, prior: float, chance: np.ndarray):
        self.prior = prior
        self.chance = chance.copy()  # labellers x (junk, good) x votes
        self.chance[:, :, NOTHING] = 0
        self.chance /= self.chance.sum(axis=2, keepdims=True)
        self.chance[:, :, NOTHING] = 1

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """The chance that a text with these votes is good."""
        each = np.log(self.chance)[np.arange(patterns.shape[1]), :, patterns].sum(axis=1)
        odds = each[:, 1] - each[:, 0] + np.log(self.prior) - np.log1p(-self.prior)
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))

    def accuracy(self) -> np.ndarray:
        """How often each labeller is right where it votes."""
        right = self.prior * self.chance[:, 1, GOOD] + (1 - self.prior) * self.chance[:, 0, JUNK]
        wrong = self.prior * self.chance[:, 1, JUNK] + (1 - self.prior) * self.chance[:, 0, GOOD]
        return right / np.maximum(right + wrong, 1e-12)


def learn_accuracies(patterns: np.ndarray, times: np.ndarray, rounds: int = EM_ROUNDS) -> LabelModel:
    """Expectation maximisation over vote patterns and their numbers. It starts from labellers that
    are rather right, which also says which class is which."""
    m = patterns.shape[1]
    start = np.array([[0.5, 0, 0.5], [0.03, 0, 0.97]])
    model = LabelModel(0.8, np.tile(start, (m, 1, 1)))
    if not len(patterns):
        return model
    seen = patterns[:, :, None] == np.arange(3)  # patterns x labellers x votes
    for _ in range(rounds):
        good = model.posterior(patterns)
        weight = np.stack([(1 - good) * times, good * times], axis=1)
        counts = np.einsum("pc,pmv->mcv", weight, seen) + start  # as one text that fits the start
        model = LabelModel(
            float(np.clip(weight[:, 1].sum() / times.sum(), 0.01, 0.99)), counts
        )
    return model


# -- scorer ------------------------------------------------------------------


def train_scorer(buckets: list, parts: list, target: np.ndarray, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Logistic regression on posteriors, full-batch Adam."""
    weight, bias = np.zeros(BUCKETS), 0.0
    if not len(target):
        return weight, bias
    row = np.repeat(np.arange(len(target)), [len(b) for b in buckets])
    column, value = np.concatenate(buckets).astype(np.int64), np.concatenate(parts).astype(np.float64)
    # Both classes weigh the same.
    share = np.clip(target.mean(), 0.01, 0.99)
    importance = target / share + (1 - target) / (1 - share)
    importance /= importance.sum()
    params = np.zeros(BUCKETS + 1)
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, epochs + 1):
        logit = np.bincount(row, params[column] * value, len(target)) + params[-1]
        error = (1 / (1 + np.exp(-np.clip(logit, -500, 500))) - target) * importance
        slope = np.append(np.bincount(column, error[row] * value, BUCKETS), error.sum()) + DECAY * params
        first += 0.1 * (slope - first)
        second += 0.001 * (slope * slope - second)
        params -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return params[:-1], float(params[-1])


def fit(docs: DataFrame) -> tuple[LabelModel, np.ndarray, float, DataFrame]:
    """The label model over all documents, the scorer over a bounded sample, and the written votes."""
    voted = saved(votes(docs))
    seen = voted.where("NOT void")
    # At most 3 ** labellers patterns.
    counts = seen.groupBy("votes").count().orderBy("votes").collect()
    patterns = np.array([[int(c) for c in r["votes"]] for r in counts], np.int64).reshape(-1, len(LABELLERS))
    model = learn_accuracies(patterns, np.array([r["count"] for r in counts], np.float64))
    drawn = about(seen, SAMPLE).select("votes", "buckets", "parts").toPandas()
    given = np.array([[int(c) for c in v] for v in drawn["votes"]], np.int64).reshape(-1, len(LABELLERS))
    weight, bias = train_scorer(list(drawn["buckets"]), list(drawn["parts"]), model.posterior(given))
    return model, weight, bias, voted


def quality(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, votes, posterior`` (of being good, by the votes), ``score`` (by
    the scorer) and ``accepted``. A text without letters, as an empty or null one, has posterior and score 0."""
    model, weight, bias, voted = fit(docs)
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("votes", pa.string()),
            ("posterior", pa.float64()),
            ("score", pa.float64()),
            ("accepted", pa.bool_()),
        ]
    )

    def rows(incoming: Iterator[pa.RecordBatch]):
        for batch in incoming:
            for doc_id, given, bucket, part, void in zip(*(c.to_pylist() for c in batch.columns)):
                if void:
                    yield doc_id, given, 0.0, 0.0, False
                    continue
                logit = float(weight[bucket] @ np.array(part)) + bias
                good = float(model.posterior(np.array([[int(c) for c in given]]))[0])
                chance = float(1 / (1 + np.exp(-np.clip(logit, -500, 500))))
                yield doc_id, given, good, chance, chance >= THRESHOLD

    return voted.select("doc_id", "votes", "buckets", "parts", "void").mapInArrow(
        lambda incoming: batches(rows(incoming), schema, 4096),
        "doc_id bigint, votes string, posterior double, score double, accepted boolean",
    )


def keep_accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the scorer accepts. Rows are scored where they
    are read, so they need no key."""
    find_package(docs.sparkSession)
    _, weight, bias, _ = fit(docs)
    rows = docs.select(whole_row(docs).alias("row"), F.coalesce("text", F.lit("")).alias("text"))

    def kept(incoming: Iterator[pa.RecordBatch]):
        reader = Reader()
        for batch in incoming:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                group = part.column(1).to_pylist()
                logits = []
                for view in views(reader, group):
                    bucket, share = view.features()
                    logit = float(weight[bucket] @ share.astype(np.float32)) + bias
                    logits.append(-np.inf if view.void() else logit)
                chance = 1 / (1 + np.exp(-np.clip(np.array(logits), -500, 500)))
                yield part.filter(pa.array(chance >= THRESHOLD)).select(["row"])

    return rows.mapInArrow(kept, rows.select("row").schema).select("row.*")
