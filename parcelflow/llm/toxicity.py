"""Toxicity by embeddings of subwords, averaged, under a linear softmax.

A word is the bag of its character n-grams and itself, each with an embedding in a hashed table;
the word's vector is their mean, the text's the mean over its words and ``NULL_WORDS`` vectors of zeros, so that
few words say little, and a linear softmax gives the classes. Embeddings and the linear layer are trained together by full-batch Adam in numpy. A
misspelt word that was never seen shares most n-grams with the one that was.

Since the model is linear above the embeddings, a trained model gives each word one number, its
share of the logit; scoring adds these numbers up through a cache of words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import about, batches, crc_of_id, grouped_texts, saved, texts

BUCKET_BITS, WIDTH = 18, 2
BUCKETS = 1 << BUCKET_BITS
GRAMS = (3, 4, 5)
#: Labelled texts of class 0 and 1 that the model learns from, about, if there are more. All texts are
#: scored, whole.
SAMPLE = (7500, 2500)
EPOCHS, RATE, DECAY = 160, 0.5, 3e-6
#: Vectors of zeros in the mean of each text.
NULL_WORDS = 20
#: Buckets that fewer words of sampled texts hold keep the embedding zero: this many, or in a small sample this
#: share of its texts.
LEAST, LEAST_SHARE = 8, 0.003
THRESHOLD = 0.7
#: Words whose share is kept by a task.
CACHED = 300_000
#: Code points of a group of texts that are scored together.
GROUP_POINTS = 1 << 20


def bare(token: str) -> str:
    """The token in lower case without what stands around its letters and numbers; may be empty."""
    word = token.lower()
    if word.isalnum():
        return word
    start, end = 0, len(word)
    while start < end and not word[start].isalnum():
        start += 1
    while end > start and not word[end - 1].isalnum():
        end -= 1
    return word[start:end]


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of words and their n-grams, and the number of the word that each belongs to.

    All words lie in one array of code points, marked at both ends; polynomials over neighbours
    give the hashes of the n-grams of each length and of whole words. Empty words have none.
    """
    points = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "replace"), "<u4")
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    ends = np.cumsum(sizes)
    word = np.repeat(np.arange(len(words)), sizes)
    solid = sizes > 2
    mixed = points.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    hashes, owners = [], []
    rolling = mixed.copy()
    for n in range(2, max(GRAMS) + 1):  # of the n points from each place on
        if n > len(points):
            break
        rolling = rolling[: len(points) - n + 1] * np.uint64(0x100000001B3) + mixed[n - 1 :]
        if n in GRAMS:
            at = np.arange(len(rolling))
            at = at[(at + n <= ends[word[at]]) & solid[word[at]]]
            hashes.append(rolling[at] + np.uint64(n))
            owners.append(word[at])
    place = np.arange(len(points)) - np.repeat(ends - sizes, sizes)
    whole = mixed * (2 * place.astype(np.uint64) + np.uint64(0xD6E8FEB86659FD93))
    whole ^= whole >> np.uint64(32)
    if len(words):
        hashes.append(np.add.reduceat(whole, ends - sizes)[solid])
        owners.append(np.flatnonzero(solid))
    if not hashes:
        return np.array([], np.int64), np.array([], np.int64)
    hashed = np.concatenate(hashes) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (hashed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), np.concatenate(owners)


def counted(text: str) -> tuple[str, list[int]]:
    """The distinct tokens of a text, with blanks between, and how often each occurs."""
    tokens = Counter(text.split())
    return " ".join(tokens), list(tokens.values())


@dataclass
class Model:
    embedding: np.ndarray  # buckets x width
    weight: np.ndarray  # width x 2
    bias: np.ndarray  # 2

    def shares(self) -> np.ndarray:
        """What each bucket adds to the logit of class 1 over class 0."""
        return self.embedding @ (self.weight[:, 1] - self.weight[:, 0])

    def offset(self) -> float:
        return float(self.bias[1] - self.bias[0])


class Bags:
    """Texts as sparse means: words of texts, and subwords of words, over the buckets in use. A text may
    be given as its distinct tokens and how often each occurs."""

    def __init__(self, sample: list[str | tuple[str, list[int]]]):
        known: dict[str, int] = {}
        doc, word, count = [], [], []
        for row, text in enumerate(sample):
            tokens, times_of = counted(text) if isinstance(text, str) else text
            for token, times in zip(tokens.split(), times_of):
                found = bare(token)
                if found:
                    doc.append(row)
                    word.append(known.setdefault(found, len(known)))
                    count.append(times)
        self.n, self.words = len(sample), len(known)
        self.doc, self.word = np.array(doc, np.int64), np.array(word, np.int64)
        count = np.array(count, np.float64)
        self.part = count / (np.bincount(self.doc, count, self.n) + NULL_WORDS)[self.doc]
        flat, word_of = subwords(list(known))
        sizes = np.bincount(word_of, minlength=self.words)
        # Each word counts once for a bucket, in as many texts as hold it.
        texts_of = np.bincount(self.word, minlength=self.words)
        often = np.bincount(flat, texts_of[word_of], BUCKETS) >= min(LEAST, LEAST_SHARE * self.n)
        kept = often[flat]
        self.word_of, self.gram_part = word_of[kept], 1.0 / sizes[word_of[kept]]
        self.used, self.gram = np.unique(flat[kept], return_inverse=True)

    def up(self, embedding: np.ndarray) -> np.ndarray:
        """Means of texts, by column, of embeddings of the buckets in use."""
        out = np.empty((self.n, embedding.shape[1]))
        for k in range(embedding.shape[1]):
            words = np.bincount(self.word_of, embedding[self.gram, k] * self.gram_part, self.words)
            out[:, k] = np.bincount(self.doc, words[self.word] * self.part, self.n)
        return out

    def down(self, gradient: np.ndarray) -> np.ndarray:
        """The gradient by text as one by bucket."""
        out = np.empty((len(self.used), gradient.shape[1]))
        for k in range(gradient.shape[1]):
            words = np.bincount(self.word, gradient[self.doc, k] * self.part, self.words)
            out[:, k] = np.bincount(self.gram, words[self.word_of] * self.gram_part, len(self.used))
        return out


def loss_and_slopes(bags: Bags, params: list[np.ndarray], labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """The loss of embeddings, weight and bias, both classes weighing the same, and its slopes."""
    embedding, weight, bias = params
    importance = len(labels) / (2 * np.bincount(labels, minlength=2))
    importance = importance[labels] / len(labels)
    mean = bags.up(embedding)
    logits = mean @ weight + bias
    logits -= logits.max(axis=1, keepdims=True)
    chance = np.exp(logits)
    chance /= chance.sum(axis=1, keepdims=True)
    rows = np.arange(len(labels))
    loss = -(importance * np.log(chance[rows, labels] + 1e-300)).sum()
    loss += DECAY / 2 * ((embedding**2).sum() + (weight**2).sum())
    chance[rows, labels] -= 1
    chance *= importance[:, None]
    slopes = [
        bags.down(chance @ weight.T) + DECAY * embedding,
        mean.T @ chance + DECAY * weight,
        chance.sum(axis=0),
    ]
    return loss, slopes


def train(sample: list[str | tuple[str, list[int]]], labels: np.ndarray, epochs: int = EPOCHS) -> Model:
    """Embeddings and linear layer, trained together; both classes weigh the same in the loss.
    Without texts of both classes the model is all zeros and scores one half."""
    rng = np.random.default_rng(10)
    model = Model(np.zeros((BUCKETS, WIDTH)), np.zeros((WIDTH, 2)), np.zeros(2))
    labels = np.asarray(labels, np.int64)
    if len(set(labels.tolist())) < 2:
        return model
    bags = Bags(sample)
    embedding = rng.normal(0, 0.1, (len(bags.used), WIDTH))
    weight, bias = rng.normal(0, 0.5, (WIDTH, 2)), np.zeros(2)
    params = [embedding, weight, bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, epochs + 1):
        rate = RATE * (1 - (step - 1) / epochs)
        _, slopes = loss_and_slopes(bags, params, labels)
        for p, slope, m, v in zip(params, slopes, first, second):
            m += 0.1 * (slope - m)
            v += 0.001 * (slope * slope - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    model.embedding[bags.used] = embedding
    model.weight, model.bias = weight, bias
    return model


class Scorer:
    """The probability of class 1 of texts, words through a cache."""

    def __init__(self, shares: np.ndarray, offset: float):
        self.shares, self.offset = shares, offset
        self.known: dict[str, float] = {}

    def learn(self, tokens: set[str]) -> None:
        """Keep the shares of new tokens; not a number for one without letters and numbers."""
        new = [t for t in tokens if t not in self.known]
        if len(self.known) + len(new) > CACHED:
            self.known, new = {}, list(tokens)
        words = [bare(t) for t in new]
        bucket, owner = subwords(words)
        with np.errstate(invalid="ignore"):
            share = np.bincount(owner, self.shares[bucket], len(words)) / np.bincount(
                owner, minlength=len(words)
            )
        self.known.update(zip(new, share.tolist()))

    def __call__(self, group: list[str]) -> np.ndarray:
        split = [t.split() for t in group]
        self.learn(set().union(*split))
        logits = np.empty(len(group))
        for k, tokens in enumerate(split):
            values = np.array([self.known[t] for t in tokens])
            values = values[~np.isnan(values)]
            logits[k] = values.sum() / (len(values) + NULL_WORDS)
        return 1 / (1 + np.exp(-np.clip(logits + self.offset, -500, 500)))


def fit(docs: DataFrame, labels: DataFrame, held_out: int = 1) -> tuple[np.ndarray, float]:
    """Shares of buckets and the offset of a model of ``labels.toxic`` over a bounded sample (``SAMPLE``) of labelled documents whose
    crc32(doc_id) modulo 3 is not ``held_out``. Null ids, texts and labels are not learned from;
    of several labels of one id the largest counts. Texts of all lengths are drawn alike, reduced to their
    distinct tokens with counts where they are read, and trained on in one task."""
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic")
    )
    known = F.col("doc_id").isNotNull() & F.col("text").isNotNull()
    ids = docs.where(known & (F.pmod(crc_of_id(), F.lit(3)) != held_out)).select("doc_id").distinct()
    rows = saved(ids.join(marks, "doc_id"))
    drawn = [about(saved(rows.where(F.col("toxic") == k)), most) for k, most in enumerate(SAMPLE)]
    chosen = saved(drawn[0].union(drawn[1]))
    # Of several texts of an id the largest is learned from.
    sample = (
        docs.select("doc_id", "text")
        .where(known)
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.max("text").alias("text"))
    )

    schema = pa.schema(
        [("doc_id", pa.int64()), ("toxic", pa.int64()), ("tokens", pa.string()), ("times", pa.list_(pa.int32()))]
    )

    def reduced(incoming: Iterator[pa.RecordBatch]):
        for batch in incoming:
            for doc_id, toxic, text in zip(*batch.columns):
                yield doc_id.as_py(), toxic.as_py(), *counted(text.as_py())

    sample = sample.mapInArrow(
        lambda incoming: batches(reduced(incoming), schema, 64),
        "doc_id bigint, toxic bigint, tokens string, times array<int>",
    )

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("doc_id", ignore_index=True)
        model = train(list(zip(frame["tokens"], frame["times"])), frame["toxic"].to_numpy())
        shares = model.shares()
        used = np.flatnonzero(shares)
        return pd.DataFrame(
            {"bucket": np.append(used, -1), "share": np.append(shares[used], model.offset())}
        )

    # At most BUCKETS + 1 numbers come back.
    one = sample.withColumn("_all", F.lit(True)).groupBy("_all")
    found = one.applyInPandas(learn, "bucket bigint, share double").toPandas()
    shares = np.zeros(BUCKETS)
    inner = found[found["bucket"] >= 0]
    shares[inner["bucket"].to_numpy(np.int64)] = inner["share"]
    return shares, float(found.loc[found["bucket"] < 0, "share"].sum())


def score(docs: DataFrame, shares: np.ndarray, offset: float) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and ``score``, the probability of class 1. A text
    without words, null or empty, has the score of the classes' offset alone."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
    model = docs.sparkSession.sparkContext.broadcast((shares, offset))

    def rows(incoming: Iterator[pa.RecordBatch]):
        scorer = Scorer(*model.value)
        for ids, group in grouped_texts(incoming, GROUP_POINTS):
            yield from zip(ids, scorer(group).tolist())

    return texts(docs).mapInArrow(
        lambda incoming: batches(rows(incoming), schema, 8192), "doc_id bigint, score double"
    )


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``."""
    return score(docs, *fit(docs, labels)).select(
        "doc_id",
        (F.pmod(crc_of_id(), F.lit(3)) == 1).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
