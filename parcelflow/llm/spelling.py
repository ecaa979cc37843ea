"""Spelling variants: words one edit apart, found in tries of letter-group counts.

A word becomes the vector of how often each group of letters occurs in it. One edit changes a vector little:
an inserted letter adds one to a group (a deficit of the shorter word), a replaced one also takes one from
another group (a surplus) or changes nothing. A trie holds the vectors of words by one count a level. A search
goes down it depth first with a budget of one deficit and one surplus; the words at the leaves that it reaches
are compared letter by letter. A search spends its deficit first, so each pair is found from one side only.

The first levels are walked by Spark: words meet where these counts agree but for the budget, in as many
levels as it takes to leave few words in one place. A place that still holds more is cut into a grid of parts.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import saved, texts
from parcelflow.llm.merkle import CRC_TABLE_SQL, crc_sql

#: Fixed by the task: shortest word, its least number of occurrences, every which run loses a code point, and how
#: many times a form is as frequent.
SHORTEST, OFTEN, DAMAGED, TIMES = 7, 2, 31, 10

#: Groups of letters in the order of the trie's levels; all other letters are one more group.
GROUPS = ("e", "a", "i", "n", "o", "r", "s", "t", "u", "l", "d", "cq", "mg", "hf", "pbv", "kwjxyz")
LEVELS = len(GROUPS) + 1
#: Words of one place, and the numbers of levels that may lead to places.
PLACE = 4000
DEPTHS = (2, 3, 4, 5, 6, 8, 10, 13, LEVELS)
#: Words that one task searches, about, and the steps of a search and pairs of words it takes at a time.
TASK = 10_000
STEPS, PAIRS = 1 << 16, 1 << 16
#: Code points of words that are compared side by side; longer ones are compared one by one.
WIDE = 32
#: Words that a task counts before it hands them on.
COUNTED = 200_000

RUN = re.compile(f"[A-Za-zÀ-ÿ]{{{SHORTEST},}}")
A_TO_Z = str.maketrans({c: c + 32 for c in range(65, 91)})

#: What a search has spent: nothing, the deficit, deficit and surplus. ``HERE`` marks the words of a place.
NOTHING, DEFICIT, BOTH = 0, 1, 2
HERE = -1


# -- words -------------------------------------------------------------------


def damaged(run: str, head: int) -> str:
    """A run as it counts: every 31st loses a code point. ``head`` is the crc32 of what stands before it."""
    h = zlib.crc32(run.encode(), head)
    if h % DAMAGED:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1 :]


def words(docs: DataFrame) -> DataFrame:
    """``word, n``: the words of all texts with their occurrences.

    Shorter runs than the shortest word can't become one and are not looked at.
    """

    def count(incoming: Iterator[pa.RecordBatch]):
        total: Counter = Counter()

        def rows():
            return pa.RecordBatch.from_arrays(
                [pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"]
            )

        for batch in incoming:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, times in Counter(RUN.findall(text.as_py())).items():
                    word = damaged(run.translate(A_TO_Z) if not run.islower() else run, head)
                    if len(word) >= SHORTEST:
                        total[word] += times
                if len(total) >= COUNTED:
                    yield rows()
                    total.clear()
        if total:
            yield rows()

    found = texts(docs).mapInArrow(count, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= OFTEN)


# -- vectors and places ------------------------------------------------------

_LEVEL_OF = np.full(256, LEVELS - 1, np.int64)
for _level, _letters in enumerate(GROUPS):
    _LEVEL_OF[[ord(c) for c in _letters]] = _level

#: One number a level: places are named by sums of counts times these.
_NAMES = np.random.default_rng(12).integers(1, 1 << 63, LEVELS, dtype=np.uint64) | np.uint64(1)


def vectors(found: list[bytes]) -> np.ndarray:
    """Counts of the letter groups of words in Latin-1."""
    letters = np.frombuffer(b"".join(found), np.uint8)
    owner = np.repeat(np.arange(len(found)), [len(w) for w in found])
    flat = np.bincount(owner * LEVELS + _LEVEL_OF[letters], minlength=len(found) * LEVELS)
    return flat.reshape(-1, LEVELS)


def names(counts: np.ndarray, depth: int) -> np.ndarray:
    """The name of the place of each vector, by its first counts. Should two places share a name, words of both
    are compared; no pair is lost or found twice."""
    return (counts[:, :depth].astype(np.uint64) * _NAMES[:depth]).sum(axis=1, dtype=np.uint64)


def visits(depth: int) -> Iterator[tuple[int, int, int]]:
    """What is spent on the first levels, and the groups of one more and one less (``depth`` for none)."""
    yield NOTHING, depth, depth
    for more in range(depth):
        yield DEFICIT, more, depth
        for less in range(more + 1, depth):
            yield BOTH, more, less


def _latin(column: pa.Array) -> list[bytes]:
    return [w.encode("latin-1") for w in column.to_pylist()]


def place_sizes(found: DataFrame) -> DataFrame:
    """``depth, place, words`` for all depths."""

    def count(incoming: Iterator[pa.RecordBatch]):
        for batch in incoming:
            counts = vectors(_latin(batch.column(0)))
            for depth in DEPTHS:
                place, times = np.unique(names(counts, depth).view(np.int64), return_counts=True)
                depths = np.full(len(place), depth, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(depths), pa.array(place), pa.array(times.astype(np.int64))], ["depth", "place", "words"]
                )

    sizes = found.select("word").mapInArrow(count, "depth int, place bigint, words bigint")
    return sizes.groupBy("depth", "place").agg(F.sum("words").alias("words"))


def depth_of(sizes: DataFrame) -> int:
    """The least depth at which no place holds more than ``PLACE`` words, or the last. One number for each depth
    comes to the driver."""
    most = {r.depth: r.most for r in sizes.groupBy("depth").agg(F.max("words").alias("most")).collect()}
    return next((d for d in DEPTHS if most.get(d, 0) <= PLACE), LEVELS)


def routed(found: DataFrame, depth: int) -> DataFrame:
    """``place, spent, word, n``: each word in its own place and as a search in all places within the budget."""

    def route(incoming: Iterator[pa.RecordBatch]):
        for batch in incoming:
            counts = vectors(_latin(batch.column(0)))
            own = names(counts, depth)
            for spent, more, less in [(HERE, depth, depth), *visits(depth)]:
                place, rows = own, batch
                if more < depth:
                    place = place + _NAMES[more]
                if less < depth:
                    has = np.flatnonzero(counts[:, less])
                    place, rows = place[has] - _NAMES[less], batch.take(pa.array(has))
                state = pa.array(np.full(len(place), spent, np.int8))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place.view(np.int64)), state, *rows.columns], ["place", "spent", "word", "n"]
                )

    return found.select("word", "n").mapInArrow(route, "place bigint, spent byte, word string, n bigint")


# -- search ------------------------------------------------------------------


class Trie:
    """Words under their vectors, one count a level below a root for each place."""

    def __init__(self, places: np.ndarray, counts: np.ndarray):
        order = np.lexsort([*counts.T[::-1], places])
        self.words = order  # by leaf
        rows = np.column_stack([places, counts])[order]
        new = np.ones((len(rows), rows.shape[1]), bool)
        new[1:] = rows[1:] != rows[:-1]
        new = np.logical_or.accumulate(new, axis=1)
        self.base = int(counts.max(initial=0)) + 3
        self.roots = rows[new[:, 0], 0]
        # A child is found by its parent's number and its count.
        self.children, parent = [], np.cumsum(new[:, 0]) - 1
        for level in range(1, rows.shape[1]):
            node = np.cumsum(new[:, level]) - 1
            first = new[:, level]
            self.children.append(parent[first] * self.base + rows[first, level])
            parent = node
        self.start = np.append(np.flatnonzero(new[:, -1]), len(rows))

    def child(self, level: int, node: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The children of nodes with these counts, and which of them exist."""
        keys = self.children[level]
        key = node * self.base + np.clip(count, -1, self.base - 2)
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return at, (keys[at] == key) & (count >= 0)

    def search(self, places: np.ndarray, counts: np.ndarray, spent: np.ndarray) -> Iterator[tuple]:
        """Searches and the leaves that they reach, depth first, a bounded number of steps at a time."""
        root = np.searchsorted(self.roots, places)
        root = np.minimum(root, len(self.roots) - 1)
        who = np.flatnonzero(self.roots[root] == places)
        stack = [(0, who[k : k + STEPS], root[who[k : k + STEPS]], spent[who[k : k + STEPS]]) for k in range(0, len(who), STEPS)]
        while stack:
            level, who, node, state = stack.pop()
            if level == len(self.children):
                yield who, node, state
                continue
            count, steps = counts[who, level], []
            for moves, change in ((None, 0), (NOTHING, 1), (DEFICIT, -1)):
                may = np.arange(len(who)) if moves is None else np.flatnonzero(state == moves)
                at, there = self.child(level, node[may], count[may] + change)
                may, at = may[there], at[there]
                steps.append((who[may], at, state[may] + abs(change)))
            who, node, state = (np.concatenate(c) for c in zip(*steps))
            for k in range(0, len(who), STEPS):
                part = slice(k, k + STEPS)
                stack.append((level + 1, who[part], node[part], state[part]))


def one_apart(a: bytes, b: bytes) -> bool:
    """Whether one inserted, deleted or replaced letter makes one word the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


class Letters:
    """Words as rows of a matrix, filled up with zeros."""

    def __init__(self, found: list[bytes]):
        self.found = found
        self.size = np.array([len(w) for w in found], np.int64)
        self.rows = np.array([w[:WIDE] for w in found], f"S{WIDE}").view(np.uint8).reshape(-1, WIDE)


def verified(a: Letters, i: np.ndarray, b: Letters, j: np.ndarray) -> np.ndarray:
    """Which of the pairs are one edit apart; ``b``'s word is as long as ``a``'s or one longer."""
    near = np.zeros(len(i), bool)
    more = b.size[j] - a.size[i]
    short = np.maximum(a.size[i], b.size[j]) <= WIDE
    for k in np.flatnonzero(~short & (more >= 0) & (more <= 1)):
        near[k] = one_apart(a.found[i[k]], b.found[j[k]])
    same = np.flatnonzero(short & (more == 0))
    near[same] = (a.rows[i[same]] != b.rows[j[same]]).sum(axis=1) == 1
    longer = np.flatnonzero(short & (more == 1))
    left, right = a.rows[i[longer]], b.rows[j[longer]]
    first = (left != right).argmax(axis=1)
    shifted = left[:, :-1] != right[:, 1:]
    last = np.where(shifted.any(axis=1), WIDE - 2 - shifted[:, ::-1].argmax(axis=1), -1)
    near[longer] = last < first
    return near


def pairs_of(frame: pd.DataFrame, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of searches and rows of words that are one edit apart."""
    found = [w.encode("latin-1") for w in frame["word"]]
    spent = frame["spent"].to_numpy(np.int64)
    here, asked = np.flatnonzero(spent == HERE), np.flatnonzero(spent != HERE)
    if not len(here) or not len(asked):
        return
    counts, places = vectors(found)[:, depth:], frame["cell"].to_numpy(np.int64)
    trie, letters = Trie(places[here], counts[here]), Letters(found)
    word = frame["word"].to_numpy()
    for who, leaf, state in trie.search(places[asked], counts[asked], spent[asked]):
        sizes = trie.start[leaf + 1] - trie.start[leaf]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        for k in range(0, total, PAIRS):
            pair = np.arange(k, min(total, k + PAIRS))
            step = np.searchsorted(ends, pair, "right")
            i = asked[who[step]]
            j = here[trie.words[trie.start[leaf[step]] + pair - (ends[step] - sizes[step])]]
            # Both words of a vector search for each other.
            once = (state[step] != NOTHING) | (word[i] < word[j])
            i, j = i[once], j[once]
            near = verified(letters, i, letters, j)
            yield i[near], j[near]


def near_words(found: DataFrame) -> DataFrame:
    """``word, n, near, near_n``: every word of ``found`` (saved; ``word, n``, distinct words of Latin-1 letters)
    with every word one edit apart."""
    sizes = saved(place_sizes(found))
    depth = depth_of(sizes)
    # Only places that the last depth leaves crowded are cut; there are none in most tables.
    crowded = saved(
        sizes.where((F.col("depth") == depth) & (F.col("words") > PLACE)).select(
            "place", F.ceil(F.col("words") / PLACE).cast("int").alias("parts")
        )
    )
    total = found.count()
    tasks = max(1, -(-total // TASK))
    rows = routed(found, depth).join(crowded, "place", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    here = F.col("spent") == HERE
    row, column = F.when(here, own).otherwise(F.col("other")), F.when(here, F.col("other")).otherwise(own)
    rows = rows.withColumn("cell", F.xxhash64("place", row, column))
    schema = "word string, n bigint, near string, near_n bigint"

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        chosen = [p for p in pairs_of(frame, depth) if len(p[0])]
        i = np.concatenate([p[0] for p in chosen]) if chosen else np.array([], np.int64)
        j = np.concatenate([p[1] for p in chosen]) if chosen else np.array([], np.int64)
        word, n = frame["word"].to_numpy(), frame["n"].to_numpy()
        both = pd.DataFrame({"word": word[np.append(i, j)], "n": n[np.append(i, j)]})
        both["near"], both["near_n"] = word[np.append(j, i)], n[np.append(j, i)]
        return both.drop_duplicates(["word", "near"])

    bucket = F.pmod("cell", F.lit(tasks)).alias("bucket")
    return rows.select(bucket, "cell", "spent", "word", "n").groupBy("bucket").applyInPandas(search, schema)


# -- forms -------------------------------------------------------------------


def roots(forms: DataFrame, most: int) -> DataFrame:
    """``word, root`` from ``word, form``: where forms lead to at last. A form is ``TIMES`` as frequent as its word,
    so chains are as short as the logarithm of the largest number of occurrences, ``most``; each round doubles
    the steps taken."""
    longest, n = 0, OFTEN
    while n * TIMES <= most:
        longest, n = longest + 1, n * TIMES
    steps, paths = 1, saved(forms.select("word", F.col("form").alias("root")))
    while steps < longest:
        further = paths.select(F.col("word").alias("root"), F.col("root").alias("next"))
        paths = saved(paths.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
        steps *= 2
    return paths


def variants(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of all texts of ``docs``.

    A word's form is its near word of most occurrences, of several the first in order of code points, if that
    has ten times the word's occurrences or more; else null. Null texts have no words, a null id counts as an
    empty one, repeated rows count each, and other columns don't matter. Without words the result is empty.
    """
    found = saved(words(docs))
    near = near_words(found)
    best = near.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best")
    )
    enough = -F.col("best.order") >= TIMES * F.col("n")
    judged = saved(
        found.join(best, "word", "left").select(
            "word",
            F.when(enough, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(enough, -F.col("best.order")).alias("form_n"),
        )
    )
    most = judged.agg(F.max("n")).first()[0] or 0
    ends = roots(judged.where("form IS NOT NULL"), most)
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _octets() -> str:
    """Bytes of ``doc_id:run`` in DuckDB: letters are below U+0080 or from U+00C0 to U+00FF."""
    return (
        "flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), "
        "lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195::BIGINT, unicode(x) - 64] END))"
    )


VARIANTS_SQL = f"""
WITH RECURSIVE {CRC_TABLE_SQL},
runs AS (
  SELECT doc_id, run, count(*) AS times FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
  WHERE length(run) >= {SHORTEST} GROUP BY ALL),
hashed AS (SELECT *, {crc_sql(_octets())} AS h FROM runs, crc_table),
words AS (
  SELECT word, sum(times)::BIGINT AS n FROM (
    SELECT times, CASE WHEN h % {DAMAGED} = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word
    FROM hashed)
  WHERE length(word) >= {SHORTEST} GROUP BY word HAVING sum(times) >= {OFTEN}),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words),
cut AS (SELECT word, n, k, word[:k - 1] || word[k + 1:] AS rest FROM places),
near AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.k = b.k AND a.word <> b.word
  UNION
  SELECT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, b.n, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS form_n, arg_min(near, (-near_n, near)) AS form
  FROM near GROUP BY word),
judged AS (
  SELECT w.word, CASE WHEN form_n >= {TIMES} * n THEN form END AS form, n, coalesce(n_near, 0) AS n_near,
    CASE WHEN form_n >= {TIMES} * n THEN form_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
paths(word, root, step) AS (
  SELECT word, word, 0 FROM judged
  UNION ALL
  SELECT p.word, j.form, step + 1 FROM paths p JOIN judged j ON p.root = j.word WHERE j.form IS NOT NULL)
SELECT j.word, form, root, n, n_near, form_n
FROM judged j JOIN (SELECT word, arg_max(root, step) AS root FROM paths GROUP BY word) USING (word)
"""
