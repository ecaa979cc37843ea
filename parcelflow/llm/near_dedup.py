"""Near duplicates by Order MinHash, verified by banded alignment.

A text is the sequence of its five-word shingles, each labelled with its occurrence. For each of ``SKETCHES``
hash functions the two smallest labelled shingles, in the order of the text, make a sketch; two texts share
it with a chance that falls with their edit distance, order included. Texts that share a sketch meet in a
bucket. A pair is a link if the alignment of its words has a similarity of ``SIMILARITY`` or more, and the
classes are what links connect. Short texts have few runs of five words: of planted pairs at 0.9 and above, a
sketch was shared by 0.71 at 10 words, 0.94 at 20 and 0.98 from 30 words on, so the recall holds from about 30
words; a text of 4 or 5 words meets only those with the same run.

In a bucket nobody is compared with everybody. First, every text is aligned with the representative of its
smallest bucket. Then, in each bucket that holds several classes, each of these with another one, through one
text of each. Then every text with each representative that is still in another class. Representatives differ
from one hash function to the next, and buckets have others for the texts that share the next sketch too. So
a large group of copies soon counts as one.

Last come the texts that are still apart. In a bucket of up to ``FEW`` texts all of them are aligned. The texts
of larger ones, a passage in common, meet by what is rare among them: each edit changes two runs of two words at
most, so two texts of the similarity share a known number of their rarest runs (``rare_pairs``). Runs of more than
``COMMON`` texts are no keys; where too many are among the rarest of two texts, single words take their place. Texts
whose rarest fifth of words is common as well are all compared with those of like lengths, in blocks of ``BLOCK``
(``block_links``). So every link between two texts of a bucket ends in a class. Pairs grow with texts, but for texts
made of common words alone, where they grow with the square of their number.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.common import batches, find_package, saved, texts, whole_row

WORDS, SIMILARITY = 5, 0.8
SKETCHES, TAKEN = 32, 2
#: Texts of a bucket that are all compared; texts that make a run of words no key.
FEW, COMMON = 8, 50
#: Texts of common words in a block, about, and values that are looked at together for two blocks.
BLOCK, COLUMNS = 256, 1 << 13
#: Bits of the texts of a block that are aligned with another one at once, and texts from which on that pays.
BITS, MANY = 1 << 15, 4
#: Lengths of the runs that are counted before an alignment.
COUNTED = (1, 2, 3)
CACHED = 300_000
#: Hash values of shingles held at a time, and words of texts whose runs are counted together.
VALUES, TOGETHER = 1 << 19, 1 << 18
#: Edits up to which diagonals are followed, at most; beyond, whole rows are aligned as bit vectors.
BAND = 100


# -- sketches ----------------------------------------------------------------


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


SEEDS = _mixed(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def words_of(text: str) -> list[str]:
    return text.lower().split()


def shingles(hashes: np.ndarray, size: int = WORDS) -> np.ndarray:
    """Hashes of the runs of ``size`` words; a shorter text is one run."""
    size = min(size, len(hashes))
    out = np.zeros(len(hashes) - size + 1, np.uint64)
    for k in range(size):
        out = _mixed(out * np.uint64(31) + hashes[k : len(hashes) - size + 1 + k])
    return out


def occurrences(values: np.ndarray) -> np.ndarray:
    """How often each value stood before."""
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    out = np.empty(len(values), np.int64)
    out[order] = np.arange(len(values)) - np.repeat(first, np.diff(np.append(first, len(values))))
    return out


def labelled_runs(hashes: np.ndarray, size: int = WORDS) -> np.ndarray:
    """Hashes of the runs of ``size`` words with their occurrences: no two of a text are equal."""
    plain = shingles(hashes, size)
    return _mixed(plain + occurrences(plain).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def hashed(words: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)


def sketches(hashes: np.ndarray) -> np.ndarray:
    """The sketches of a text from the hashes of its words."""
    labelled = labelled_runs(hashes)
    out = np.empty(SKETCHES, np.uint64)
    step = max(1, VALUES // len(labelled))
    for at in range(0, SKETCHES, step):
        seeds = SEEDS[at : at + step, None]
        values = _mixed(labelled[None, :] ^ seeds)
        rows = np.arange(len(values))
        places = []
        for _ in range(min(TAKEN, len(labelled))):
            place = values.argmin(axis=1)
            values[rows, place] = np.uint64(0xFFFFFFFFFFFFFFFF)
            places.append(place)
        value = seeds[:, 0]
        for place in np.sort(np.array(places), axis=0):
            value = _mixed(value * np.uint64(31) + labelled[place])
        out[at : at + step] = value
    return out


def sketched(docs: DataFrame) -> DataFrame:
    """``node`` (MD5 of the text), ``n_words`` and ``sketches`` of each text that has words, in any order
    and with repetitions."""
    schema = pa.schema([("node", pa.binary()), ("n_words", pa.int64()), ("sketches", pa.list_(pa.int64()))])

    def rows(incoming: Iterator[pa.RecordBatch]):
        known: dict[str, int] = {}
        for batch in incoming:
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py())
                if not words:
                    continue
                new = set(words).difference(known)
                if len(known) + len(new) > CACHED:
                    known, new = {}, set(words)
                for w in new:
                    known[w] = xxhash.xxh64_intdigest(w)
                hashes = np.array([known[w] for w in words], np.uint64)
                yield node, len(words), sketches(hashes).view(np.int64)

    return docs.select(node_of().alias("node"), "text").mapInArrow(
        lambda incoming: batches(rows(incoming), schema), "node binary, n_words bigint, sketches array<bigint>"
    )


def node_of(text: str | Column = "text") -> Column:
    return F.unhex(F.md5(F.col(text) if isinstance(text, str) else text))


# -- candidates --------------------------------------------------------------


def entries_of(nodes: DataFrame) -> DataFrame:
    """The buckets of two and more texts: a row for each text with the number of the hash function (``at``),
    its sketch (``one``) and the next one (``two``), the ``size`` of the bucket and its representative ``rep``.
    Buckets are only ever aggregated and joined, so that a large one can be split."""
    following = F.concat(F.slice("sketches", 2, SKETCHES - 1), F.slice("sketches", 1, 1))
    rows = nodes.select(
        "node",
        "n_words",
        F.posexplode(F.arrays_zip(F.col("sketches").alias("one"), following.alias("two"))).alias("at", "s"),
    ).select("node", "n_words", "at", F.col("s.one").alias("one"), F.col("s.two").alias("two"))
    # Most sketches are of one text: they are only counted.
    chosen = rows.groupBy("at", "one").agg(F.count("*").alias("size")).where("size > 1")
    met = saved(rows.join(chosen, ["at", "one"]))
    return met.join(met.groupBy("at", "one").agg(_one_of("node", "at", salt=0).alias("rep")), ["at", "one"])


def _one_of(*mixed: str, salt: int) -> Column:
    return F.min_by(F.struct("node", "n_words"), F.xxhash64(*mixed, F.lit(salt)))


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _alike(n: str, m: str) -> Column:
    """Lengths that allow the similarity."""
    return F.least(n, m) >= SIMILARITY * F.greatest(n, m)


def first_pairs(entries: DataFrame) -> DataFrame:
    """Each text with the representative of the smallest bucket in which that is another text."""
    other = (F.col("node") != F.col("rep.node")) & _alike("n_words", "rep.n_words")
    smallest = F.min_by("rep.node", F.struct("size", F.xxhash64("rep.node", "at"))).alias("other")
    return entries.where(other).groupBy("node").agg(smallest).select(*_pair("node", "other")).distinct()


def later_pairs(entries: DataFrame, labels: DataFrame, by_class: bool) -> DataFrame:
    """For each bucket, and for the texts of a bucket that share the next sketch: each text with the
    representative, or ``by_class`` one text of each class, where both are in different classes."""
    rows = saved(
        entries.drop("rep")
        .join(labels, "node", "left")
        .select("node", "n_words", "at", "one", "two", "size", F.coalesce("class", "node").alias("class"))
    )

    def met(rows: DataFrame, *keys: str) -> DataFrame:
        if by_class:
            rows = rows.groupBy(*keys, "class").agg(_one_of("node", "at", salt=1).alias("m")).select(
                *keys, "class", "m.*"
            )
        text = F.struct("node", "n_words", "class")
        order = F.xxhash64("class" if by_class else "node", "at", F.lit(2))
        chosen = rows.groupBy(*keys).agg(
            F.min_by(text, order).alias("rep"), (F.min("class") != F.max("class")).alias("several")
        )
        return (
            rows.join(chosen.where("several"), list(keys))
            .where((F.col("class") != F.col("rep.class")) & _alike("n_words", "rep.n_words"))
            .select(*_pair("node", "rep.node"))
        )

    return met(rows, "at", "one").unionAll(met(rows.where("size > 2"), "at", "one", "two")).distinct()


def apart(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """The entries of the buckets that hold several classes, with the classes."""
    rows = saved(
        entries.drop("rep", "two")
        .join(labels, "node", "left")
        .withColumn("class", F.coalesce("class", "node"))
    )
    several = rows.groupBy("at", "one").agg((F.min("class") != F.max("class")).alias("several")).where("several")
    return saved(rows.join(several.drop("several"), ["at", "one"]))


def few_pairs(rows: DataFrame) -> DataFrame:
    """All pairs of different classes of each bucket of up to ``FEW`` texts."""
    rows = rows.where(F.col("size") <= FEW)
    other = rows.select("at", "one", *(F.col(c).alias(f"_{c}") for c in ("node", "n_words", "class")))
    return (
        rows.join(other, ["at", "one"])
        .where((F.col("node") < F.col("_node")) & (F.col("class") != F.col("_class")) & _alike("n_words", "_n_words"))
        .select(F.col("node").alias("a"), F.col("_node").alias("b"))
        .distinct()
    )


def runs_together(ids: list[int], classes: list[int], runs: list[np.ndarray], most: int) -> list[pa.Array]:
    """The columns ``run, n, low, high, ids`` of each run of these texts: how many hold it, the least and the largest
    class of these, and their ids; no ids if they are more than ``most`` and of several classes."""
    value = np.concatenate(runs)
    order = np.argsort(value, kind="stable")
    value, text = value[order], np.repeat(np.arange(len(runs)), [len(r) for r in runs])[order]
    starts = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
    n = np.diff(np.append(starts, len(value)))
    class_ = np.array(classes, np.int64)[text]
    low, high = np.minimum.reduceat(class_, starts), np.maximum.reduceat(class_, starts)
    named = (n <= most) | (low == high)
    ends = np.cumsum(np.append(0, np.where(named, n, 0))).astype(np.int32)
    of_run = pa.ListArray.from_arrays(ends, np.array(ids, np.int64)[text[np.repeat(named, n)]])
    return [pa.array(value[starts].view(np.int64)), pa.array(n), pa.array(low), pa.array(high), of_run]


def runs_of(held: DataFrame, size: int) -> DataFrame:
    """``run, n, low, high, ids``: the labelled runs of ``size`` words of the texts ``held``, as ``runs_together`` has
    them for about ``TOGETHER`` words of texts at a time. Without ids a run is common, whatever other texts hold."""
    names, most = ["run", "n", "low", "high", "ids"], COMMON

    def rows(incoming: Iterator[pa.RecordBatch]):
        texts_: list[tuple[int, int, np.ndarray]] = []
        taken = 0
        for batch in incoming:
            for id_, class_, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                texts_.append((id_, class_, labelled_runs(hashed(words_of(text.as_py())), size)))
                taken += len(texts_[-1][2])
                if taken >= TOGETHER:
                    yield pa.RecordBatch.from_arrays(runs_together(*zip(*texts_), most), names)
                    texts_, taken = [], 0
        if texts_:
            yield pa.RecordBatch.from_arrays(runs_together(*zip(*texts_), most), names)

    return held.select("id", "class", "text").mapInArrow(
        rows, "run bigint, n bigint, low bigint, high bigint, ids array<bigint>"
    )


def rare_pairs(held: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of different classes among the texts ``held`` (``id, node, n_words, class, text``) that share enough
    rare runs of ``size`` words, and the ``id`` of the texts with pairs of which this is not known because too many
    runs are common.

    Two texts of the similarity, the longer one of N words, share at least ``N - size + 1 - size * 0.2 N`` runs.
    So, runs in one order, rare ones first, they share ``most`` of those that stand before all but as many less
    ``most``. Of these, common runs are no keys; what they could be for both is taken off the number. It says
    nothing if both texts have as many common ones as one of them must share, the shorter one the fewest."""

    def bound(n: Column) -> Column:
        return F.ceil(n * (1 - size * (1 - SIMILARITY)) - (size - 1) - 1e-6)

    def most(n: Column) -> Column:
        return F.greatest(F.lit(1), F.least(F.ceil(n * 0.05 - 1e-6), bound(n)))

    n = F.col("n_words")
    ranked = (
        held.select("id", "class", "n_words", F.greatest(n - (size - 1), F.lit(1)).alias("n"), most(n).alias("most"))
        .join(shared_runs(runs_of(held, size)), "id", "left")
        .withColumn("known", F.coalesce("known", F.expr("cast(array() AS array<struct<often: bigint, run: bigint>>)")))
        .withColumn("others", F.col("n") - F.coalesce("own", F.lit(0)))
    )
    # Runs of one class only come first in the order, common ones last.
    first = F.greatest(F.lit(0), F.least(F.col("others") - bound(n) + F.col("most"), F.col("others")))
    ranked = saved(
        ranked.withColumn("first", first.cast("int")).select(
            "id",
            "class",
            "n_words",
            "most",
            F.greatest(F.lit(0), F.col("first") - F.size("known")).alias("common"),
            F.transform(F.slice("known", 1, F.least("first", F.size("known"))), lambda r: r["run"]).alias("keys"),
        )
    )
    keyed = ranked.select("id", "class", "n_words", "most", "common", F.explode("keys").alias("key"))
    return met_by_key(keyed), ranked.where(F.col("common") >= most(n * SIMILARITY)).select("id")


def shared_runs(runs: DataFrame) -> DataFrame:
    """Of ``run, n, low, high, ids`` (``runs_of``), for each ``id``: ``known``, the runs of the text that 2 to
    ``COMMON`` texts of several classes hold, with how many, fewest first; and ``own``, how many runs of the text no
    other class holds. What is left of its runs is common. The runs are shuffled once; those of one hash stay on disk
    where they don't fit."""
    of_run = Window.partitionBy("run")
    met = runs.select(
        "ids",
        "run",
        F.sum("n").over(of_run).alias("often"),
        (F.min("low").over(of_run) != F.max("high").over(of_run)).alias("several"),
    ).where((F.col("often") <= COMMON) | ~F.col("several"))
    known = F.when(F.col("several"), F.struct("often", "run"))
    # The runs that the same texts hold go on together.
    of_texts = met.groupBy("ids").agg(
        F.collect_list(known).alias("known"), F.count_if(~F.col("several")).alias("own")
    )
    return (
        of_texts.select(F.explode("ids").alias("id"), "known", "own")
        .groupBy("id")
        .agg(F.sort_array(F.flatten(F.collect_list("known"))).alias("known"), F.sum("own").alias("own"))
    )


def met_by_key(keyed: DataFrame) -> DataFrame:
    """Pairs ``x, y`` (ids) of different classes that meet under enough keys: ``most`` of one of them, less the
    ``common`` ones of both. At most ``COMMON`` texts have a key."""
    texts_ = F.collect_list(F.struct("id", "class", "n_words", "most", "common"))
    of_key = keyed.groupBy("key").agg(texts_.alias("texts")).where(F.size("texts") > 1)
    x, y = F.col("x"), F.col("y")
    other = F.filter(
        "texts",
        lambda t: (t["id"] > x["id"]) & (t["class"] != x["class"]) & _alike(t["n_words"], x["n_words"]),
    )
    least = F.least(x["most"], y["most"]) - F.least(x["common"], y["common"])
    return (
        of_key.select("texts", F.explode("texts").alias("x"))
        .select("x", F.explode(other).alias("y"))
        .groupBy(x["id"].alias("x_id"), y["id"].alias("y_id"))
        .agg(F.count("*").alias("met"), F.first(least).alias("least"))
        .where("met >= least")
        .select(F.col("x_id").alias("x"), F.col("y_id").alias("y"))
    )


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many values each array of ``left`` shares with each of ``right``; no two of an array are equal."""
    values = np.intersect1d(np.concatenate(left), np.concatenate(right))

    def placed(arrays: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        row, value = np.repeat(np.arange(len(arrays)), [len(x) for x in arrays]), np.concatenate(arrays)
        held = np.isin(value, values)
        row, place = row[held], np.searchsorted(values, value[held])
        order = np.argsort(place, kind="stable")
        return row[order], place[order]

    def table(rows: int, row: np.ndarray, place: np.ndarray, start: int) -> np.ndarray:
        some = slice(*np.searchsorted(place, (start, start + COLUMNS)))
        out = np.zeros((rows, COLUMNS), np.float32)
        out[row[some], place[some] - start] = 1
        return out

    of_left, of_right = placed(left), placed(right)
    out = np.zeros((len(left), len(right)), np.int64)
    for start in range(0, len(values), COLUMNS):
        product = table(len(left), *of_left, start) @ table(len(right), *of_right, start).T
        out += product.astype(np.int64)
    return out


def links_of_blocks(rows: pd.DataFrame, one: bool) -> Iterator[tuple[bytes, bytes, float]]:
    """The links between the texts of two blocks, or inside ``one``, that connect classes not yet connected. Pairs
    whose words and runs of words in common allow no link are not aligned."""
    rows = rows.sort_values("node")
    sides = [rows, rows] if one else [rows[rows["side"] == 0], rows[rows["side"] == 1]]
    if not all(map(len, sides)):
        return
    words = [[words_of(t) for t in side["text"]] for side in sides]
    hashes = [[hashed(w) for w in ws] for ws in words]
    n, class_, node = ([side[c].to_numpy() for side in sides] for c in ("n_words", "class", "node"))
    longer = np.maximum.outer(*n)
    most = ((1 - SIMILARITY) * longer + 1e-9).astype(np.int64)
    left = np.not_equal.outer(*class_) & (longer - np.minimum.outer(*n) <= most)
    if one:
        left &= np.triu(left, 1)
    for size in COUNTED:
        if not left.any():
            return
        counts = shared_counts(*([labelled_runs(h, size) for h in hs] for hs in hashes))
        left &= counts >= longer - size + 1 - size * most
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while parent.get(c, c) != c:
            c = parent[c]
        return c

    # Texts of the first side stand side by side as bits, as many as ``BITS`` holds.
    of_group = (np.cumsum(n[0]) - n[0]) // BITS
    for group in np.split(np.arange(len(n[0])), np.flatnonzero(np.diff(of_group)) + 1):
        edits_of = None
        for j in np.flatnonzero(left[group].any(axis=0)):
            apart = [i for i in group[left[group, j]] if root(class_[0][i]) != root(class_[1][j])]
            if len(apart) >= MANY:
                edits_of = edits_of or edits_of_each([words[0][i] for i in group])
                near = edits_of(words[1][j]) <= most[group, j]
                apart = [i for i in apart if near[i - group[0]]]
            for i in apart:
                a, b = root(class_[0][i]), root(class_[1][j])
                if a != b and (reached := similarity(words[0][i], words[1][j])):
                    parent[a] = b
                    x, y = sorted((node[0][i], node[1][j]))
                    yield x, y, reached


def block_links(held: DataFrame) -> DataFrame:
    """Links between the texts ``held`` (``node, class, n_words, text``) that connect all classes which any of their
    links connects: every two texts of like lengths are compared, a block of them with a block at a time."""
    # Lengths that allow the similarity are in one band or in neighbouring ones.
    band = F.floor(F.log("n_words") / (math.log(1 / SIMILARITY) * (1 + 1e-9)))
    rows = held.select("node", "class", "n_words", "text", band.alias("band"))
    blocks = rows.groupBy("band").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    rows = saved(
        rows.join(blocks, "band").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))).drop("blocks")
    )
    ends = rows.select("band", "block").distinct()
    second = ends.select(F.col("band").alias("_band"), F.col("block").alias("_block"))
    cell = ["band", "block", "_band", "_block"]
    cells = (
        ends.withColumn("_band", F.explode(F.array("band", F.col("band") + 1)))
        .join(second, "_band")
        .where("band < _band OR block <= _block")
    )
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.col("band").alias("b"), F.col("block").alias("k")),
        F.struct(F.lit(1).alias("side"), F.col("_band").alias("b"), F.col("_block").alias("k")),
    )
    one = (F.col("band") == F.col("_band")) & (F.col("block") == F.col("_block"))
    cells = cells.select(*cell, F.explode(F.slice(sides, 1, F.when(one, 1).otherwise(2))).alias("s"))
    of_block = rows.select(F.col("band").alias("b"), F.col("block").alias("k"), "node", "class", "n_words", "text")

    def links(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(list(links_of_blocks(rows, key[:2] == key[2:])), columns=["a", "b", "similarity"])

    # Cells are small in bytes and long in time: each partition stays a task.
    tasks = int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        cells.select(*cell, "s.*")
        .join(of_block, ["b", "k"])
        .repartition(tasks, *cell)
        .groupBy(*cell)
        .applyInPandas(links, "a binary, b binary, similarity double")
    )


def last_pairs(entries: DataFrame, labels: DataFrame, of_node: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pairs of texts of a bucket that are still apart and may be near copies, and the texts that have others
    among themselves, too many of whose words are common."""
    rows = apart(entries, labels)
    # Runs of words travel with a short number of their text, not with its digest.
    crowd = saved(
        rows.where(F.col("size") > FEW)
        .select("node", "n_words", F.xxhash64("class").alias("class"))
        .distinct()
        .withColumn("id", F.monotonically_increasing_id())
    )
    held = saved(of_node.select("node", "text").join(crowd, "node"))
    by_two, left = rare_pairs(held, 2)
    held = saved(held.join(left, "id", "left_semi"))
    by_one, left = rare_pairs(held, 1)
    met = by_two.unionAll(by_one).distinct()
    for side in ("x", "y"):
        met = met.join(crowd.select(F.col("id").alias(side), F.col("node").alias(f"of_{side}")), side)
    pairs = few_pairs(rows).unionAll(met.select(*_pair("of_x", "of_y"))).distinct()
    return pairs, held.join(left, "id", "left_semi")


# -- alignment ---------------------------------------------------------------


def edits(a: list, b: list, most: int) -> int:
    """The edit distance of two sequences, or ``most + 1`` if it is larger. Diagonals of the alignment are
    followed inside a band that grows by one with each edit; when this would take as many steps as there are words,
    the rest of the question goes to bit vectors."""
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return most + 1
    reach = {0: _slide(a, b, 0, 0)}  # diagonal (place in b less place in a): farthest place in a
    if reach[0] >= n and n == m:
        return 0
    band = min(most, BAND, math.isqrt(n + m))
    for edit in range(1, band + 1):
        new = {}
        for diagonal in range(-min(edit, n), min(edit, m) + 1):
            place = max(
                reach.get(diagonal, -2) + 1,  # one for another
                reach.get(diagonal + 1, -2) + 1,  # one of a goes
                reach.get(diagonal - 1, -2),  # one of b comes
            )
            place = min(place, n, m - diagonal)
            if place < 0 or place + diagonal < 0:
                continue
            new[diagonal] = _slide(a, b, place, place + diagonal)
        reach = new
        if reach.get(m - n, -1) >= n:
            return edit
    return most + 1 if most <= band else min(edits_by_bits(a, b), most + 1)


def _slide(a: list, b: list, i: int, j: int) -> int:
    n, m = len(a), len(b)
    while i < n and j < m and a[i] == b[j]:
        i += 1
        j += 1
    return i


def edits_by_bits(a: list, b: list) -> int:
    """The edit distance, a column of differences at a time, as bits of one number."""
    if not a:
        return len(b)
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    all_, last = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, distance = all_, 0, len(a)
    for y in b:
        same = places.get(y, 0)
        zero = (((same & up) + up) ^ up) | same | down
        right, left = down | (all_ & ~(zero | up)), up & zero
        if right & last:
            distance += 1
        elif left & last:
            distance -= 1
        right, left = (right << 1 | 1) & all_, left << 1 & all_
        up, down = left | (all_ & ~(zero | right)), right & zero
    return distance


def edits_of_each(sequences: list[list]) -> Callable[[list], np.ndarray]:
    """The edit distances of each of these to another sequence, as ``edits_by_bits`` has them: all stand side by side
    in one number, with a bit above each that takes what an addition carries out of it."""
    starts = np.cumsum([0, *(len(s) + 1 for s in sequences)])

    def number(places) -> int:
        bits = np.zeros(starts[-1], np.uint8)
        bits[places] = 1
        return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")

    found: dict = {}
    for start, sequence in zip(starts.tolist(), sequences):
        for i, x in enumerate(sequence, start):
            found.setdefault(x, []).append(i)
    places = {x: number(at) for x, at in found.items()}
    first, all_ = number(starts[:-1]), number(np.setdiff1d(np.arange(starts[-1]), starts[1:] - 1))

    def bits_of(value: int) -> np.ndarray:
        held = np.frombuffer(value.to_bytes(-(-int(starts[-1]) // 8), "little"), np.uint8)
        return np.unpackbits(held, count=int(starts[-1]), bitorder="little").astype(np.int64)

    def distances(b: list) -> np.ndarray:
        up, down = all_, 0
        for y in b:
            same = places.get(y, 0)
            zero = ((((same & up) + up) ^ up) | same | down) & all_
            right, left = down | (all_ & ~(zero | up)), up & zero
            right, left = (right << 1 | first) & all_, left << 1 & all_
            up, down = left | (all_ & ~(zero | right)), right & zero
        return len(b) + np.add.reduceat(bits_of(up) - bits_of(down), starts[:-1])

    return distances


def similarity(a: list, b: list, least: float = SIMILARITY) -> float:
    """1 less the edit distance over the longer length; 0 for pairs below ``least``."""
    longer = max(len(a), len(b))
    if not longer:
        return 1.0
    most = int((1 - least) * longer + 1e-9)
    for size in COUNTED:  # an edit changes so many runs at most; those in common are not enough
        x, y = (Counter(zip(*(side[k:] for k in range(size)))) for side in (a, b))
        if (x & y).total() < longer - size + 1 - size * most:
            return 0.0
    found = edits(a, b, most)
    return 1 - found / longer if found <= most else 0.0


def aligned(pairs: DataFrame, of_node: DataFrame) -> DataFrame:
    """The pairs whose alignment reaches the similarity, with it."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("similarity", pa.float64())])

    def rows(incoming: Iterator[pa.RecordBatch]):
        for batch in incoming:
            for a, b, x, y in zip(*batch.columns):
                found = similarity(words_of(x.as_py()), words_of(y.as_py()))
                if found:
                    yield a.as_py(), b.as_py(), found

    both = (
        pairs.select("a", "b")
        .join(of_node.select(F.col("node").alias("a"), F.col("text").alias("x")), "a")
        .join(of_node.select(F.col("node").alias("b"), F.col("text").alias("y")), "b")
    )
    return saved(
        both.select("a", "b", "x", "y").mapInArrow(
            lambda incoming: batches(rows(incoming), schema, 4096), "a binary, b binary, similarity double"
        )
    )


# -- classes -----------------------------------------------------------------


def contracted(links: DataFrame) -> DataFrame:
    """Links ``a, b`` that connect the same nodes as these of a written table: those that lie together, up to
    ``CACHED`` nodes at a time, become links of each node to the least one that they connect it with. A task takes
    about ``CACHED`` links, however many partitions they lie in."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def rows(incoming: Iterator[pa.RecordBatch]):
        parent: dict[bytes, bytes] = {}

        def root(x: bytes) -> bytes:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[up]
            return x

        for batch in incoming:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = root(a), root(b)
                parent[max(a, b)] = min(a, b)
                if len(parent) >= CACHED:
                    yield from ((x, root(x)) for x in list(parent) if root(x) != x)
                    parent.clear()
        yield from ((x, root(x)) for x in list(parent) if root(x) != x)

    tasks = max(1, -(-links.count() // CACHED))
    return (
        links.select("a", "b")
        .coalesce(tasks)
        .mapInArrow(lambda incoming: batches(rows(incoming), schema, 4096), "a binary, b binary")
    )


def components(links: DataFrame) -> DataFrame:
    """``node, class`` of every node of the links: the least node it is connected with. In each round all nodes of a
    label take the least label next to any of them, then the label of that label, until none changes. Links that lie
    together are contracted first, which leaves few rounds."""
    links = contracted(saved(links.select("a", "b").where("a != b").distinct()))
    both = saved(links.union(links.select("b", "a")).distinct())
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("class")))
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("class").alias("near"))
        )
        met = labels.join(near, "node")
        least = met.groupBy("class").agg(F.min("near").alias("least"))
        lower = met.join(least, "class").select("node", "class", F.least("class", "least").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("class").alias("of_low"))
        new = saved(
            lower.join(jump, "low", "left").select(
                "node",
                F.least("low", F.coalesce("of_low", "low")).alias("class"),
                (F.least("low", F.coalesce("of_low", "low")) != F.col("class")).alias("moved"),
            )
        )
        moved = new.where("moved").limit(1).count()
        labels = new.drop("moved")
        if not moved:
            return labels


def joined_classes(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links: the classes at their ends are the nodes of a small graph, whose components
    are the new classes."""
    for side in ("a", "b"):
        of = labels.select(F.col("node").alias(side), F.col("class").alias("_class"))
        links = links.select("a", "b").join(of, side, "left")
        links = links.withColumn(side, F.coalesce("_class", side)).drop("_class")
    up = components(links.where("a != b"))
    of_class = up.select(F.col("node").alias("class"), F.col("class").alias("_class"))
    moved = labels.join(of_class, "class", "left").select("node", F.coalesce("_class", "class").alias("class"))
    return saved(moved.unionByName(up.join(labels.select("node"), "node", "left_anti")))


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``node, class`` of the texts that have a link, and the links found."""
    entries = saved(entries_of(saved(sketched(docs).dropDuplicates(["node"]))))
    # Texts always meet their nodes in a shuffle: how many nodes have a bucket grows with the texts.
    met = entries.select("node").distinct().hint("merge")
    of_node = saved(
        docs.select(node_of().alias("node"), "text").join(met, "node", "left_semi").dropDuplicates(["node"])
    )
    tried = saved(first_pairs(entries))
    links = aligned(tried, of_node)
    labels = components(links)
    for step in (1, 2, 3):
        if step == 3:
            more, common = last_pairs(entries, labels, of_node)
        else:
            more = later_pairs(entries, labels, step == 1)
        pairs = saved(more.join(tried, ["a", "b"], "left_anti"))
        new = aligned(pairs, of_node)
        if step == 3:
            new = saved(new.unionAll(block_links(common)).dropDuplicates(["a", "b"]))
        labels = joined_classes(labels, new)
        links, tried = links.unionAll(new), tried.unionAll(pairs)
    return labels, links


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, class_id, class_size, n_links, kept``.

    ``class_id`` is the least id of the class, null if no row of it has an id; ``class_size`` counts rows;
    ``n_links`` counts the links found from the text of the row to different texts. Of each class the rows with
    ``class_id`` are kept. Equal texts are always one class; null texts count as empty, and texts without words
    are in a class with equal ones only.
    """
    rows = texts(docs)
    labels, links = classes(rows)
    of_row = saved(rows.select("doc_id", node_of().alias("node")))
    nodes = of_row.groupBy("node").agg(F.min("doc_id").alias("low"), F.count("*").alias("n"))
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    marked = nodes.join(labels, "node", "left").join(ends, "node", "left").withColumn("class", F.coalesce("class", "node"))
    whole = marked.groupBy("class").agg(F.min("low").alias("class_id"), F.sum("n").alias("class_size"))
    decided = marked.join(whole, "class").select(
        "node", "class_id", "class_size", F.coalesce("n_links", F.lit(0)).alias("n_links")
    )
    return of_row.join(decided, "node").select(
        "doc_id",
        "class_id",
        "class_size",
        "n_links",
        F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"),
    )


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, one of each class: one with the least id."""
    find_package(docs.sparkSession)
    labels, _ = classes(texts(docs))
    rows = docs.select(
        whole_row(docs).alias("row"),
        F.col("doc_id").alias("doc_id"),
        node_of(F.coalesce("text", F.lit(""))).alias("node"),
    )
    by_id = rows.groupBy("node", "doc_id").agg(F.count("*").alias("n"))
    nodes = by_id.groupBy("node").agg(
        F.min("doc_id").alias("low"),
        F.coalesce(F.min_by("n", "doc_id"), F.sum("n")).alias("n_low"),
        F.sum("n").alias("n"),
    )
    # A text without links is a class of its own.
    grouped = nodes.join(labels, "node", "left").withColumn("class", F.coalesce("class", "node"))
    first = F.min_by("node", F.struct(F.col("low").isNull(), "low", "node"))
    stays = grouped.groupBy("class").agg(first.alias("first"))
    marks = saved(
        grouped.join(stays, "class")
        .select("node", "low", "n_low", "n", (F.col("node") == F.col("first")).alias("stays"))
        .where("n > 1 OR NOT stays")
    )
    # One shuffle of the rows, whatever the number of marks. Rows without a mark are alone.
    chosen = rows.join(marks.hint("merge"), "node", "left").where(
        F.col("stays").isNull()
        | (F.col("stays") & F.col("doc_id").eqNullSafe(F.col("low")) & (F.col("n_low") == 1))
    )
    # Rows that repeat with their id: one of them.
    again = saved(marks.where("stays AND n_low > 1").select("node", "low"))
    repeated = (
        rows.join(again, "node")
        .where(F.col("doc_id").eqNullSafe(F.col("low")))
        .groupBy("node")
        .agg(F.first("row").alias("row"))
    )
    return chosen.select("row.*").unionAll(repeated.select("row.*"))
