"""A Merkle manifest of a dataset, with a proof for every row found by pointer jumping.

A row's digest is a leaf. Per source, leaves stand in order of their ids and every ``WIDTH`` neighbours
become one node, level by level up to a subroot; subroots in order of their sources become the root in
the same way. A proof is what must stand left and right of a digest at each level to get the next one.

Every node starts with the segment of its proof that leads to its parent. In a round all remaining nodes
join those that their segments reach and append the segments of these, which doubles the distance, so a
tree of height h takes log2(h) rounds; nodes that no later round asks for are left out. High up many nodes
reach the same one: rows are joined in blocks of ``BLOCK`` neighbours and the node that they reach is
copied once for each block, so no key has more rows than that and copies stay a small share of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.common import crc_of_id, saved

#: Children of a node.
WIDTH = 3
#: Levels below a node whose nodes may join it without blocks, and the neighbours of a block.
NEAR = 6
BLOCK = WIDTH**NEAR

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree number of the tree over subroots; those of the sources count from 0.
TOP = -1


# -- digests -----------------------------------------------------------------


def digest(*hex_or_text: Column) -> Column:
    """Lowercase hex sha256 of strings one behind the other."""
    return F.sha2(F.concat(*hex_or_text), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes in front, so that no two lists of values look alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(**other: Column) -> Column:
    """The leaf of a row of documents, or of the row with other values in the named columns."""
    return digest(*(field(other.get(c, F.col(c))) for c in FIELDS))


def _hex(binary: Column) -> Column:
    return F.lower(F.hex(binary))


# -- trees -------------------------------------------------------------------


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, the place within the group in this order (nulls first), and ``leaves``, the rows
    of the group. Rows are sorted over all groups in even ranges, however they are dealt over groups, and a
    table with one row for each group of each range tells what comes before. Equal rows get any places."""
    keys = [group, *order]
    tie = saved(rows.withColumn("_tie", F.monotonically_increasing_id()))
    by_range = tie.repartitionByRange(*keys, "_tie").sortWithinPartitions(*keys, "_tie").drop("_tie")
    placed = saved(by_range.withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", 33)
    placed = placed.withColumn("_part", part)
    parts = placed.groupBy(group, "_part").agg(F.min("_place").alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col(group).alias("_group"),
        F.col("_part").alias("_of"),
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(Window.partitionBy(group)).alias("leaves"),
    )
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_of"))
    return placed.join(parts, same).withColumn("pos", F.col("_place") + F.col("_shift")).drop(
        "_place", "_part", "_group", "_of", "_shift"
    )


def on_level(level: int) -> Column:
    """The number of nodes of a tree on a level, from the number of its leaves."""
    return F.expr(f"(leaves + {WIDTH**level - 1}) div {WIDTH**level}")


def trees(leaves: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """From ``tree, pos, leaves, digest, row`` (binary digests; at most ``most`` leaves a tree): the segments
    of all nodes below a tree's top, and the tops, ``tree, digest``.

    A segment has ``tree, level, pos, leaves, row`` and ``proof``, an array of one pair of what stands left
    and right. A lone leaf is its tree's top; its proof is empty.
    """
    nodes, level, segments, tops = leaves, 0, [], []
    empty = F.expr("cast(array() AS array<struct<left: binary, right: binary>>)")
    segments.append(
        leaves.where("leaves = 1").select("tree", F.lit(0).alias("level"), "pos", "leaves", "row", empty.alias("proof"))
    )
    while True:
        tops.append(nodes.where(on_level(level) == 1).select("tree", "digest"))
        if -(-most // WIDTH**level) <= 1:
            break
        inner = nodes.where(on_level(level) > 1)
        place = F.expr(f"pos % {WIDTH}")
        kids = [F.max(F.when(place == k, F.struct("digest", "row"))).alias(f"k{k}") for k in range(WIDTH)]
        groups = inner.groupBy("tree", F.expr(f"pos div {WIDTH}").alias("pos")).agg(F.max("leaves").alias("leaves"), *kids)
        present = [F.coalesce(_hex(F.col(f"k{k}.digest")), F.lit("")) for k in range(WIDTH)]
        groups = saved(groups.withColumn("digest", F.unhex(digest(*present))))
        segments.append(_segments(groups, level))
        row_type = leaves.schema["row"].dataType
        nodes = groups.select("tree", "pos", "leaves", "digest", F.lit(None).cast(row_type).alias("row"))
        level += 1
    return _union(segments), _union(tops)


def _segments(groups: DataFrame, level: int) -> DataFrame:
    """The children of the nodes of a level above with what stands beside them."""
    digests = [F.coalesce(F.col(f"k{k}.digest"), F.lit(b"")) for k in range(WIDTH)]
    children = []
    for k in range(WIDTH):
        sides = F.struct(
            F.concat(F.lit(b""), *digests[:k]).alias("left"), F.concat(F.lit(b""), *digests[k + 1 :]).alias("right")
        )
        there = F.col(f"k{k}").isNotNull()
        children.append(
            F.when(there, F.struct((F.col("pos") * WIDTH + k).alias("pos"), F.col(f"k{k}.row").alias("row"), sides.alias("sides")))
        )
    one = groups.select("tree", "leaves", F.explode(F.array_compact(F.array(*children))).alias("child"))
    return one.select(
        "tree",
        F.lit(level).alias("level"),
        "child.pos",
        "leaves",
        "child.row",
        F.array("child.sides").alias("proof"),
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


# -- proofs ------------------------------------------------------------------


def with_blocks(rows: DataFrame, first: Column, end: Column, name: str) -> DataFrame:
    """Each row once for each number from ``first`` up to ``end``, which is left out; in two steps, so that no
    row ever carries more than a short list of numbers."""
    step = 1 << 12
    coarse = rows.withColumns({"_first": first.cast("bigint"), "_end": end.cast("bigint")})
    coarse = coarse.withColumn("_from", F.explode(F.expr(f"sequence(_first, _end - 1, {step}L)")))
    numbers = F.expr(f"sequence(_from, least(_from + {step - 1}, _end - 1))")
    return coarse.withColumn(name, F.explode(numbers)).drop("_first", "_end", "_from")


def jump(rows: DataFrame, distance: int) -> DataFrame:
    """Segments of ``distance`` levels joined to those of the nodes that they reach, of the same length."""
    low = rows.where(F.col("level") % (2 * distance) == 0)
    high = rows.where(F.col("level") % (2 * distance) == distance)
    low = low.withColumn("to", F.expr(f"pos div {WIDTH**distance}"))
    high = high.select("tree", (F.col("level") - distance).alias("level"), F.col("pos").alias("to"), "leaves", F.col("proof").alias("more"))
    keys = ["tree", "level", "to"]
    if distance > NEAR:
        below = WIDTH ** (distance - NEAR)
        # Nodes of the tree on the level of ``low``, in blocks.
        blocks = F.expr(f"(leaves - 1) div cast(power({WIDTH}, level) AS bigint) div {BLOCK} + 1")
        high = with_blocks(high, F.col("to") * below, F.least((F.col("to") + 1) * below, blocks), "block")
        low = low.withColumn("block", F.expr(f"pos div {BLOCK}"))
        keys.append("block")
    joined = low.join(high.drop("leaves"), keys, "left")
    none = F.expr("cast(array() AS array<struct<left: binary, right: binary>>)")
    return joined.select(
        "tree", "level", "pos", "leaves", "row", F.concat("proof", F.coalesce("more", none)).alias("proof")
    )


def to_tops(segments: DataFrame, most: int) -> DataFrame:
    """The segments of leaves, grown until each reaches the top of its tree."""
    height = 0
    while -(-most // WIDTH**height) > 1:
        height += 1
    distance, rows = 1, segments
    while distance < height:
        rows = saved(jump(rows, distance))
        distance *= 2
    return rows


def manifest(docs: DataFrame, claim: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, leaf, subroot, root`` (lowercase hex), ``proof`` (pairs of hex
    digests that stand left and right, from the leaf's level up), ``claim``.

    ``claim`` is a digest computed from the columns of ``docs``, to be checked against the proof; the leaf
    itself, if none is given. Null ids come first in their source and null sources first of all; rows with
    the same id stand in order of their leaves, and equal rows in any order. All columns of a leaf may be
    null, texts are hashed whole, and other columns don't matter. An empty table gives an empty result.
    """
    leaf = row_digest()
    rows = docs.select(
        F.col("source").alias("source"),
        F.col("doc_id").alias("doc_id"),
        F.unhex(leaf).alias("digest"),
        F.unhex(leaf if claim is None else claim).alias("claim"),
    )
    rows = ranked(rows, "source", ["doc_id", "digest"])
    rows = saved(rows)
    sources = rows.where("pos = 0").select("source", F.lit(True).alias("_all"), F.col("leaves").alias("size"))
    sources = saved(
        ranked(sources, "_all", ["source"]).select("source", F.col("pos").alias("tree"), "size", F.col("leaves").alias("trees"))
    )
    bounds = sources.agg(F.max("size").alias("size"), F.max("trees").alias("trees")).first()
    # The number of a source reaches its rows by ranges of neighbours: one source may hold most of all rows.
    block = F.expr(f"pos div {BLOCK}")
    numbers = with_blocks(
        sources.select(F.col("source").alias("_source"), "tree", "size"),
        F.lit(0),
        F.expr(f"(size - 1) div {BLOCK} + 1"),
        "_block",
    )
    leaves = rows.withColumn("_at", block).join(
        numbers, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_at") == F.col("_block"))
    )
    leaves = leaves.select("tree", "pos", "leaves", "digest", F.struct("doc_id", "digest", "claim").alias("row"))
    leaves = saved(leaves)
    segments, tops = trees(leaves, bounds.size or 0)
    paths = to_tops(segments, bounds.size or 0)

    subroots = saved(tops)
    above = subroots.join(sources, "tree").select(
        F.lit(TOP).cast("bigint").alias("tree"),
        F.col("tree").alias("pos"),
        F.col("trees").alias("leaves"),
        "digest",
        F.struct("digest", "size").alias("row"),
    )
    segments, tops = trees(above, bounds.trees or 0)
    upper = to_tops(segments, bounds.trees or 0).select(
        F.col("pos").alias("tree"),
        F.col("row.digest").alias("subroot"),
        F.col("proof").alias("more"),
        F.col("row.size").alias("size"),
    )
    upper = with_blocks(upper, F.lit(0), F.expr(f"(size - 1) div {BLOCK} + 1"), "block")
    root = tops.first()
    sides = F.concat("proof", "more")
    return (
        paths.withColumn("block", block)
        .join(upper, ["tree", "block"])
        .select(
            "row.doc_id",
            _hex(F.col("row.digest")).alias("leaf"),
            _hex(F.col("subroot")).alias("subroot"),
            F.lit(root.digest.hex() if root else "").alias("root"),
            F.transform(
                sides, lambda s: F.struct(_hex(s["left"]).alias("left"), _hex(s["right"]).alias("right"))
            ).alias("proof"),
            _hex(F.col("row.claim")).alias("claim"),
        )
    )


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(proof, leaf, lambda at, sides: digest(sides["left"], at, sides["right"]))


def proof_digest(proof: Column) -> Column:
    """The digest of all digests of a proof, level by level, left to right."""
    return digest(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""))


def check_rows(docs: DataFrame, claim: Column) -> DataFrame:
    """The manifest of ``docs`` with what a claimed leaf of each row folds to, and whether that is the root."""
    found = manifest(docs, claim)
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("proof")).alias("proof_sha256"),
        folded(F.col("claim"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def without_line_ends() -> Column:
    """The leaf of a row; where crc32(doc_id) is even, of the row without the line feeds of its text."""
    cut = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    return row_digest(text=F.when(F.pmod(crc_of_id(), F.lit(2)) == 0, cut).otherwise(F.col("text")))


#: crc32 of a number's decimal text, for DuckDB: ``crc_table`` holds the 256 remainders in ``t``.
CRC_TABLE_SQL = """crc_table AS MATERIALIZED (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(0, 256))::BIGINT AS i))"""


def crc_sql(octets: str) -> str:
    """crc32 of a list of bytes (BIGINT) in DuckDB, beside ``crc_table``."""
    return (
        f"xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], {octets}), "
        "lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])))"
    )


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


def _leaf_sql(text: str) -> str:
    return f"sha256({' || '.join(_field_sql(text if c == 'text' else c) for c in FIELDS)})"


MANIFEST_SQL = f"""
WITH RECURSIVE {CRC_TABLE_SQL},
docs AS (
  SELECT *, {crc_sql("list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda x: ascii(x)::BIGINT)")} AS crc
  FROM documents, crc_table),
leaves AS (
  SELECT doc_id, source, {_leaf_sql("text")} AS leaf,
    {_leaf_sql("CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")} AS claim FROM docs),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n, row_number() OVER () AS item FROM leaves),
nodes(source, level, pos, n, digest) AS (
  SELECT source, 0, pos, n, leaf FROM placed
  UNION ALL
  SELECT source, level + 1, pos // 3, (max(n) + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY source, level, pos // 3),
tops AS (
  SELECT source, level AS height, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos,
    count(*) OVER () AS n FROM nodes WHERE n = 1),
upper(level, pos, n, digest) AS (
  SELECT 0, pos, n, digest FROM tops
  UNION ALL
  SELECT level + 1, pos // 3, (max(n) + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM upper WHERE n > 1 GROUP BY level, pos // 3),
sides AS (
  SELECT a.source, a.level, a.pos,
    coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM nodes a JOIN nodes b ON a.source IS NOT DISTINCT FROM b.source AND a.level = b.level AND a.pos // 3 = b.pos // 3
  WHERE a.n > 1 GROUP BY ALL),
upper_sides AS (
  SELECT a.level, a.pos,
    coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM upper a JOIN upper b ON a.level = b.level AND a.pos // 3 = b.pos // 3
  WHERE a.n > 1 GROUP BY ALL),
steps AS (
  SELECT item, s.level, s.l, s.r FROM placed p
  JOIN sides s ON p.source IS NOT DISTINCT FROM s.source AND p.pos // (3 ** s.level)::BIGINT = s.pos
  UNION ALL
  SELECT item, t.height + u.level, u.l, u.r FROM placed p
  JOIN tops t ON p.source IS NOT DISTINCT FROM t.source
  JOIN upper_sides u ON t.pos // (3 ** u.level)::BIGINT = u.pos),
folds(item, level, held) AS (
  SELECT item, 0, claim FROM placed
  UNION ALL
  SELECT f.item, f.level + 1, sha256(s.l || f.held || s.r) FROM folds f JOIN steps s USING (item, level)),
proofs AS (SELECT item, string_agg(l || r, '' ORDER BY level) AS siblings FROM steps GROUP BY item),
last AS (SELECT item, arg_max(held, level) AS folded FROM folds GROUP BY item)
SELECT p.doc_id, p.leaf, t.digest AS subroot, root.digest AS root, sha256(coalesce(siblings, '')) AS proof_sha256,
  folded AS folded_root, folded = root.digest AS verified
FROM placed p JOIN tops t ON p.source IS NOT DISTINCT FROM t.source
JOIN last USING (item) LEFT JOIN proofs USING (item)
CROSS JOIN (SELECT digest FROM upper WHERE n = 1) root
"""
