"""Exact duplicates with frequent texts removed on the map side.

A Misra-Gries summary (``freqItems``) names the digests that may hold more than a share
``support`` of all rows; it never misses one and never names more than ``2 / support``,
whatever the data. An exact count verifies them, and the verified ones, with the row that
stays, are broadcast: their rows are decided where they are read. Only the other digests,
each with less than that share, are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import saved, texts, whole_row

#: Share of all rows from which on a text counts as frequent; at most 200 are broadcast.
SUPPORT = 0.005


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id``, SHA-256 of the text, and a second hash and the length to verify it."""
    text = F.col("text")
    return texts(docs).select(
        "doc_id",
        F.sha2(text, 256).alias("digest"),
        F.xxhash64(text).alias("other_hash"),
        F.length(text).alias("n_points"),
    )


def frequent(rows: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Verified frequent digests with ``keep_id``, ``group_size`` and ``keep_rows`` (how many
    rows carry that id). A digest is verified if it holds the share and its rows agree on
    length and second hash."""
    # The summary holds 1 / support entries; half of it leaves room above the exact share.
    named = rows.stat.freqItems(["digest"], support / 2).select(
        F.explode("digest_freqItems").alias("digest")
    )
    least = rows.agg((F.count("*") * support).alias("least"))
    counts = _groups(rows.join(F.broadcast(named), "digest", "left_semi"))
    return counts.join(F.broadcast(least)).where(
        (F.col("group_size") >= F.col("least")) & F.col("agree")
    ).drop("least", "agree")


def _groups(rows: DataFrame) -> DataFrame:
    by_id = rows.groupBy("digest", "doc_id").agg(
        F.count("*").alias("n"),
        F.min("other_hash").alias("low"),
        F.max("other_hash").alias("high"),
        F.min("n_points").alias("short"),
        F.max("n_points").alias("long"),
    )
    return by_id.groupBy("digest").agg(
        F.max("doc_id").alias("keep_id"),
        F.sum("n").alias("group_size"),
        F.coalesce(F.max_by("n", "doc_id"), F.sum("n")).alias("keep_rows"),
        ((F.min("low") == F.max("high")) & (F.min("short") == F.max("long"))).alias("agree"),
    )


def decisions(rows: DataFrame, support: float = SUPPORT) -> tuple[DataFrame, DataFrame]:
    """The frequent groups (bounded, to be broadcast) and all other groups."""
    hot = saved(frequent(rows, support))
    rest = rows.join(F.broadcast(hot.select("digest")), "digest", "left_anti")
    return hot, _groups(rest).drop("agree")


def exact_duplicates(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when all their code points are. The row with the largest id stays; null
    ids come last, and in a group of null ids all rows are marked as kept, as are repeated
    rows of the id that stays (``keep_documents`` leaves one of them). A null text counts as
    empty. An empty table gives an empty result.
    """
    rows = saved(digests(docs))
    hot, rest = decisions(rows, support)
    marked = rows.join(F.broadcast(hot), "digest").unionByName(
        rows.join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(rest, "digest")
    )
    return marked.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def keep_documents(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """The rows of ``docs``, with all their columns, without copies: of equal texts one row of
    the largest id. Frequent texts leave on the map side; the rest meet their decision in one
    shuffle of the rows."""
    hot, rest = decisions(saved(digests(docs)), support)
    rows = docs.select(
        whole_row(docs).alias("row"),
        F.col("doc_id").alias("doc_id"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"),
    )
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    by_hot = rows.join(F.broadcast(hot), "digest").where(stays)
    others = rows.join(F.broadcast(hot.select("digest")), "digest", "left_anti")
    marked = by_hot.unionByName(others.join(rest, "digest").where(stays))
    single = marked.where("keep_rows = 1").select("row.*")
    repeated = marked.where("keep_rows > 1").dropDuplicates(["digest"]).select("row.*")
    return single.unionByName(repeated)


EXACT_DEDUP_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
