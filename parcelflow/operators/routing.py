"""Messages in order: routed to partitions by their key and numbered within each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.sources.landing import shared_folder
from parcelflow.sources.snapshots import COMPRESSION


def partition_of(key: str, partitions: int) -> Column:
    """The partition of a key, the same in every system that knows MD5; a null key goes with the empty one."""
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % partitions).cast("int")


def numbered_in_order(
    rows: DataFrame,
    group: str,
    order: Sequence[str],
    name: str,
    late: Mapping[str, Column] | None = None,
    ranges: int | None = None,
    few_groups: bool = False,
) -> DataFrame:
    """``rows`` with their place within the group, from 0 and without gaps.

    Groups may be few and large: rows are sorted over all groups in even ranges, which no group's size can make
    uneven, and a table with one row per group and range tells how many come before; with ``few_groups`` it goes to
    every task, so that rows are not shuffled again. Of rows that are equal
    in the group and the order any one comes first. The sorted rows are written once to the shared folder.

    ``late`` columns take the place of those of their names behind the shuffle; the order is that of their values.
    ``ranges`` is how many there are, where the session's shuffles would have too few.
    """
    spark, path = rows.sparkSession, shared_folder(rows.sparkSession)
    late = dict(late or {})
    ranged = rows.withColumn("_tie", F.monotonically_increasing_id())
    keys = [group, *order, "_tie"]
    ranged = ranged.repartitionByRange(*([ranges] if ranges else []), *(late.get(k, F.col(k)) for k in keys))
    ranged = ranged.withColumns(late).sortWithinPartitions(*keys).drop("_tie")
    ranged = ranged.withColumn("_place", F.monotonically_increasing_id())
    ranged.write.parquet(path, compression=COMPRESSION)
    placed = spark.read.schema(ranged.schema).parquet(path).withColumn("_range", F.shiftright("_place", 33))
    counts = placed.groupBy(F.col(group).alias("_group"), F.col("_range").alias("_of")).agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    before = Window.partitionBy("_group").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_shift", F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first"))
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_of"))
    numbered = placed.join(F.broadcast(counts) if few_groups else counts, same)
    return numbered.withColumn(name, F.col("_place") + F.col("_shift")).select(*rows.columns, name)


def routed(
    messages: DataFrame,
    partitions: int,
    order: Sequence[str],
    key: str = "partitionKey",
    late: Mapping[str, Column] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Messages with their ``partition`` and ``position`` in it. All messages of a key are in one partition, in
    this order, so a consumer of one partition sees each key in order, and knows a repeated message by a
    position that it has had. ``late`` and ``ranges`` as in ``numbered_in_order``; the key is none of ``late``."""
    parted = messages.withColumn("partition", partition_of(key, partitions))
    return numbered_in_order(parted, "partition", [*order, key], "position", late, ranges, few_groups=True)
