"""Batch writes of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def save(rows: DataFrame, path: str, mode: str = "append", fmt: str = "parquet") -> None:
    """Write rows to a table path. ``fmt="delta"`` where Spark has that format."""
    rows.write.format(fmt).mode(mode).save(path)


def save_for_lookup(rows: DataFrame, path: str, *keys: str, mode: str = "append") -> None:
    """Write rows to a parquet path where an equality filter on one of ``keys`` skips what cannot hold the value.

    Each row group gets a bloom filter per key (or a dictionary, which serves the same), sized by what it holds;
    the rows of a file are sorted, so that inside a row group only the pages around a first key are read.
    Rows stay in the partitions they are in: no shuffle."""
    writer = rows.sortWithinPartitions(*keys).write.mode(mode)
    writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true").option("parquet.page.row.count.limit", 1000)
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer.parquet(path)


def save_table(rows: DataFrame, name: str, mode: str = "append", fmt: str = "parquet") -> None:
    rows.write.format(fmt).mode(mode).saveAsTable(name)
