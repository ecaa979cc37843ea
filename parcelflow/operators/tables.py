"""Filters, aggregates and orderings over the flat tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.schemas import PENDING, PROCESSING

PACKAGE_KEYS = ("package_id", "subpackage_id")


def with_status(df: DataFrame, status: str) -> DataFrame:
    return df.where(F.col("status") == status)


def not_processing(df: DataFrame) -> DataFrame:
    return df.where(F.col("status") != PROCESSING)


def up_to(df: DataFrame, column: str, bound: datetime | Column) -> DataFrame:
    """Rows no later than ``bound``; also valid on a stream."""
    return df.where(F.col(column) <= (bound if isinstance(bound, Column) else F.lit(bound)))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def package_demand(items: DataFrame, status: str | None = PENDING) -> DataFrame:
    """Ordered quantity per package. Rows are summed before the shuffle, so a
    package in many orders costs one row per task. ``status=None`` takes all."""
    rows = items if status is None else with_status(items, status)
    return rows.groupBy(*PACKAGE_KEYS).agg(F.sum("items_quantity").alias("items_quantity"))


def product_demand(items_v1: DataFrame) -> DataFrame:
    return items_v1.groupBy("product_id").agg(F.sum("quantity").alias("quantity"))


def threshold_totals(
    items: DataFrame, weight: str = "weight", quantity: str = "quantity", by: str | None = None
) -> DataFrame:
    """Weight and quantity in processing, in all or per ``by``."""
    groups = [] if by is None else [by]
    return (
        with_status(items, PROCESSING)
        .groupBy(*groups)
        .agg(F.sum(weight).alias("total_weight"), F.sum(quantity).alias("total_quantity"))
    )


def total_order_weight(envelopes: DataFrame) -> DataFrame:
    return envelopes.agg(F.sum("order_details.total_weight").alias("total_weight"))


def max_timestamp(df: DataFrame, column: str) -> DataFrame:
    """Latest time in the table as one row; null when the table is empty."""
    return df.agg(F.max(column).alias("max_timestamp"))


def distinct_count(df: DataFrame, *keys: str) -> DataFrame:
    return row_count(df.dropDuplicates(list(keys)))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def orders_to_process(items: DataFrame) -> DataFrame:
    """The orders that have pending items, one row each."""
    return with_status(items, PENDING).select("order_id").dropDuplicates(["order_id"])


def latest_first(df: DataFrame, column: str, *ties: str, limit: int | None = None) -> DataFrame:
    """Newest rows first. A ``limit`` keeps the top rows per task and merges
    those, without a full sort."""
    ordered = df.orderBy(F.desc(column), *ties)
    return ordered if limit is None else ordered.limit(limit)


def by_stock(packages: DataFrame, ascending: bool = True) -> DataFrame:
    stock = F.col("stock_quantity")
    return packages.orderBy(stock.asc() if ascending else stock.desc(), *PACKAGE_KEYS)
