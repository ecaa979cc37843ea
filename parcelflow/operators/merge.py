"""Update-only merge as a DataFrame join.

A merge changes target rows whose keys match a source row. It inserts nothing
and deletes nothing: source rows without a target row have no effect, and null
keys never match. In ``set_`` and ``when`` the target is ``t`` and the source is
``s``, for instance ``{"stock": F.col("t.stock") - F.col("s.wanted")}``.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelflow.functions import hashed_if_large, now, packed_id, unpacked_id
from parcelflow.operators.projections import item_id
from parcelflow.operators.tables import PACKAGE_KEYS
from parcelflow.schemas import CANCELLED, PROCESSING

_COPIES = "_source_copies"
# What ``Merge.traced`` adds to the rows.
TRACE = "_trace"

# Items of an order, and packages of an item, that merges of placed items deal to one task.
PLACES = 16
# An order with more than this share of the rows is dealt to SALTS tasks.
HOT_SHARE, SALTS = 0.002, 64


@dataclass(frozen=True)
class Merge:
    """A declared merge. Its three results are plans over the same inputs."""

    target: DataFrame
    source: DataFrame
    on: Sequence[str]
    set_: Mapping[str, Column]
    when: Column | None = None
    # The source has one row per key by construction (a group-by).
    unique_source: bool = False
    # Source rows with the same key count once. Otherwise they are an error as
    # soon as their key exists in the target.
    collapse: bool = False
    # Many target rows may share a key.
    coarse: bool = False
    # The keys of the source are few and short, so that a task can hold its part of them.
    few_keys: bool = False
    # Columns that are row ids (``prefixed_hash``): shuffled and sorted as bytes, at
    # half the length. ``set_`` and ``when`` must not use them.
    ids: Sequence[str] = ()
    # Partitions of the join, where the caller knows both sides to be large.
    partitions: int | None = None
    _source: DataFrame = field(init=False, repr=False)

    def __post_init__(self):
        unknown = [c for c in self.set_ if c not in self.target.columns]
        if unknown:
            raise ValueError(f"columns not in the target: {unknown}")
        object.__setattr__(self, "_source", self._one_row_per_key())

    @property
    def source_keys(self) -> DataFrame:
        """The keys of the source as the target has them."""
        return self.source.select(*self.on)

    def _one_row_per_key(self) -> DataFrame:
        """The source with a copy count per key.

        Grouped by the join keys, the source is in place for the join without
        another shuffle. For a coarse merge that would be a trap: the run-time
        split of a hot key needs a shuffle for the join alone on both sides. So
        there the keys pass through an expression that leaves them as they are,
        but no longer counts as the grouped columns.
        """
        source = self._packed(self.source)
        if self.unique_source:
            return source.withColumn(_COPIES, F.lit(1))
        values = [c for c in source.columns if c not in self.on]
        grouped = source.groupBy(*self.on).agg(
            F.count(F.lit(1)).alias(_COPIES), *(F.first(c).alias(c) for c in values)
        )
        if self.coarse:
            counted = F.col(_COPIES) > 0
            grouped = grouped.withColumns({k: F.when(counted, F.col(k)) for k in self.on})
        return hashed_if_large(grouped) if self.few_keys else grouped

    def _packed(self, rows: DataFrame) -> DataFrame:
        """Rows as they go into the join."""
        if self.ids:
            rows = rows.withColumns({k: packed_id(F.col(k)) for k in self.ids if k in rows.columns})
        return rows if self.partitions is None else rows.repartition(self.partitions, *self.on)

    def _target(self, name: str) -> Column:
        column = F.col(f"t.{name}")
        return unpacked_id(column).alias(name) if name in self.ids else column

    def _joined(self, how: str) -> DataFrame:
        same = reduce(
            lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in self.on]
        )
        return self._packed(self.target).alias("t").join(self._source.alias("s"), same, how)

    @property
    def _matched(self) -> Column:
        copies = F.col(f"s.{_COPIES}")
        if self.unique_source or self.collapse:
            return copies.isNotNull()
        keys = ", ".join(self.on)
        clash = F.raise_error(F.lit(f"merge: several source rows match one target row on {keys}"))
        return F.when(copies > 1, clash).otherwise(copies.isNotNull())

    @property
    def _allowed(self) -> Column:
        return F.lit(True) if self.when is None else F.coalesce(self.when, F.lit(False))

    def _updated(self) -> list[Column]:
        applies = self._matched & self._allowed
        return [
            F.when(applies, self.set_[f.name])
            .otherwise(F.col(f"t.{f.name}"))
            .cast(f.dataType)
            .alias(f.name)
            if f.name in self.set_
            else self._target(f.name)
            for f in self.target.schema
        ]

    def rows(self) -> DataFrame:
        """The whole target after the merge."""
        return self._joined("left").select(*self._updated())

    def traced(self) -> DataFrame:
        """``rows()`` with what a ``WrittenMerge`` needs to tell the other results from them."""
        values = [F.col(f"s.{c}").alias(c) for c in self._asked]
        trace = F.struct(
            F.coalesce(self._matched, F.lit(False)).alias("matched"),
            self._allowed.alias("allowed"),
            F.struct(*(F.col(f"t.{c}").alias(c) for c in self.set_)).alias("previous"),
            F.struct(*values, F.lit(True).alias("_")).alias("asked"),
        )
        return self._joined("left").select(*self._updated(), trace.alias(TRACE))

    @property
    def _asked(self) -> list[str]:
        return [c for c in self.source.columns if c not in self.on]

    def changed(self) -> DataFrame:
        """Target rows whose values differ after the merge, with the values
        before it in ``previous``."""
        before = F.struct(*(F.col(f"t.{c}").alias(c) for c in self.set_)).alias("previous")
        return self._joined("inner").select(*self._updated(), before).where(_differs(self.set_))

    def refused(self) -> DataFrame:
        """Matched target rows that ``when`` kept from changing, with the source
        values that asked for it."""
        values = [F.col(f"s.{c}") for c in self._asked]
        return (
            self._joined("inner")
            .where(self._matched & ~self._allowed)
            .select(*map(self._target, self.target.columns), *values)
        )


def _differs(set_: Mapping[str, Column]) -> Column:
    changes = [~F.col(c).eqNullSafe(F.col(f"previous.{c}")) for c in set_]
    return reduce(lambda a, b: a | b, changes)


@dataclass(frozen=True)
class WrittenMerge:
    """The results of a merge out of its ``traced`` rows as they were written, so that its join runs once."""

    merge: Merge
    written: DataFrame

    @property
    def on(self) -> Sequence[str]:
        return self.merge.on

    @property
    def set_(self) -> Mapping[str, Column]:
        return self.merge.set_

    @property
    def target(self) -> DataFrame:
        return self.merge.target

    @property
    def source(self) -> DataFrame:
        return self.merge.source

    def rows(self) -> DataFrame:
        return self.written.select(*self.target.columns)

    def changed(self) -> DataFrame:
        rows = self.written.where(F.col(f"{TRACE}.matched"))
        previous = F.col(f"{TRACE}.previous").alias("previous")
        return rows.select(*self.target.columns, previous).where(_differs(self.set_))

    def refused(self) -> DataFrame:
        # What was refused is written as it was.
        rows = self.written.where(F.col(f"{TRACE}.matched") & ~F.col(f"{TRACE}.allowed"))
        return rows.select(*self.target.columns, *(F.col(f"{TRACE}.asked.{c}") for c in self.merge._asked))


@dataclass(frozen=True)
class PlacedMerge(Merge):
    """A merge of items by order and row id, whose rows on both sides have their ``item_place`` for an id.

    Equal places of an order are equal ids. Rows are dealt by order, event and blocks of ``PLACES`` positions, so
    that neighbours stay neighbours in the shuffle and a long order is many tasks' work; within
    a block positions are compared pair by pair. The id is made of the place behind the join.
    """

    _DEAL = {
        "_event": "inventory_id.event_id",
        "_items": "inventory_id.item_pos",
        "_packages": "inventory_id.package_pos",
    }

    @property
    def source_keys(self) -> DataFrame:
        return _with_item_ids(self.source.select(*self.on))

    def _dealt(self, rows: DataFrame) -> DataFrame:
        blocks = {
            name: F.col(path) if name == "_event" else F.floor(F.col(path) / PLACES)
            for name, path in self._DEAL.items()
        }
        rows = rows.withColumns(blocks)
        return rows if self.partitions is None else rows.repartition(self.partitions, "order_id", *blocks)

    def _one_row_per_key(self) -> DataFrame:
        source = self._dealt(self.source)
        keys = ["order_id", *self._DEAL, "inventory_id"]
        values = [F.first(c).alias(c) for c in self._asked]
        return source.groupBy(*keys).agg(F.count(F.lit(1)).alias(_COPIES), *values)

    def _joined(self, how: str) -> DataFrame:
        same = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in ("order_id", *self._DEAL)]
        # As differences, so that they are no keys that rows would have to be dealt by.
        same += [
            F.col(f"t.inventory_id.{k}") - F.col(f"s.inventory_id.{k}") == 0
            for k in ("item_pos", "package_pos")
        ]
        target = self._dealt(self.target).alias("t")
        return target.join(self._source.alias("s"), reduce(lambda a, b: a & b, same), how)

    def _target(self, name: str) -> Column:
        if name != "inventory_id":
            return super()._target(name)
        return item_id(F.col("t.order_id"), F.col("t.inventory_id")).alias(name)


@dataclass(frozen=True)
class StoredItemsMerge(Merge):
    """A merge of a stored items table, which has row ids, with placed items.

    Both sides are dealt by order alone, in which rows lie together; ids of the source are made behind that. Orders
    that may have more than ``HOT_SHARE`` of the rows are dealt by their ids too. Run it inside ``dealt_by_some``,
    or Spark deals both sides once more by all keys.
    """

    _hot: tuple[str, ...] | None = field(init=False, repr=False, default=None)

    @property
    def source_keys(self) -> DataFrame:
        return _with_item_ids(self.source.select(*self.on))

    def _one_row_per_key(self) -> DataFrame:
        """Orders that take much are looked for when a result is asked for."""
        return self.source

    def _hot_orders(self) -> tuple[str, ...]:
        if self._hot is None:
            found = ()
            if self.partitions is not None:
                orders = self.target.select("order_id").where("order_id IS NOT NULL")
                found = tuple(orders.stat.freqItems(["order_id"], HOT_SHARE).first()[0])
            object.__setattr__(self, "_hot", found)
        return self._hot

    def _dealt(self, rows: DataFrame, row_id: Column) -> DataFrame:
        hot = self._hot_orders()
        salt = F.when(F.col("order_id").isin(*hot), F.pmod(F.xxhash64(row_id), F.lit(SALTS))) if hot else F.lit(None)
        rows = rows.withColumn("_salt", F.coalesce(salt.cast("bigint"), F.lit(0).cast("bigint")))
        count = () if self.partitions is None else (self.partitions,)
        return rows.repartition(*count, "order_id", "_salt")

    def _joined(self, how: str) -> DataFrame:
        keys = ["order_id", "_salt", "inventory_id"]
        place = F.col("inventory_id")
        source = _with_item_ids(self._dealt(self.source, item_id(F.col("order_id"), place)))
        source = source.withColumn("inventory_id", packed_id(place)).groupBy(*keys)
        source = source.agg(F.count(F.lit(1)).alias(_COPIES), *(F.first(c).alias(c) for c in self._asked))
        target = self.target.withColumn("inventory_id", packed_id(place))
        target = self._dealt(target, unpacked_id(place)).alias("t")
        same = reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])
        return target.join(source.alias("s"), same, how)


def _with_item_ids(rows: DataFrame) -> DataFrame:
    return rows.withColumn("inventory_id", item_id(F.col("order_id"), F.col("inventory_id")))


@contextmanager
def dealt_by_some(spark: SparkSession) -> Iterator[None]:
    """Joins run inside take sides that are dealt by some of their keys as they are."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def stock_merge(packages: DataFrame, demand: DataFrame) -> Merge:
    """Take the demand of one batch from stock, all or nothing per package.

    One batch is one decision: a package whose summed demand exceeds its stock
    keeps its stock and shows up in ``refused()``.
    """
    stock, wanted = F.col("t.stock_quantity"), F.col("s.items_quantity")
    return Merge(
        packages,
        demand,
        PACKAGE_KEYS,
        {"stock_quantity": stock - wanted},
        when=stock >= wanted,
        unique_source=True,
    )


def product_stock_merge(products: DataFrame, demand: DataFrame) -> Merge:
    """Older decrement per product: unconditional, stock may go below zero."""
    return Merge(
        products,
        demand,
        ["product_id"],
        {"quantity": F.col("t.quantity") - F.col("s.quantity")},
        unique_source=True,
    )


def processing_merge(
    target: DataFrame, source: DataFrame, on: Sequence[str], restamp=None, **options
) -> Merge:
    """Set the matched rows to PROCESSING. ``restamp`` also sets their order
    time (True for now, or a fixed time); by default it stays."""
    kind = options.pop("kind", Merge)
    set_ = {"status": F.lit(PROCESSING)}
    if restamp is not None and restamp is not False:
        set_["order_timestamp"] = now(None if restamp is True else restamp)
    return kind(target, source.select(*on), on, set_, **options)


def items_merge(items: DataFrame, batch: DataFrame, restamp=None, partitions: int | None = None) -> Merge:
    """Items with their ids, or placed ones: the batch alone, or both."""

    def placed(rows: DataFrame) -> bool:
        return isinstance(rows.schema["inventory_id"].dataType, StructType)

    if placed(items) and not placed(batch):
        raise ValueError("placed items are merged with placed items")
    kind = PlacedMerge if placed(items) else StoredItemsMerge if placed(batch) else Merge
    on = ["order_id", "inventory_id"]
    return processing_merge(items, batch, on, restamp, ids=["inventory_id"], partitions=partitions, kind=kind)


def orders_merge(orders: DataFrame, batch: DataFrame, restamp=None) -> Merge:
    """Several rows of one order in the batch count once."""
    return processing_merge(orders, batch, ["order_id"], restamp, collapse=True, coarse=True)


def items_by_product_merge(items: DataFrame, batch: DataFrame, restamp=None) -> Merge:
    """Older form: touches the rows of every order that hold the product."""
    return processing_merge(
        items, batch, ["product_id"], restamp, ids=["inventory_id"], collapse=True, coarse=True, few_keys=True
    )


def order_review_merge(orders: DataFrame, batch: DataFrame, at=None) -> Merge:
    """PROCESSING when the batch brings more items than the order has, else
    CANCELLED; the order date moves to five minutes from now."""
    more = F.col("s.items") > F.col("t.items")
    return Merge(
        orders,
        batch,
        ["order_id"],
        {
            "status": F.when(more, F.lit(PROCESSING)).otherwise(F.lit(CANCELLED)),
            "order_date": now(at) + F.expr("INTERVAL 5 MINUTES"),
        },
        coarse=True,
    )
