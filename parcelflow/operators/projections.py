"""Envelope to flat tables: events, orders, order items and the review view."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import prefixed_hash
from parcelflow.schemas import EVENTS, ORDERS, PENDING

# Output column -> field of the envelope.
ORDER_FIELDS_V1 = {
    "order_id": "order_id",
    "customer_id": "order_details.customer_id",
    "total_weight": "order_details.total_weight",
    "total_price": "order_details.total_amount",
    "order_timestamp": "order_details.order_timestamp",
    "status": "order_details.status",
    "lat": "order_details.destination_address.lat",
    "lon": "order_details.destination_address.lon",
}
_WITH_VOLUME = ORDER_FIELDS_V1 | {"total_volume": "order_details.total_volume"}
ORDER_FIELDS = {name: _WITH_VOLUME[name] for name in ORDERS.names}


def pick(df: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Project nested paths under new names."""
    return df.select([F.col(path).alias(name) for name, path in fields.items()])


def order_events(envelopes: DataFrame) -> DataFrame:
    return envelopes.select(*EVENTS.names)


def flat_orders(envelopes: DataFrame) -> DataFrame:
    return pick(envelopes, ORDER_FIELDS)


def flat_orders_v1(envelopes: DataFrame, with_date: bool = False) -> DataFrame:
    """Older order row, without volume; ``with_date`` gives the date of the
    order in place of its timestamp."""
    fields = dict(ORDER_FIELDS_V1)
    if with_date:
        del fields["order_timestamp"]
        fields["order_date"] = "order_details.order_date"
    return pick(envelopes, fields)


def _items(envelopes: DataFrame, carried: Mapping[str, str]) -> DataFrame:
    """One row per item with its position; an order without items gives none.

    The fields that the result carries are taken out before the expansion:
    left inside their struct, the whole struct would be read and copied.
    """
    if envelopes is None or not envelopes.columns:
        raise ValueError("order envelopes have no columns")
    flat = pick(envelopes, {**carried, "items": "order_details.items"})
    return flat.select(*carried, F.posexplode("items").alias("item_pos", "item"))


def _packages(items: DataFrame) -> DataFrame:
    """One row per package of an item, with its position."""
    return items.select("*", F.posexplode("item.packages").alias("package_pos", "package"))


_ITEM_CONTEXT = {
    "event_id": "event_id",
    "order_id": "order_id",
    "order_timestamp": "order_details.order_timestamp",
}


_POSITIONS = ("item_pos", "package_pos")
_POSITIONS_V1 = ("item_pos",)


def item_place(positions: Sequence[str] = _POSITIONS) -> Column:
    """What the row id of an item hashes beside its order. Rows go through shuffles and state with this
    in place of the id: neighbours have it nearly in common, where digests share nothing."""
    event = F.coalesce(F.col("event_id"), F.lit(""))
    return F.struct(event.alias("event_id"), *positions)


def item_id(order_id: Column, place: Column, positions: Sequence[str] = _POSITIONS) -> Column:
    """The row id of an item by its order and place. Of two items of an order, ids differ as places do."""
    return prefixed_hash("inv-", place["event_id"], order_id, *(place[c] for c in positions))


def item_id_v1(order_id: Column, place: Column) -> Column:
    return item_id(order_id, place, _POSITIONS_V1)


def item_rows(envelopes: DataFrame, placed: bool = False) -> DataFrame:
    """Order items: one row per package of every item of every order.

    ``order_price`` is the price of the item and repeats on each of its
    packages; never sum it over these rows. The row id hashes the event, the
    order and the two positions, so that each query over the same envelopes
    sees the same ids. ``placed`` rows have their ``item_place`` there, for
    operators that make the id of it behind a shuffle.
    """
    rows = _packages(_items(envelopes, _ITEM_CONTEXT))
    units = _units()
    place = item_place()
    return rows.select(
        (place if placed else item_id(F.col("order_id"), place)).alias("inventory_id"),
        "order_id",
        "item.product_id",
        "item.product_name",
        F.col("item.price").alias("order_price"),
        "package.package_id",
        "package.subpackage_id",
        units.alias("items_quantity"),
        (units * F.col("package.weight")).alias("items_weight"),
        (units * F.col("package.volume")).alias("items_volume"),
        "order_timestamp",
        F.lit(PENDING).alias("status"),
    )


def _units() -> Column:
    return F.col("item.quantity").cast("bigint") * F.col("package.quantity").cast("bigint")


def item_quantities(envelopes: DataFrame, *carried: str) -> DataFrame:
    """The part of the order items that stock needs, with top-level fields that are
    ``carried``. Works on envelopes read with ``schemas.DEMAND_FIELDS`` and these
    alone, a fraction of their columns."""
    return _packages(_items(envelopes, {c: c for c in carried})).select(
        *carried,
        "package.package_id",
        "package.subpackage_id",
        _units().alias("items_quantity"),
        F.lit(PENDING).alias("status"),
    )


def item_rows_v1(envelopes: DataFrame, placed: bool = False) -> DataFrame:
    """Older order items: one row per item, no packages. ``placed`` as in ``item_rows``."""
    place = item_place(_POSITIONS_V1)
    return _items(envelopes, _ITEM_CONTEXT).select(
        (place if placed else item_id_v1(F.col("order_id"), place)).alias("inventory_id"),
        "order_id",
        "item.product_id",
        "item.product_name",
        F.col("item.quantity").cast("bigint").alias("quantity"),
        "item.price",
        "item.weight",
        "order_timestamp",
        F.lit(PENDING).alias("status"),
    )


def item_review(
    envelopes: DataFrame, package_id: str | None = None, order_id: str | None = None
) -> DataFrame:
    """Order totals beside unit and ordered quantities, for all orders or for
    one package and/or order."""
    if order_id is not None:
        envelopes = envelopes.where(F.col("order_id") == order_id)
    carried = {
        "order_id": "order_id",
        "order_total_weight": "order_details.total_weight",
        "order_timestamp": "order_details.order_timestamp",
        "status": "order_details.status",
    }
    if package_id is not None:
        # Orders without the package are not expanded at all.
        envelopes = envelopes.where(
            F.exists(
                "order_details.items",
                lambda i: F.exists(i["packages"], lambda p: p["package_id"] == package_id),
            )
        )
    rows = _packages(_items(envelopes, carried))
    if package_id is not None:
        rows = rows.where(F.col("package.package_id") == package_id)
    return rows.select(
        "order_id",
        "order_total_weight",
        "item.product_id",
        "item.product_name",
        F.col("item.price").alias("order_price"),
        "package.package_id",
        "package.subpackage_id",
        F.col("package.weight").alias("package_weight"),
        F.col("package.volume").alias("package_volume"),
        F.col("item.quantity").alias("order_quantity"),
        F.col("package.quantity").alias("package_quantity"),
        "order_timestamp",
        "status",
    )
