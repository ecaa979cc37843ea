"""The queries of this repository over the given tables, by name.

Each takes (spark, sf_dir) and returns a DataFrame. All work on whole tables:
the order envelopes are built from the base tables, written once per session
and set of tables as the landing table, and read from there.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from datetime import timedelta
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from parcelflow.operators import joins, routing, tables
from parcelflow.operators.feed import ChangeFeed
from parcelflow.operators.merge import (
    Merge,
    items_by_product_merge,
    items_merge,
    order_review_merge,
    orders_merge,
    product_stock_merge,
    stock_merge,
)
from parcelflow.operators.projections import (
    flat_orders,
    flat_orders_v1,
    item_id,
    item_quantities,
    item_review,
    item_rows,
    item_rows_v1,
    order_events,
)
from parcelflow.operators.status import processing_events, status_changes, status_event_stream
from parcelflow.plans.order_flow import OrderTables, run_order_flow, shortages
from parcelflow.schemas import (
    DEMAND_FIELDS,
    ENVELOPE,
    ENVELOPE_V1,
    EVENTS,
    INTERRUPTED,
    ORDER_ITEMS,
    ORDER_PART,
    ORDER_PART_V1,
    ORDERS,
    PACKAGES,
    PENDING,
    PROCESSING,
    PRODUCTS,
    RAW_RECORD,
    RECEIVED,
)
from parcelflow.sources import readers
from parcelflow.sources.landing import base_table, landing, shared_folder
from parcelflow.sources.snapshots import COMPRESSION, SnapshotTable, key_slices
from parcelflow.sources.writers import save, save_for_lookup
from parcelflow.streaming import (
    append_files,
    append_updates,
    finish,
    first_arrivals,
    large_state,
    latest_result,
    latest_updates,
    replace_result,
    run_together,
    running_totals,
    skip_present,
    status_transitions,
    to_function,
    to_table,
)

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the registered queries.
PROCESSED_AT = "2030-01-01 00:00:00"
BOUND = "1998-06-30 00:00:00"
LOOKUP_PACKAGE = "pkg-1"
WITHIN = timedelta(minutes=30)
LATENESS = ("60 seconds", "150 seconds")
# The one stock count of the tables, and the time of processing, are years later than the orders.
STOCK_WITHIN = timedelta(days=3653)
STOCK_LATENESS = ("1 day", "1 day")
BYTES_PER_BATCH = 1 << 40
# How long envelopes and statuses are remembered, and the partitions of routed messages.
REMEMBERED = "7 days"
PARTITIONS = 8

_QUERIES: dict[str, Query] = {}


def _plain_times(df: DataFrame) -> DataFrame:
    """Times without zone, as the given tables have them, and dates as text."""
    plain = {"timestamp": "timestamp_ntz", "date": "string"}
    kinds = {f.name: plain.get(f.dataType.typeName()) for f in df.schema}
    return df.withColumns({c: F.col(c).cast(kind) for c, kind in kinds.items() if kind})


def _query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return _plain_times(fn(spark, sf_dir))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    _QUERIES[fn.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _fixed_time():
    return F.lit(PROCESSED_AT).cast("timestamp")


def _quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return item_quantities(landing(spark, sf_dir).envelopes(DEMAND_FIELDS))


def _order_number() -> Column:
    return F.substring("order_id", 5, 20).cast("bigint")


def _is_earlier() -> Column:
    return _order_number() % 2 == 0


def _earlier_status() -> Column:
    statuses = F.array(*map(F.lit, (PENDING, PROCESSING, INTERRUPTED)))
    return F.element_at(statuses, (_order_number() % 3 + 1).cast("int"))


def _earlier(envelopes: DataFrame, project: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Items written before the batch: those of every second order under an older
    event, with mixed statuses. One product in five has left the range since."""
    product = F.substring("product_id", 5, 20).cast("bigint")
    older = envelopes.withColumn("event_id", F.concat(F.lit("old-"), "event_id"))
    return project(older.where(_is_earlier())).withColumns(
        {
            "status": _earlier_status(),
            "product_id": F.when(
                product % 5 == 0, F.concat(F.lit("ret-"), product.cast("string"))
            ).otherwise(F.col("product_id")),
        }
    )


def _stored_quantities(spark, sf_dir) -> DataFrame:
    """What stock needs of the items table, from narrow reads."""
    schema = StructType([StructField("order_id", StringType()), *DEMAND_FIELDS])
    older = landing(spark, sf_dir).envelopes(schema).where(_is_earlier())
    rows = item_quantities(older, "order_id").withColumn("status", _earlier_status())
    return _quantities(spark, sf_dir).unionByName(rows.drop("order_id"))


def _stored(envelopes: DataFrame, project: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The items table that a batch meets: its own new rows and earlier ones."""
    return project(envelopes).unionByName(_earlier(envelopes, project))


# -- reading and decoding ---------------------------------------------------


@_query
def ingest_json(spark, sf_dir):
    envelopes = readers.read_json(spark, landing(spark, sf_dir).path("json")).rows
    return envelopes.select(
        "event_id",
        "event_type",
        "event_timestamp",
        "order_id",
        F.col("order_details.customer_id").alias("customer_id"),
        F.col("order_details.order_date").alias("order_date"),
        F.coalesce(F.array_size("order_details.items"), F.lit(0)).alias("n_items"),
        F.col("order_details.payment_details.transaction_id").alias("transaction_id"),
    )


@_query
def decode_envelope(spark, sf_dir):
    return flat_orders(readers.decode(landing(spark, sf_dir).raw(), ORDER_PART).rows)


@_query
def decode_base64(spark, sf_dir):
    return item_rows(readers.decode_base64(landing(spark, sf_dir).raw_base64()).rows)


@_query
def decode_rejected(spark, sf_dir):
    """Documents sent to the order feed by mistake: none of them decodes."""
    strays = base_table(spark, sf_dir, "documents").select(F.col("text").cast("binary").alias("data"))
    feed = landing(spark, sf_dir).raw().unionByName(strays)
    return readers.decode(feed).rejected.select(F.col("data").cast("string").alias("text"))


# -- projections ------------------------------------------------------------


@_query
def events_project(spark, sf_dir):
    return order_events(landing(spark, sf_dir).envelopes())


@_query
def orders_flatten(spark, sf_dir):
    return flat_orders(landing(spark, sf_dir).envelopes())


@_query
def orders_flatten_v1(spark, sf_dir):
    return flat_orders_v1(landing(spark, sf_dir).envelopes_v1())


@_query
def orders_flatten_v1_date(spark, sf_dir):
    return flat_orders_v1(landing(spark, sf_dir).envelopes_v1(), with_date=True)


@_query
def items_explode(spark, sf_dir):
    return item_rows(landing(spark, sf_dir).envelopes())


@_query
def items_explode_v1(spark, sf_dir):
    return item_rows_v1(landing(spark, sf_dir).envelopes_v1())


@_query
def items_measures(spark, sf_dir):
    return (
        item_rows(landing(spark, sf_dir).envelopes())
        .groupBy("product_id")
        .agg(*(F.sum(c).alias(c) for c in ("items_quantity", "items_weight", "items_volume")))
    )


@_query
def deterministic_ids(spark, sf_dir):
    return item_rows(landing(spark, sf_dir).envelopes()).select(
        "inventory_id", "order_id", "package_id", "subpackage_id"
    )


@_query
def item_review_all(spark, sf_dir):
    return item_review(landing(spark, sf_dir).envelopes())


@_query
def item_review_lookup(spark, sf_dir):
    return item_review(landing(spark, sf_dir).envelopes(), package_id=LOOKUP_PACKAGE)


def _first_order(spark, sf_dir) -> str:
    """The first order that has the package."""
    holds = F.concat(F.lit("pkg-"), F.col("l_partkey")) == LOOKUP_PACKAGE
    lines = base_table(spark, sf_dir, "lineitem").where(holds)
    return f"ord-{lines.agg(F.min('l_orderkey')).first()[0]}"


@_query
def item_review_order(spark, sf_dir):
    """One package in one order: the first order that has it."""
    order = _first_order(spark, sf_dir)
    return item_review(landing(spark, sf_dir).envelopes(), package_id=LOOKUP_PACKAGE, order_id=order)


@_query
def item_review_indexed(spark, sf_dir):
    """The whole first order that has the package, from envelopes written for lookups by order."""
    path = f"{shared_folder(spark)}/envelopes"
    save_for_lookup(landing(spark, sf_dir).envelopes(), path, "order_id")
    rows = readers.read_files(spark, path, schema=ENVELOPE)
    return item_review(rows, order_id=_first_order(spark, sf_dir))


# -- batch writes -----------------------------------------------------------


@_query
def batch_append(spark, sf_dir):
    """Events of the pending orders, then of all others, appended to one table."""
    path = f"{shared_folder(spark)}/events"
    for part in _halves(spark, sf_dir):
        save(order_events(part), path)
    return readers.read_files(spark, path, schema=EVENTS)


def _halves(spark, sf_dir) -> list[DataFrame]:
    """The envelopes of the pending orders and those of all others."""
    envelopes = landing(spark, sf_dir).envelopes()
    pending = F.col("order_details.status").eqNullSafe(PENDING)
    return [envelopes.where(pending), envelopes.where(~pending)]


@_query
def batch_overwrite(spark, sf_dir):
    """Events of the pending orders, then those of all others in their place."""
    path = f"{shared_folder(spark)}/events"
    for part in _halves(spark, sf_dir):
        save(order_events(part), path, mode="overwrite")
    return readers.read_files(spark, path, schema=EVENTS)


@_query
def delete_all(spark, sf_dir):
    """All events go; those of the pending orders are appended again."""
    events = SnapshotTable(spark, f"{shared_folder(spark)}/events", EVENTS)
    pending, others = _halves(spark, sf_dir)
    events.append(order_events(others), "load", 0)
    events.append(order_events(pending), "load", 1)
    events.delete_all()
    events.append(order_events(pending), "load", 2)
    return events.read()


# -- filters, aggregates, orderings -----------------------------------------


@_query
def filter_pending(spark, sf_dir):
    return tables.with_status(flat_orders(landing(spark, sf_dir).envelopes()), PENDING)


@_query
def filter_received(spark, sf_dir):
    return tables.with_status(flat_orders(landing(spark, sf_dir).envelopes()), RECEIVED)


@_query
def filter_upto(spark, sf_dir):
    events = order_events(landing(spark, sf_dir).envelopes())
    return tables.up_to(events, "event_timestamp", F.lit(BOUND).cast("timestamp"))


@_query
def count_unprocessed(spark, sf_dir):
    orders = flat_orders(landing(spark, sf_dir).envelopes())
    return tables.row_count(tables.not_processing(orders))


@_query
def package_demand(spark, sf_dir):
    """Demand of the pending items of the whole items table."""
    return tables.package_demand(_stored_quantities(spark, sf_dir))


@_query
def package_demand_all(spark, sf_dir):
    """Demand without the status filter."""
    return tables.package_demand(_stored_quantities(spark, sf_dir), status=None)


@_query
def threshold_totals(spark, sf_dir):
    return tables.threshold_totals(_processed_items_v1(spark, sf_dir))


@_query
def threshold_by_order(spark, sf_dir):
    return tables.threshold_totals(_processed_items_v1(spark, sf_dir), by="order_id")


def _processed_items_v1(spark, sf_dir) -> DataFrame:
    return _items_by_product(spark, sf_dir).rows()


@_query
def total_order_weight(spark, sf_dir):
    return tables.total_order_weight(landing(spark, sf_dir).envelopes())


@_query
def max_timestamp(spark, sf_dir):
    return tables.max_timestamp(order_events(landing(spark, sf_dir).envelopes()), "event_timestamp")


@_query
def distinct_packages(spark, sf_dir):
    return tables.distinct_count(_quantities(spark, sf_dir), *tables.PACKAGE_KEYS)


@_query
def distinct_status(spark, sf_dir):
    return tables.distinct_values(flat_orders(landing(spark, sf_dir).envelopes()), "status")


@_query
def orders_to_process(spark, sf_dir):
    """What is still pending after the batch was merged."""
    return tables.orders_to_process(_items(spark, sf_dir).rows())


@_query
def latest_events(spark, sf_dir):
    events = order_events(landing(spark, sf_dir).envelopes())
    return tables.latest_first(events, "event_timestamp", "event_id")


@_query
def topk_items(spark, sf_dir):
    items = item_rows(landing(spark, sf_dir).envelopes())
    return tables.latest_first(items, "order_timestamp", "inventory_id", limit=25)


@_query
def stock_rank(spark, sf_dir):
    return tables.by_stock(landing(spark, sf_dir).packages())


@_query
def stock_rank_desc(spark, sf_dir):
    return tables.by_stock(landing(spark, sf_dir).packages(), ascending=False)


# -- joins ------------------------------------------------------------------


@_query
def stock_outcome(spark, sf_dir):
    items = item_rows_v1(landing(spark, sf_dir).envelopes_v1())
    return _shown(joins.stock_outcome(items, landing(spark, sf_dir).products()))


def _shown(outcome: DataFrame) -> DataFrame:
    """Quantities that can be null are shown as doubles, which every reader has nulls for."""
    return outcome.withColumn("quantity_updated", F.col("quantity_updated").cast("double"))


@_query
def outcome_message(spark, sf_dir):
    items = item_rows_v1(landing(spark, sf_dir).envelopes_v1())
    return joins.outcome_messages(items, landing(spark, sf_dir).products())


@_query
def message_payload(spark, sf_dir):
    """Item messages, their JSON read back field by field."""
    items = item_rows_v1(landing(spark, sf_dir).envelopes_v1())
    sent = joins.item_messages(items, landing(spark, sf_dir).products())
    fields = """inventory_id string, order_id string, product_id string, product_name string,
      order_quantity bigint, price double, weight double, order_timestamp timestamp,
      status string, stock_quantity double, availability string"""
    return sent.select("partitionKey", F.from_json("data", fields).alias("m")).select(
        "partitionKey", "m.*"
    )


@_query
def join_using(spark, sf_dir):
    items = item_rows_v1(landing(spark, sf_dir).envelopes_v1())
    stock = landing(spark, sf_dir).products().withColumnRenamed("quantity", "stock_quantity")
    return joins.join_using(items, stock)


def _event_pairs(joined: DataFrame) -> DataFrame:
    return joined.select(
        F.col("l.event_id").alias("click_id"),
        F.col("l.user_id").alias("user_id"),
        F.col("l.ts").alias("clicked_at"),
        F.col("r.event_id").alias("purchase_id"),
        F.col("r.ts").alias("purchased_at"),
    )


def _of_type(events: DataFrame, kind: str) -> DataFrame:
    return events.where(F.col("event_type") == kind).select("event_id", "user_id", "ts")


@_query
def interval_join(spark, sf_dir):
    events = base_table(spark, sf_dir, "events")
    return _event_pairs(
        joins.interval_join(
            _of_type(events, "click"),
            _of_type(events, "purchase"),
            on=[("user_id", "user_id")],
            times=("ts", "ts"),
            within=WITHIN,
        )
    )


# -- merges -----------------------------------------------------------------


def _stock(spark, sf_dir) -> Merge:
    demand = tables.package_demand(_quantities(spark, sf_dir))
    return stock_merge(landing(spark, sf_dir).packages(), demand)


def _items(spark, sf_dir, restamp=None) -> Merge:
    """The items table, merged with the pending items of the batch."""
    envelopes = landing(spark, sf_dir).envelopes()
    placed = partial(item_rows, placed=True)
    batch = tables.with_status(placed(envelopes), PENDING)
    pieces = landing(spark, sf_dir).partitions("envelopes")
    return items_merge(_stored(envelopes, placed), batch, restamp, pieces)


def _orders(spark, sf_dir, restamp=None) -> Merge:
    orders = flat_orders(landing(spark, sf_dir).envelopes())
    return orders_merge(orders, tables.with_status(orders, RECEIVED), restamp)


def _items_by_product(spark, sf_dir, restamp=None) -> Merge:
    """The older items table, merged with the pending items of the batch."""
    envelopes = landing(spark, sf_dir).envelopes_v1()
    batch = tables.with_status(item_rows_v1(envelopes), PENDING)
    return items_by_product_merge(_stored(envelopes, item_rows_v1), batch, restamp)


@_query
def stock_decrement(spark, sf_dir):
    return _stock(spark, sf_dir).rows()


@_query
def stock_shortage(spark, sf_dir):
    return shortages(landing(spark, sf_dir).packages(), _quantities(spark, sf_dir))


@_query
def product_decrement(spark, sf_dir):
    land = landing(spark, sf_dir)
    demand = tables.product_demand(item_rows_v1(land.envelopes_v1()))
    return product_stock_merge(land.products(), demand).rows()


@_query
def items_to_processing(spark, sf_dir):
    return _items(spark, sf_dir).rows()


@_query
def items_to_processing_restamped(spark, sf_dir):
    return _items(spark, sf_dir, restamp=_fixed_time()).rows()


@_query
def orders_to_processing(spark, sf_dir):
    return _orders(spark, sf_dir).rows()


@_query
def orders_to_processing_v1(spark, sf_dir):
    """Older form: the orders that have pending items, stamped anew."""
    land = landing(spark, sf_dir)
    pending = tables.orders_to_process(item_rows_v1(land.envelopes_v1()))
    orders = flat_orders_v1(land.envelopes_v1())
    return orders_merge(orders, pending, restamp=_fixed_time()).rows()


@_query
def items_by_product(spark, sf_dir):
    return _items_by_product(spark, sf_dir, restamp=_fixed_time()).rows()


@_query
def merge_case(spark, sf_dir):
    envelopes = landing(spark, sf_dir).envelopes()
    orders = envelopes.select(
        "order_id",
        (F.coalesce(F.array_size("order_details.items"), F.lit(0)).cast("bigint") * 2).alias(
            "items"
        ),
        F.col("order_details.status").alias("status"),
        F.col("order_details.order_timestamp").alias("order_date"),
    )
    packed = item_rows(envelopes).groupBy("order_id").agg(F.count(F.lit(1)).alias("items"))
    return order_review_merge(orders, packed, at=_fixed_time()).rows()


@_query
def status_change_rows(spark, sf_dir):
    return status_changes(_items(spark, sf_dir))


@_query
def events_from_status(spark, sf_dir):
    return processing_events(_orders(spark, sf_dir).changed(), at=_fixed_time())


# -- streams ----------------------------------------------------------------


def _envelope_stream(spark, sf_dir, schema=ENVELOPE, **options) -> DataFrame:
    path = landing(spark, sf_dir).path("envelopes")
    return readers.stream_files(spark, path, schema, **options)


def _appended(spark, sf_dir) -> DataFrame:
    """The envelope stream for queries that only append: any cut into batches
    gives the same rows, so a batch is held to what a cluster redoes at ease."""
    return _envelope_stream(spark, sf_dir, bytes_per_batch=BYTES_PER_BATCH)


def _through_files(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """Run the stream into a fresh folder and read what it wrote."""
    root = shared_folder(spark)
    finish(append_files(stream, f"{root}/rows", f"{root}/checkpoint"))
    return spark.read.schema(stream.schema).parquet(f"{root}/rows")


@_query
def stream_ingest(spark, sf_dir):
    records = readers.stream_files(spark, landing(spark, sf_dir).path("raw"), RAW_RECORD)
    return _through_files(spark, flat_orders(readers.decode(records, ORDER_PART).rows))


@_query
def stream_table_read(spark, sf_dir):
    stream = tables.up_to(
        order_events(_appended(spark, sf_dir)),
        "event_timestamp",
        F.lit(BOUND).cast("timestamp"),
    )
    return _through_files(spark, stream)


@_query
def stream_named_table(spark, sf_dir):
    """Events streamed into a named table, which is then read by its name."""
    name = f"events_{uuid.uuid4().hex}"
    stream = order_events(_appended(spark, sf_dir))
    finish(to_table(stream, name, f"{shared_folder(spark)}/checkpoint"))
    return readers.read_table(spark, name)


@_query
def stream_resume(spark, sf_dir):
    """Two runs on one checkpoint; files come in between. Every event once."""
    root = shared_folder(spark)
    for part in _halves(spark, sf_dir):
        part.write.mode("append").parquet(f"{root}/landing", compression=COMPRESSION)
        stream = order_events(readers.stream_files(spark, f"{root}/landing", ENVELOPE))
        finish(append_files(stream, f"{root}/rows", f"{root}/checkpoint"))
    return readers.read_files(spark, f"{root}/rows", schema=EVENTS)


@_query
def stream_append_events(spark, sf_dir):
    return _through_files(spark, order_events(_appended(spark, sf_dir)))


@_query
def stream_append_orders(spark, sf_dir):
    return _through_files(spark, flat_orders(_appended(spark, sf_dir)))


@_query
def stream_status_events(spark, sf_dir):
    """Events of the orders that arrive in processing, appended to the events."""
    orders = flat_orders(_appended(spark, sf_dir))
    return _through_files(spark, status_event_stream(orders, at=_fixed_time()))


@_query
def stream_append_items(spark, sf_dir):
    return _through_files(spark, item_rows(_appended(spark, sf_dir)))


@_query
def stream_messages(spark, sf_dir):
    """Keyed messages of the item stream, written to a file sink."""
    items = item_rows(_appended(spark, sf_dir))
    sent = joins.keyed_messages(items, "inventory_id", "inventory_id", "order_id", "items_quantity")
    return _through_files(spark, sent)


def _items_merge(spark, sf_dir) -> Callable[[DataFrame, DataFrame], Merge]:
    """The merge of items with a batch of all envelopes."""
    return partial(items_merge, partitions=landing(spark, sf_dir).partitions("envelopes"))


def _merge_stream(stream: DataFrame, table: SnapshotTable, build, prepare, root: str) -> DataFrame:
    def on_batch(rows: DataFrame, batch: int) -> None:
        table.merge(build, prepare(rows), "stream", batch)

    finish(to_function(stream, on_batch, f"{root}/checkpoint"))
    return table.read()


@_query
def stream_stock_decrement(spark, sf_dir):
    root = shared_folder(spark)
    stock = SnapshotTable(
        spark, f"{root}/package_table", PACKAGES, key_slices(16, *tables.PACKAGE_KEYS)
    )
    stock.replace(landing(spark, sf_dir).packages())
    items = item_quantities(_envelope_stream(spark, sf_dir, DEMAND_FIELDS))
    return _merge_stream(items, stock, stock_merge, tables.package_demand, root)


@_query
def stream_items_to_processing(spark, sf_dir):
    root = shared_folder(spark)
    items = SnapshotTable(spark, f"{root}/orders_items", ORDER_ITEMS)
    items.append(_stored(landing(spark, sf_dir).envelopes(), item_rows), "load", 0)
    stream = item_rows(_envelope_stream(spark, sf_dir), placed=True)

    def pending(rows: DataFrame) -> DataFrame:
        return tables.with_status(rows, PENDING).select("order_id", "inventory_id")

    return _merge_stream(stream, items, _items_merge(spark, sf_dir), pending, root)


@_query
def stream_orders_to_processing(spark, sf_dir):
    root = shared_folder(spark)
    orders = SnapshotTable(spark, f"{root}/orders", ORDERS)
    orders.append(flat_orders(landing(spark, sf_dir).envelopes()), "load", 0)
    stream = flat_orders(_envelope_stream(spark, sf_dir))

    def received(rows: DataFrame) -> DataFrame:
        return tables.with_status(rows, RECEIVED).select("order_id")

    return _merge_stream(stream, orders, orders_merge, received, root)


@_query
def stream_interval_join(spark, sf_dir):
    """Left outer join of two streams. A click without purchase comes out once
    the watermark has passed its interval, so the newest ones are still open."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema

    def stream(kind: str) -> DataFrame:
        events = readers.stream_files(spark, sf_dir, schema, name_pattern="events.parquet")
        return _of_type(events.withColumn("ts", F.col("ts").cast("timestamp")), kind)

    joined = joins.interval_join(
        stream("click"),
        stream("purchase"),
        on=[("user_id", "user_id")],
        times=("ts", "ts"),
        within=WITHIN,
        lateness=LATENESS,
    )
    with large_state(spark, counted=False):
        return _through_files(spark, _event_pairs(joined))


@_query
def stream_inner_join(spark, sf_dir):
    envelopes = readers.stream_files(
        spark, landing(spark, sf_dir).path("envelopes_v1"), ENVELOPE_V1
    )
    items = item_rows_v1(envelopes, placed=True)
    products = readers.stream_files(spark, landing(spark, sf_dir).path("products"), PRODUCTS)
    with large_state(spark, counted=False):
        outcome = joins.stock_outcome(
            items, products, "inner", salts=8, within=STOCK_WITHIN, lateness=STOCK_LATENESS
        )
        return _through_files(spark, _shown(outcome))


# -- the whole flow ---------------------------------------------------------

_flows: dict[tuple[str, str], OrderTables] = {}
_flow_lock = threading.Lock()


def _flow(spark: SparkSession, sf_dir: str) -> OrderTables:
    """The tables after one run over all envelopes, once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _flow_lock:
        if key not in _flows:
            _flows[key] = _run_flow(spark, sf_dir)
    return _flows[key]


def _run_flow(spark: SparkSession, sf_dir: str) -> OrderTables:
    root = shared_folder(spark)
    out = OrderTables.at(spark, root, package_slices=16)
    out.packages.replace(landing(spark, sf_dir).packages())
    stream = _envelope_stream(spark, sf_dir)
    finish(run_order_flow(stream, out, f"{root}/checkpoint", app="orders", at=_fixed_time()))
    return out


@_query
def flow_events(spark, sf_dir):
    return _flow(spark, sf_dir).events.read()


@_query
def flow_orders(spark, sf_dir):
    return _flow(spark, sf_dir).orders.read()


@_query
def flow_items(spark, sf_dir):
    return _flow(spark, sf_dir).items.read()


@_query
def flow_stock(spark, sf_dir):
    return _flow(spark, sf_dir).packages.read()


@_query
def flow_shortage(spark, sf_dir):
    return _flow(spark, sf_dir).shortages.read()


@_query
def stream_status_changes(spark, sf_dir):
    """The orders that the flow has moved on, followed as a stream."""
    changes = _flow(spark, sf_dir).changes
    stream = readers.stream_files(spark, changes.stream_path(), changes.schema)
    return _through_files(spark, stream)


# -- streams with memory ----------------------------------------------------


def _repeated(spark, sf_dir, part: int) -> DataFrame:
    """Two deliveries of the envelopes: half of the orders each, and in the second a third of the first again;
    a third of each comes twice at once."""
    envelopes = landing(spark, sf_dir).envelopes()
    half, third = _order_number() % 2, _order_number() % 3 == 0
    own = envelopes.where(half == part)
    sent = own.unionAll(own.where(third))
    return sent if part == 0 else sent.unionAll(envelopes.where((half == 0) & (_order_number() % 3 == 1)))


def _two_deliveries(spark, sf_dir, root: str, run: Callable[[DataFrame], None]) -> None:
    for part in (0, 1):
        _repeated(spark, sf_dir, part).write.mode("append").parquet(f"{root}/landing", compression=COMPRESSION)
        with large_state(spark, counted=False):
            run(readers.stream_files(spark, f"{root}/landing", ENVELOPE))


@_query
def stream_dedup(spark, sf_dir):
    """Events of a feed that repeats envelopes within a delivery and across two: every event once."""
    root = shared_folder(spark)

    def run(stream: DataFrame) -> None:
        once = first_arrivals(stream, F.col("event_id"), REMEMBERED)
        finish(append_files(order_events(once), f"{root}/rows", f"{root}/checkpoint"))

    _two_deliveries(spark, sf_dir, root, run)
    return readers.read_files(spark, f"{root}/rows", schema=EVENTS)


@_query
def flow_items_once(spark, sf_dir):
    """Items that the whole flow makes of the same repeating feed."""
    root = shared_folder(spark)
    out = OrderTables.at(spark, root, package_slices=16)
    out.packages.replace(landing(spark, sf_dir).packages())

    def run(stream: DataFrame) -> None:
        flow = run_order_flow(
            stream, out, f"{root}/checkpoint", app="orders", at=_fixed_time(), once_within=REMEMBERED
        )
        finish(flow)

    _two_deliveries(spark, sf_dir, root, run)
    return out.items.read()


def _by_time(spark, sf_dir) -> list[DataFrame]:
    """The envelopes up to the bound and those after it, as a feed in order of time has them."""
    envelopes = landing(spark, sf_dir).envelopes()
    early = F.col("event_timestamp") <= F.lit(BOUND).cast("timestamp")
    return [envelopes.where(early), envelopes.where(~early)]


def _in_two_runs(spark, parts: list[DataFrame], root: str, schema, run: Callable[[DataFrame], None]) -> None:
    for part in parts:
        part.write.mode("append").parquet(f"{root}/landing", compression=COMPRESSION)
        with large_state(spark, counted=False):
            run(readers.stream_files(spark, f"{root}/landing", schema))


@_query
def stream_demand(spark, sf_dir):
    """Demand per package and day as a running total, from two runs in order of time. Days are forgotten behind the
    watermark; what each batch changed is kept, and the last total of each day counts."""
    root = shared_folder(spark)
    keys = list(tables.PACKAGE_KEYS)

    def run(stream: DataFrame) -> None:
        items = item_rows(stream).select(*keys, "items_quantity", "order_timestamp")
        totals = running_totals(
            items, "order_timestamp", "1 day", keys, {"items_quantity": "items_quantity"}, "1 day"
        )
        run.schema = totals.schema
        finish(append_updates(totals, f"{root}/updates", f"{root}/checkpoint"))

    _in_two_runs(spark, _by_time(spark, sf_dir), root, ENVELOPE, run)
    return latest_updates(spark, f"{root}/updates", run.schema, ["since", *keys])


_STATUSES = StructType([ORDERS["order_id"], ORDERS["status"], StructField("at", ORDERS["order_timestamp"].dataType)])


@_query
def stream_status_transitions(spark, sf_dir):
    """Changes of status in a feed that sends every order twice and then with the status that the merge gives it."""
    orders = flat_orders(landing(spark, sf_dir).envelopes())
    first = orders.select("order_id", "status", F.col("order_timestamp").alias("at"))
    again = first.withColumn("at", F.col("at") + F.expr("INTERVAL 1 DAY"))
    later = _orders(spark, sf_dir).rows().select("order_id", "status", _fixed_time().alias("at"))
    root = shared_folder(spark)

    def run(stream: DataFrame) -> None:
        finish(append_files(status_transitions(stream, remembered=STOCK_WITHIN), f"{root}/rows", f"{root}/checkpoint"))

    _in_two_runs(spark, [first.unionAll(again), again.unionAll(later)], root, _STATUSES, run)
    return spark.read.parquet(f"{root}/rows")


@_query
def stream_stock_rank(spark, sf_dir):
    """Packages by what was ordered of them, sorted anew with every batch; the result after the last one."""
    root, order = shared_folder(spark), [F.desc("items_quantity"), *tables.PACKAGE_KEYS]

    def run(stream: DataFrame) -> None:
        demand = tables.package_demand(item_quantities(stream))
        finish(replace_result(demand.orderBy(*order), f"{root}/rank", f"{root}/checkpoint"))

    _in_two_runs(spark, _halves(spark, sf_dir), root, DEMAND_FIELDS, run)
    return latest_result(spark, f"{root}/rank", *order)


@_query
def stream_from_latest(spark, sf_dir):
    """Events of what comes after the start; what lies there before is skipped unread."""
    root = shared_folder(spark)
    pending, others = _halves(spark, sf_dir)
    table = SnapshotTable(spark, f"{root}/events", EVENTS)
    others.write.parquet(f"{root}/landing", compression=COMPRESSION)
    skip_present(readers.stream_files(spark, f"{root}/landing", ENVELOPE), f"{root}/checkpoint")
    pending.write.mode("append").parquet(f"{root}/landing", compression=COMPRESSION)
    stream = readers.stream_files(spark, f"{root}/landing", ENVELOPE)

    def on_batch(rows: DataFrame, batch: int) -> None:
        table.append(order_events(rows), "events", batch)

    finish(to_function(stream, on_batch, f"{root}/checkpoint"))
    return table.read()


# -- change feeds -----------------------------------------------------------


def _two_parts(rows: DataFrame) -> list[DataFrame]:
    return [rows.where(_order_number() % 2 == part) for part in (0, 1)]


def _fed(spark, root: str, table: SnapshotTable, build, sources: list[DataFrame]) -> ChangeFeed:
    """The feed of a table after one merge for each source."""
    feed = ChangeFeed(spark, f"{root}/feed", table.schema)
    for version, source in enumerate(sources):
        table.merge(build, source, "feed", version, before=lambda merge: feed.record(merge, "feed", version))
    return feed


@_query
def change_feed_items(spark, sf_dir):
    """Item rows before and after two merges that set them to processing."""
    root = shared_folder(spark)
    items = SnapshotTable(spark, f"{root}/orders_items", ORDER_ITEMS)
    envelopes = landing(spark, sf_dir).envelopes()
    items.append(_stored(envelopes, item_rows), "load", 0)
    pending = tables.with_status(item_rows(envelopes, placed=True), PENDING).select("order_id", "inventory_id")
    return _fed(spark, root, items, _items_merge(spark, sf_dir), _two_parts(pending)).between()


@_query
def change_feed_orders(spark, sf_dir):
    """Order rows before and after two merges that set the received ones to processing."""
    root = shared_folder(spark)
    orders = SnapshotTable(spark, f"{root}/orders", ORDERS)
    rows = flat_orders(landing(spark, sf_dir).envelopes())
    orders.append(rows, "load", 0)
    received = tables.with_status(rows, RECEIVED).select("order_id").distinct()
    return _fed(spark, root, orders, orders_merge, _two_parts(received)).between()


@_query
def change_feed_stock(spark, sf_dir):
    """Stock before and after the demand of two batches, the second on what the first has left."""
    root = shared_folder(spark)
    stock = SnapshotTable(spark, f"{root}/package_table", PACKAGES, key_slices(16, *tables.PACKAGE_KEYS))
    stock.replace(landing(spark, sf_dir).packages())
    items = item_rows(landing(spark, sf_dir).envelopes())
    sources = [tables.package_demand(part) for part in _two_parts(items)]
    return _fed(spark, root, stock, stock_merge, sources).between()


# -- messages, mixed feeds, queries beside each other -----------------------


@_query
def routed_messages(spark, sf_dir):
    """Messages of items by order, in partitions, numbered in order of time."""
    land = landing(spark, sf_dir)
    sent = item_rows(land.envelopes(), placed=True).select(
        F.col("order_id").alias("partitionKey"), "inventory_id", "order_timestamp", "items_quantity"
    )
    ids = {"inventory_id": item_id(F.col("partitionKey"), F.col("inventory_id"))}
    order = ["order_timestamp", "partitionKey", "inventory_id"]
    return routing.routed(sent, PARTITIONS, order, late=ids, ranges=land.partitions("envelopes"))


def _mixed(spark, sf_dir) -> readers.Mixed:
    land = landing(spark, sf_dir)
    older = land.envelopes_v1()
    texts = base_table(spark, sf_dir, "documents").select(F.col("text").cast("binary").alias("data"))
    both = land.raw().unionAll(older.select(F.to_json(F.struct(*older.columns)).cast("binary").alias("data")))
    return readers.decode_mixed(both.unionAll(texts))


@_query
def decode_mixed(spark, sf_dir):
    """Orders of both generations from one raw feed."""
    mixed = _mixed(spark, sf_dir)
    current = flat_orders(mixed.current(ORDER_PART)).withColumn("generation", F.lit(2))
    older = flat_orders_v1(mixed.older(ORDER_PART_V1)).withColumn("generation", F.lit(1))
    return current.unionByName(older, allowMissingColumns=True)


@_query
def decode_mixed_items(spark, sf_dir):
    """Items of the older generation from the same feed."""
    return item_rows_v1(_mixed(spark, sf_dir).older())


@_query
def decode_mixed_rejected(spark, sf_dir):
    return _mixed(spark, sf_dir).rejected.select(F.col("data").cast("string").alias("text"))


def _side_by_side(spark, sf_dir) -> tuple[str, SnapshotTable]:
    """Events and items saved by queries of their own over one landing, then statuses of the items."""
    root = shared_folder(spark)
    items = SnapshotTable(spark, f"{root}/orders_items", ORDER_ITEMS)

    def save_items(rows: DataFrame, batch: int) -> None:
        items.append(item_rows(rows), "items", batch)

    def move_items(rows: DataFrame, batch: int) -> None:
        pending = tables.with_status(item_rows(rows, placed=True), PENDING).select("order_id", "inventory_id")
        items.merge(_items_merge(spark, sf_dir), pending, "statuses", batch)

    run_together(
        spark,
        {
            "events": lambda: append_files(
                order_events(_envelope_stream(spark, sf_dir)), f"{root}/events", f"{root}/checkpoints/events"
            ),
            "items": lambda: to_function(
                _envelope_stream(spark, sf_dir), save_items, f"{root}/checkpoints/items"
            ),
            "statuses": lambda: to_function(
                _envelope_stream(spark, sf_dir), move_items, f"{root}/checkpoints/statuses"
            ),
        },
        after={"statuses": ["items"]},
    )
    return f"{root}/events", items


@_query
def pipeline_events(spark, sf_dir):
    return readers.read_files(spark, _side_by_side(spark, sf_dir)[0], schema=EVENTS)


@_query
def pipeline_items(spark, sf_dir):
    return _side_by_side(spark, sf_dir)[1].read()
