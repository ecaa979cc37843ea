"""Change feeds, routed messages, feeds of both generations."""

import json

from pyspark.sql import functions as F

from parcelflow.operators import routing
from parcelflow.operators.feed import AFTER, BEFORE, ChangeFeed, replayed
from parcelflow.operators.merge import stock_merge
from parcelflow.plans import catalog
from parcelflow.schemas import PACKAGES
from parcelflow.sources.landing import landing
from parcelflow.sources.readers import decode_mixed
from parcelflow.sources.snapshots import SnapshotTable
from parcelflow.streaming import append_files, finish

SF_DIR = "/root/testdata/sf0.001"
KEYS = ["package_id", "subpackage_id"]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_replaying_a_feed_gives_the_table(spark, tmp_path):
    old = spark.createDataFrame([("p", 1, 10), ("p", 2, 5), ("q", 1, 7), (None, 1, 3)], PACKAGES)
    table = SnapshotTable(spark, f"{tmp_path}/stock", PACKAGES)
    table.replace(old)
    feed = ChangeFeed(spark, f"{tmp_path}/feed", PACKAGES)
    demands = [[("p", 1, 4), ("p", 2, 6), ("x", 1, 1)], [("p", 1, 6), ("q", 1, 7), (None, 1, 1)]]
    for version, demand in enumerate(demands):
        source = spark.createDataFrame(demand, "package_id string, subpackage_id int, items_quantity bigint")
        for _ in range(2):  # a batch that comes again leaves one feed
            table.merge(stock_merge, source, "s", version, before=lambda m: feed.record(m, "s", version))
    assert rows(feed.between().select(*KEYS, "stock_quantity", "change_type", "feed_version")) == sorted([
        ("p", 1, 10, BEFORE, 0), ("p", 1, 6, AFTER, 0), ("p", 1, 6, BEFORE, 1), ("p", 1, 0, AFTER, 1),
        ("q", 1, 7, BEFORE, 1), ("q", 1, 0, AFTER, 1),
    ], key=repr)
    assert feed.between(1, 1).count() == 4 and feed.between(last=0).count() == 2
    assert rows(replayed(old, feed.between(), KEYS)) == rows(table.read())
    new = spark.createDataFrame([("z", 1, 1)], PACKAGES)
    feed.record_inserts(new, "load", 2)
    assert rows(replayed(old, feed.between(), KEYS)) == rows(table.read().unionByName(new))
    finish(append_files(feed.stream(), f"{tmp_path}/out", f"{tmp_path}/ck"), 120)
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == rows(feed.between())


def test_positions_have_no_gaps_and_a_hot_key_is_spread(spark):
    rows_ = [("hot" if i % 3 else f"k{i % 17}", i % 50, i) for i in range(3000)] + [(None, 1, -1), ("", 1, -2)]
    sent = spark.createDataFrame(rows_, "partitionKey string, at int, n int").repartition(7)
    plan = routing.routed(sent, 4, ["at", "n"])
    got = plan.collect()
    by_partition = {}
    for r in got:
        by_partition.setdefault(r.partition, []).append((r.position, (r.at, r.n)))
    for found in by_partition.values():
        found.sort()
        assert [p for p, _ in found] == list(range(len(found)))
        assert [o for _, o in found] == sorted(o for _, o in found)
    where = {}
    for r in got:
        assert where.setdefault(r.partitionKey or "", r.partition) == r.partition
    assert len(got) == 3002
    assert routing.routed(sent.where("false"), 4, ["at"]).count() == 0


def test_mixed_feeds_are_parsed_once_and_rejects_kept_apart(spark):
    item = {"product_id": "p", "quantity": 2, "price": 1.5}
    current = {"event_id": "e1", "order_details": {"total_volume": 1.0, "items": [item | {"packages": [{"package_id": "g"}]}]}}
    older = {"event_id": "e0", "order_details": {"items": [item | {"weight": 2.0}]}}
    mistyped = {"event_id": "e2", "order_details": {"total_volume": "x", "items": [item | {"quantity": "many", "packages": []}]}}
    records = [json.dumps(r) for r in (current, older, mistyped, {}, [1], 5)] + ["no json", "", None]
    feed = spark.createDataFrame([(r,) for r in records], "text string").select(F.col("text").cast("binary").alias("data"))
    mixed = decode_mixed(feed)
    first, second = sorted(mixed.current().collect(), key=lambda r: r.event_id)
    assert first.order_details["items"][0].packages[0].package_id == "g" and first.order_details.total_volume == 1.0
    assert second.order_details.total_volume is None and second.order_details["items"][0].quantity is None
    (old,) = mixed.older().collect()
    assert old.event_id == "e0" and old.order_details["items"][0].weight == 2.0
    kept = [None if r.data is None else bytes(r.data).decode() for r in mixed.rejected.collect()]
    assert sorted(kept, key=repr) == sorted(["no json", "", None, "[1]", "5", "{}"], key=repr)
    plan = mixed.current()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parse_json") + plan.count("ParseJson") <= 2  # the expression, and its name in one node


def test_the_feed_of_items_is_that_of_the_table(spark):
    """The registered feed, replayed over the stored items, gives the merged items."""
    envelopes = landing(spark, SF_DIR).envelopes()
    old = catalog._stored(envelopes, catalog.item_rows)
    feed = catalog.all_queries()["change_feed_items"](spark, SF_DIR)
    feed = feed.withColumn("order_timestamp", F.col("order_timestamp").cast("timestamp"))
    want = catalog._items(spark, SF_DIR).rows()
    got = replayed(old, feed, ["order_id", "inventory_id"])
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == want.count()
