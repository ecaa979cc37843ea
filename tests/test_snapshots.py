import json
import os

import pytest
from pyspark.sql import functions as F

from parcelflow.operators.merge import items_merge, orders_merge, stock_merge
from parcelflow.schemas import ORDERS, PACKAGES
from parcelflow.sources.snapshots import SnapshotTable, key_slices

DEMAND = "package_id string, subpackage_id int, items_quantity bigint"


def stock_table(spark, path, slices=8):
    table = SnapshotTable(
        spark, f"{path}/stock", PACKAGES, key_slices(slices, "package_id", "subpackage_id")
    )
    rows = spark.range(100).selectExpr(
        "concat('p', id) AS package_id", "1 AS subpackage_id", "10L AS stock_quantity"
    )
    table.replace(rows)
    return table


def order_table(spark, path):
    return SnapshotTable(spark, f"{path}/orders", ORDERS)


def some_orders(spark, *ids, status="RECEIVED"):
    cols = [F.lit(None).cast(f.dataType).alias(f.name) for f in ORDERS if f.name not in
            ("order_id", "status")]
    base = spark.createDataFrame([(i,) for i in ids], "order_id string")
    return base.select("order_id", F.lit(status).alias("status"), *cols)


def versions(table):
    return {n for n in os.listdir(table.path) if n.startswith("version=")}


def slices_of(table, version):
    return {n for n in os.listdir(f"{table.path}/version={version}") if n.startswith("slice=")}


def test_empty_table_has_its_schema(spark, tmp_path):
    table = order_table(spark, tmp_path)
    assert table.read().schema == ORDERS and table.read().count() == 0
    assert table.applied("a") is None


def test_appends_and_replays(spark, tmp_path):
    table = order_table(spark, tmp_path)
    assert table.append(some_orders(spark, "o1"), "feed", 0)
    assert table.append(some_orders(spark, "o2"), "feed", 1)
    assert not table.append(some_orders(spark, "o2"), "feed", 1)
    assert not table.append(some_orders(spark, "o1"), "feed", 0)
    assert table.append(some_orders(spark, "o3"), "other", 0)
    assert sorted(r.order_id for r in table.read().collect()) == ["o1", "o2", "o3"]
    assert table.slices() == ["feed-0", "feed-1", "other-0"]
    assert table.applied("feed") == 1
    assert [r.order_id for r in table.read(["feed-1"]).collect()] == ["o2"]


def test_merge_rewrites_only_touched_slices(spark, tmp_path):
    table = stock_table(spark, tmp_path)
    demand = spark.createDataFrame([("p7", 1, 4), ("nowhere", 1, 1)], DEMAND)
    assert table.merge(stock_merge, demand, "feed", 0)
    assert len(slices_of(table, 1)) == 8
    assert len(slices_of(table, 2)) <= 2
    left = {r.package_id: r.stock_quantity for r in table.read().collect()}
    assert len(left) == 100 and left["p7"] == 6 and sum(left.values()) == 996


def test_replayed_merge_is_skipped(spark, tmp_path):
    table = stock_table(spark, tmp_path)
    demand = spark.createDataFrame([("p7", 1, 4)], DEMAND)
    assert table.merge(stock_merge, demand, "feed", 3)
    assert not table.merge(stock_merge, demand, "feed", 3)
    assert not table.merge(stock_merge, demand, "feed", 2)
    assert table.read().where("package_id = 'p7'").first().stock_quantity == 6


def test_merge_without_match_keeps_the_table(spark, tmp_path):
    table = stock_table(spark, tmp_path)
    assert table.merge(stock_merge, spark.createDataFrame([], DEMAND), "feed", 0)
    assert table.read().count() == 100 and table.applied("feed") == 0


def test_merge_finds_rows_in_any_slice(spark, tmp_path):
    table = order_table(spark, tmp_path)
    table.append(some_orders(spark, "o1", "o2", status="PENDING"), "feed", 0)
    table.append(some_orders(spark, "o3"), "feed", 1)
    table.append(some_orders(spark, "o1"), "feed", 2)
    table.merge(orders_merge, some_orders(spark, "o1").select("order_id"), "status", 0)
    rows = sorted((r.order_id, r.status) for r in table.read().collect())
    assert rows == [
        ("o1", "PROCESSING"), ("o1", "PROCESSING"), ("o2", "PENDING"), ("o3", "RECEIVED"),
    ]
    assert slices_of(table, 4) == {"slice=feed-0", "slice=feed-2"}


def test_before_sees_old_values_and_failure_publishes_nothing(spark, tmp_path):
    table = order_table(spark, tmp_path)
    table.append(some_orders(spark, "o1"), "feed", 0)
    source = some_orders(spark, "o1").select("order_id")

    def fail(merge):
        assert merge.changed().first().previous.status == "RECEIVED"
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        table.merge(orders_merge, source, "status", 0, before=fail)
    assert table.read().first().status == "RECEIVED"
    seen = []
    assert table.merge(
        orders_merge, source, "status", 0, before=lambda m: seen.append(m.changed().count())
    )
    assert seen == [1] and table.read().first().status == "PROCESSING"


def test_update_in_place_of_a_join(spark, tmp_path):
    table = order_table(spark, tmp_path)
    table.append(some_orders(spark, "o1"), "feed", 0)
    table.append(some_orders(spark, "o2"), "feed", 1)
    done = {"status": F.lit("DONE")}
    assert table.update(done, F.col("status") == "RECEIVED", "u", 0, slices=["feed-1"])
    assert not table.update(done, F.lit(True), "u", 0)
    assert {(r.order_id, r.status) for r in table.read().collect()} == {
        ("o1", "RECEIVED"), ("o2", "DONE"),
    }


def test_leftovers_of_a_lost_job_are_ignored(spark, tmp_path):
    table = order_table(spark, tmp_path)
    table.append(some_orders(spark, "o1"), "feed", 0)
    some_orders(spark, "ghost").write.parquet(f"{table.path}/version=2/slice=feed-9")
    assert table.read().count() == 1
    table.append(some_orders(spark, "o2"), "feed", 1)
    assert sorted(r.order_id for r in table.read().collect()) == ["o1", "o2"]


def test_second_writer_is_refused(spark, tmp_path):
    table = order_table(spark, tmp_path)
    table.append(some_orders(spark, "o1"), "feed", 0)
    with pytest.raises(RuntimeError, match="another writer"):
        table._commit(1, {}, {})
    assert json.loads(open(f"{table.path}/_commits/000000000001.json").read())["applied"] == {
        "feed": 0
    }


def test_delete_all(spark, tmp_path):
    table = stock_table(spark, tmp_path)
    table.delete_all()
    assert table.read().count() == 0 and table.read().columns == PACKAGES.names
    stock_table(spark, tmp_path)
    assert table.read().count() == 100


def test_slice_rules(spark, tmp_path):
    with pytest.raises(ValueError):
        stock_table(spark, tmp_path).append(spark.createDataFrame([], PACKAGES), "a", 0)
    with pytest.raises(ValueError):
        order_table(spark, tmp_path).append(some_orders(spark, "o"), "a/b", 0)


def test_items_merge_needs_both_keys(spark, tmp_path):
    schema = "order_id string, inventory_id string, status string"
    target = spark.createDataFrame([("o1", "i1", "PENDING"), ("o1", "i2", "PENDING")], schema)
    batch = spark.createDataFrame([("o1", "i1"), ("o2", "i2")], "order_id string, inventory_id string")
    done = items_merge(target, batch).rows().where("status = 'PROCESSING'").collect()
    assert [r.inventory_id for r in done] == ["i1"]


def test_compact(spark, tmp_path):
    table = order_table(spark, tmp_path)
    for batch in range(4):
        table.append(some_orders(spark, f"o{batch}"), "feed", batch)
    table.compact()
    assert table.slices() == ["compact-5", "feed-3"]
    assert sorted(r.order_id for r in table.read().collect()) == ["o0", "o1", "o2", "o3"]
    assert not table.append(some_orders(spark, "o3"), "feed", 3)
    table.compact(["compact-5"])
    assert table.slices() == ["compact-5", "feed-3"]
    with pytest.raises(ValueError):
        stock_table(spark, tmp_path).compact()
