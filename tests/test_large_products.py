"""Joins with more products than Spark broadcasts: items are neither sorted nor sent with ids as text."""

from datetime import datetime

import pytest

from parcelflow.operators import joins
from parcelflow.operators.merge import items_by_product_merge
from parcelflow.schemas import ORDER_ITEMS_V1, PRODUCTS

ID = "inv-" + "0a" * 32
AT = datetime(2020, 1, 1)


@pytest.fixture(params=[False, True])
def large(spark, request):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    if request.param:
        spark.conf.set(key, "-1")
    yield request.param
    spark.conf.set(key, before)


def items(spark):
    rows = [(i, "o1", p, "nut", 2, 1.5, 0.5, AT, "PENDING") for i, p in
            [(ID, "p1"), ("odd", "p1"), (None, "p2"), ("x", None), ("y", "p9"), (ID, "p3")]]
    return spark.createDataFrame(rows, ORDER_ITEMS_V1)


@pytest.fixture
def products(spark, tmp_path):
    rows = [("p1", 5, True, AT), ("p2", 1, False, AT), ("p3", None, None, None), ("p3", 4, True, AT), (None, 1, True, AT)]
    spark.createDataFrame(rows, PRODUCTS).write.parquet(f"{tmp_path}/products")
    return spark.read.parquet(f"{tmp_path}/products")


def check_plan(df, large):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and ("ShuffledHashJoin" in plan) == large


def test_stock_outcome(spark, large, products):
    found = joins.stock_outcome(items(spark), products)
    assert sorted(((r.inventory_id, r.product_id, r.quantity_updated) for r in found.collect()), key=repr) == sorted([
        (ID, "p1", 3), ("odd", "p1", 3), (None, "p2", 1), ("x", None, None), ("y", "p9", None), (ID, "p3", None),
        (ID, "p3", 2),
    ], key=repr)
    check_plan(found, large)


def test_item_messages(spark, large, products):
    found = joins.item_messages(items(spark), products)
    assert sorted(r.partitionKey or "" for r in found.collect()) == sorted(["", ID, ID, ID, "odd", "x", "y"])
    assert any(f'"inventory_id":"{ID}"' in r.data for r in found.collect())
    check_plan(found, large)


def test_items_by_product(spark):
    key, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "-1")
    try:
        batch = items(spark).where("product_id IN ('p1', 'p3') OR product_id IS NULL")
        merged = items_by_product_merge(items(spark), batch).rows()
        got = sorted(((r.inventory_id, r.product_id, r.status) for r in merged.collect()), key=repr)
        assert got == sorted([
            (ID, "p1", "PROCESSING"), ("odd", "p1", "PROCESSING"), (None, "p2", "PENDING"), ("x", None, "PENDING"),
            ("y", "p9", "PENDING"), (ID, "p3", "PROCESSING"),
        ], key=repr)
        check_plan(merged, True)
    finally:
        spark.conf.set(key, before)
