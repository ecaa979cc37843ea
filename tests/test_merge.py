import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from parcelflow.operators.merge import (
    Merge,
    items_by_product_merge,
    orders_merge,
    processing_merge,
    product_stock_merge,
    stock_merge,
)
from parcelflow.operators.status import processing_events, status_changes
from parcelflow.schemas import PACKAGES

DEMAND = "package_id string, subpackage_id int, items_quantity bigint"


def stock(spark, *rows):
    return spark.createDataFrame(rows, PACKAGES)


def demand(spark, *rows):
    return spark.createDataFrame(rows, DEMAND)


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stock_is_taken_all_or_nothing(spark):
    m = stock_merge(
        stock(spark, ("a", 1, 10), ("b", 1, 3), ("c", 1, 5)),
        demand(spark, ("a", 1, 4), ("b", 1, 9), ("z", 1, 1)),
    )
    assert table(m.rows()) == [("a", 1, 6), ("b", 1, 3), ("c", 1, 5)]
    assert table(m.refused()) == [("b", 1, 3, 9)]
    assert [(r.package_id, r.stock_quantity, r.previous.stock_quantity)
            for r in m.changed().collect()] == [("a", 6, 10)]


def test_null_keys_never_match(spark):
    m = stock_merge(stock(spark, (None, 1, 10)), demand(spark, (None, 1, 4)))
    assert table(m.rows()) == [(None, 1, 10)]


def test_null_demand_and_null_stock_change_nothing(spark):
    m = stock_merge(
        stock(spark, ("a", 1, 10), ("b", 1, None)), demand(spark, ("a", 1, None), ("b", 1, 1))
    )
    assert table(m.rows()) == [("a", 1, 10), ("b", 1, None)]
    assert m.refused().count() == 2


def test_one_batch_is_one_decision(spark):
    start = stock(spark, ("a", 1, 10))
    assert table(stock_merge(start, demand(spark, ("a", 1, 12))).rows()) == [("a", 1, 10)]
    first = stock_merge(start, demand(spark, ("a", 1, 7))).rows()
    assert table(stock_merge(first, demand(spark, ("a", 1, 5))).rows()) == [("a", 1, 3)]


def orders(spark, *rows):
    return spark.createDataFrame(rows, "order_id string, status string, order_timestamp timestamp")


def test_duplicate_source_rows_fail_only_when_they_match(spark):
    target = orders(spark, ("o1", "RECEIVED", None))
    twice = spark.createDataFrame([("o1",), ("o1",)], "order_id string")
    with pytest.raises(PySparkException, match="several source rows"):
        processing_merge(target, twice, ["order_id"]).rows().collect()
    absent = spark.createDataFrame([("o9",), ("o9",)], "order_id string")
    assert processing_merge(target, absent, ["order_id"]).rows().first().status == "RECEIVED"


def test_orders_count_once(spark):
    target = orders(spark, ("o1", "RECEIVED", None), ("o1", "PENDING", None), ("o2", "X", None))
    twice = spark.createDataFrame([("o1",), ("o1",)], "order_id string")
    rows = orders_merge(target, twice).rows().collect()
    assert sorted((r.order_id, r.status) for r in rows) == [
        ("o1", "PROCESSING"), ("o1", "PROCESSING"), ("o2", "X"),
    ]


def test_restamp(spark):
    from datetime import datetime

    at = datetime(2030, 1, 1)
    target = orders(spark, ("o1", "RECEIVED", datetime(2020, 1, 1)))
    source = spark.createDataFrame([("o1",)], "order_id string")
    assert orders_merge(target, source).rows().first().order_timestamp == datetime(2020, 1, 1)
    assert orders_merge(target, source, restamp=at).rows().first().order_timestamp == at
    assert orders_merge(target, source, restamp=True).rows().first().order_timestamp > datetime(
        2024, 1, 1
    )


def test_product_stock_may_go_negative(spark):
    products = spark.createDataFrame([("p", 2)], "product_id string, quantity bigint")
    wanted = spark.createDataFrame([("p", 5)], "product_id string, quantity bigint")
    assert product_stock_merge(products, wanted).rows().first().quantity == -3


def test_by_product_touches_every_order(spark):
    schema = "inventory_id string, product_id string, status string"
    items = spark.createDataFrame([("1", "p", "N"), ("2", "p", "N"), ("3", "q", "N")], schema)
    batch = spark.createDataFrame([("p",), ("p",)], "product_id string")
    rows = items_by_product_merge(items, batch).rows().collect()
    assert {r.inventory_id for r in rows if r.status == "PROCESSING"} == {"1", "2"}


def test_changes_and_events(spark):
    target = orders(
        spark, ("o1", "RECEIVED", None), ("o1", "RECEIVED", None), ("o2", "PROCESSING", None)
    )
    source = spark.createDataFrame([("o1",), ("o2",)], "order_id string")
    m = orders_merge(target, source)
    assert table(status_changes(m)) == [("o1", "RECEIVED", "PROCESSING")] * 2
    events = processing_events(m.changed()).collect()
    assert [e.order_id for e in events] == ["o1", "o1"]
    assert len({e.event_id for e in events}) == 2
    assert {e.event_type for e in events} == {"INVENTORY_UPDATED"}
    later = processing_events(m.changed(), tag="b2").collect()
    assert not {e.event_id for e in events} & {e.event_id for e in later}


def test_unknown_columns_are_refused(spark):
    with pytest.raises(ValueError):
        Merge(stock(spark), demand(spark), ["package_id"], {"nope": F.lit(1)})


def test_stock_merge_equals_brute_force(spark):
    import random

    draw = random.Random(11)
    have = {(f"p{i}", s): draw.randint(0, 20) for i in range(120) for s in (1, 2)}
    asked = [
        (f"p{draw.randint(0, 150)}", draw.choice([1, 2, 3]), draw.randint(1, 9))
        for _ in range(300)
    ]
    wanted = {}
    for package, sub, quantity in asked:
        wanted[package, sub] = wanted.get((package, sub), 0) + quantity
    want = sorted(
        (*k, v - wanted[k] if wanted.get(k, v + 1) <= v else v) for k, v in have.items()
    )
    summed = demand(spark, *asked).groupBy("package_id", "subpackage_id").agg(
        F.sum("items_quantity").alias("items_quantity")
    )
    m = stock_merge(stock(spark, *((*k, v) for k, v in have.items())), summed)
    assert table(m.rows()) == want
    assert m.changed().count() == sum(1 for k, v in have.items() if wanted.get(k, v + 1) <= v)
    assert m.refused().count() == sum(1 for k, v in have.items() if wanted.get(k, 0) > v)
