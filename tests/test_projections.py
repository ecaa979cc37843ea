import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from parcelflow.functions import prefixed_hash, prefixed_uuid
from parcelflow.operators import projections as P
from parcelflow.operators import tables as T
from parcelflow.schemas import ENVELOPE, ENVELOPE_V1, ORDER_ITEMS, ORDERS


def package(pid="k1", sub=1, quantity=2, weight=0.5, volume=0.25):
    return {
        "package_id": pid, "subpackage_id": sub, "quantity": quantity,
        "weight": weight, "volume": volume,
    }


def item(packages, quantity=3, product="p1"):
    return {
        "product_id": product, "product_name": "thing", "price": 9.5,
        "quantity": quantity, "packages": packages,
    }


def envelope(order="o1", items=None, event="e1", status="RECEIVED"):
    return {
        "event_id": event, "event_type": "ORDER_CREATED", "order_id": order,
        "order_details": {"customer_id": "c1", "items": items, "status": status,
                          "total_amount": 10.0, "total_weight": 4.0,
                          "destination_address": {"lat": 1.0, "lon": 2.0}},
    }


def envelopes(spark, *rows):
    return spark.createDataFrame(list(rows), ENVELOPE)


def test_item_rows(spark):
    rows = P.item_rows(envelopes(spark, envelope(items=[item([package(), package(sub=2)])])))
    assert rows.schema.simpleString() == ORDER_ITEMS.simpleString()
    first = rows.orderBy("subpackage_id").first()
    assert (first.items_quantity, first.items_weight, first.items_volume) == (6, 3.0, 1.5)
    assert first.status == "PENDING" and first.inventory_id.startswith("inv-")
    assert rows.select("inventory_id").distinct().count() == 2


@pytest.mark.parametrize("items", [None, [], [item([])], [item(None)]])
def test_orders_without_packages_give_no_rows(spark, items):
    assert P.item_rows(envelopes(spark, envelope(items=items))).count() == 0


def test_no_columns(spark):
    with pytest.raises(ValueError):
        P.item_rows(spark.range(1).select())
    with pytest.raises(ValueError):
        P.item_rows(None)


def test_large_quantities_do_not_overflow(spark):
    big = envelope(items=[item([package(quantity=100_000)], quantity=100_000)])
    assert P.item_rows(envelopes(spark, big)).first().items_quantity == 10**10
    with pytest.raises(PySparkException):
        spark.sql("SELECT CAST(100000 AS INT) * CAST(100000 AS INT)").collect()


def test_ids_agree_between_reads_and_differ_between_events(spark):
    content = [item([package()])]
    one = envelopes(spark, envelope(items=content), envelope(items=content, event="e2"))
    ids = [{r.inventory_id for r in P.item_rows(one).collect()} for _ in range(2)]
    assert ids[0] == ids[1] and len(ids[0]) == 2


def test_null_keys_keep_their_place(spark):
    content = [item([package()])]
    rows = P.item_rows(
        envelopes(
            spark,
            envelope(order=None, event="x", items=content),
            envelope(order="x", event=None, items=content),
        )
    )
    assert rows.select("inventory_id").distinct().count() == 2


def test_random_ids(spark):
    rows = spark.range(10).select(prefixed_uuid("inv-").alias("i"))
    assert rows.distinct().count() == 10


def test_flat_orders(spark):
    rows = P.flat_orders(envelopes(spark, envelope()))
    assert set(rows.columns) == set(ORDERS.names)
    row = rows.first()
    assert (row.total_price, row.lat, row.lon, row.total_volume) == (10.0, 1.0, 2.0, None)


def test_older_generation(spark):
    row = {
        "event_id": "e", "order_id": "o",
        "order_details": {"items": [{"product_id": "p", "weight": 1.5, "quantity": 2}]},
    }
    old = spark.createDataFrame([row], ENVELOPE_V1)
    assert P.item_rows_v1(old).first().weight == 1.5
    assert "total_volume" not in P.flat_orders_v1(old).columns
    assert "order_date" in P.flat_orders_v1(old, with_date=True).columns


def test_item_review_lookup(spark):
    df = envelopes(
        spark,
        envelope("o1", [item([package("k1"), package("k2")])], "e1"),
        envelope("o2", [item([package("k1")])], "e2"),
    )
    assert P.item_review(df).count() == 3
    assert P.item_review(df, package_id="k1").count() == 2
    row = P.item_review(df, package_id="k1", order_id="o2").collect()
    assert len(row) == 1 and row[0].order_quantity == 3 and row[0].package_quantity == 2


def test_demand_of_unknown_quantities_is_null(spark):
    rows = spark.createDataFrame(
        [("k", 1, None, "PENDING"), ("k", 1, None, "PENDING"), ("m", 1, 4, "PROCESSING")],
        "package_id string, subpackage_id int, items_quantity bigint, status string",
    )
    assert [tuple(r) for r in T.package_demand(rows).collect()] == [("k", 1, None)]
    assert T.package_demand(rows, status=None).count() == 2


def test_max_timestamp_of_empty_table(spark):
    empty = spark.createDataFrame([], "ts timestamp")
    assert [tuple(r) for r in T.max_timestamp(empty, "ts").collect()] == [(None,)]


def test_top_rows_use_no_full_sort(spark):
    top = T.latest_first(spark.range(100).withColumn("t", F.col("id")), "t", limit=25)
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    assert top.count() == 25 and top.first().t == 99


def test_demand_reads_only_its_fields(spark, tmp_path):
    from parcelflow.schemas import DEMAND_FIELDS

    path = str(tmp_path / "e")
    envelopes(spark, envelope(items=[item([package()])])).write.parquet(path)
    narrow = P.item_quantities(spark.read.schema(DEMAND_FIELDS).parquet(path))
    assert T.package_demand(narrow).first().items_quantity == 6
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "product_name" not in plan and "weight" not in plan


def test_numbered_copies(spark):
    from parcelflow.functions import numbered

    rows = spark.createDataFrame([("a", 25_001), ("b", 1), ("c", 0), ("d", 10_000)], "k string, n int")
    out = numbered(rows, "n", "i").groupBy("k").agg(
        F.count("i").alias("n"), F.min("i").alias("low"), F.max("i").alias("high"),
        F.count_distinct("i").alias("m"),
    )
    assert sorted(tuple(r) for r in out.collect()) == [
        ("a", 25_001, 0, 25_000, 25_001), ("b", 1, 0, 0, 1), ("d", 10_000, 0, 9_999, 10_000),
    ]


def test_ids_of_different_keys_differ(spark):
    keys = [("a|b", "c"), ("a", "b|c"), ("1:a", "b"), ("a", "1:b"), ("", "ab"), ("ab", "")]
    rows = spark.createDataFrame(keys, "a string, b string")
    ids = rows.select(prefixed_hash("x-", F.col("a"), F.col("b")).alias("id")).collect()
    assert len({r.id for r in ids}) == len(keys)


def test_order_columns_are_in_the_order_of_the_table(spark):
    assert P.flat_orders(envelopes(spark)).columns == ORDERS.names


def test_orders_by_time_and_stock(spark):
    rows = [(i, f"k{i % 4}", 1, s) for i, s in enumerate([5, 3, 5, 9, 3, 1])]
    packages = spark.createDataFrame(rows, "t int, package_id string, subpackage_id int, stock_quantity bigint")
    packages = packages.repartition(4)

    def stock(df):
        return [(r.stock_quantity, r.package_id) for r in df.collect()]

    rising = [(1, "k1"), (3, "k0"), (3, "k1"), (5, "k0"), (5, "k2"), (9, "k3")]
    falling = [(9, "k3"), (5, "k0"), (5, "k2"), (3, "k0"), (3, "k1"), (1, "k1")]
    assert stock(T.by_stock(packages)) == rising
    assert stock(T.by_stock(packages, ascending=False)) == falling
    newest = T.latest_first(packages, "stock_quantity", "t")
    assert [r.t for r in newest.collect()] == [3, 0, 2, 1, 4, 5]
