import base64

import pytest
from pyspark.errors import PySparkTypeError
from pyspark.sql import functions as F

from parcelflow.operators.projections import flat_orders, item_rows
from parcelflow.schemas import ENVELOPE, ORDER_PART, RAW_RECORD, RAW_TEXT_RECORD
from parcelflow.sources import readers

GOOD = '{"event_id":"e1","order_id":"o1","event_timestamp":"2024-05-01T10:00:00Z"}'


def records(spark, *texts):
    return spark.createDataFrame([(bytearray(t, "utf-8"),) for t in texts], RAW_RECORD)


def test_undecodable_records_are_rejected_whole(spark):
    out = readers.decode(records(spark, GOOD, "not json", "{}", "[1, 2"))
    assert [r.event_id for r in out.rows.collect()] == ["e1"]
    assert {bytes(r.data).decode() for r in out.rejected.collect()} == {"not json", "{}", "[1, 2"}


def test_null_record_is_rejected(spark):
    out = readers.decode(spark.createDataFrame([(None,)], RAW_RECORD))
    assert out.rows.count() == 0 and out.rejected.count() == 1


def test_times_are_parsed(spark):
    row = readers.decode(records(spark, GOOD)).rows.select(
        F.col("event_timestamp").cast("string").alias("t")
    )
    assert row.first().t == "2024-05-01 10:00:00"


def test_mistyped_items_leave_the_order(spark):
    text = '{"order_id":"e","order_details":{"items":"bad","status":"RECEIVED"}}'
    rows = readers.decode(records(spark, text)).rows
    row = rows.first()
    assert row.order_id == "e" and row.order_details["items"] is None
    assert item_rows(rows).count() == 0


def test_mistyped_scalar_becomes_null(spark):
    text = (
        '{"order_id":"e","order_details":{"items":[{"product_id":"p","price":3,"quantity":2.5,'
        '"extra":1,"packages":[{"package_id":"k","quantity":1}]}]}}'
    )
    item = readers.decode(records(spark, text)).rows.first().order_details["items"][0]
    assert item.price == 3.0 and item.quantity is None and item.product_name is None


def test_declared_rows_are_strict(spark):
    with pytest.raises(PySparkTypeError):
        spark.createDataFrame([{"order_details": {"total_amount": 3}}], ENVELOPE)


def test_base64(spark):
    texts = [base64.b64encode(GOOD.encode()).decode(), "%%%", base64.b64encode(b"no").decode()]
    out = readers.decode_base64(spark.createDataFrame([(t,) for t in texts], RAW_TEXT_RECORD))
    assert [r.event_id for r in out.rows.collect()] == ["e1"]
    assert {r.data for r in out.rejected.collect()} == set(texts[1:])


def test_kafka_style_column(spark):
    feed = records(spark, GOOD).withColumnRenamed("data", "value")
    assert readers.decode(feed, column="value").rows.count() == 1


def test_text_is_parsed_once(spark):
    rows = readers.decode(records(spark, GOOD)).rows
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_json_lines_that_cannot_be_read_are_kept_apart(spark, tmp_path):
    path = str(tmp_path / "lines.json")
    with open(path, "w", encoding="utf-8") as file:
        file.write(f"{GOOD}\nnot json\n\n[1, 2\n")
    out = readers.read_json(spark, path)
    assert [r.event_id for r in out.rows.collect()] == ["e1"]
    assert sorted(r.value for r in out.rejected.collect()) == ["", "[1, 2", "not json"]


def test_flat_orders_do_not_parse_items(spark):
    text = GOOD[:-1] + ',"order_details":{"customer_id":"c1","items":[{"product_id":"p"}]}}'
    flat = flat_orders(readers.decode(records(spark, text, "{}"), ORDER_PART).rows)
    assert [r.customer_id for r in flat.collect()] == ["c1"]
    assert "items" not in flat._jdf.queryExecution().optimizedPlan().toString()
    only_items = records(spark, '{"order_details":{"items":[]}}')
    assert readers.decode(only_items, ORDER_PART).rows.count() == 1
    assert readers.decode(only_items, ENVELOPE).rows.count() == 1
