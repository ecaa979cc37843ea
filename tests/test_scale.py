"""Steps whose room or time used to grow faster than their input, on hand-written rows."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from parcelflow import streaming
from parcelflow.functions import packed_id, unpacked_id
from parcelflow.operators.merge import items_merge
from parcelflow.sources import landing, readers
from parcelflow.sources.readers import stream_files
from parcelflow.streaming import stateful


def deliver(spark, root, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/landing")
    return stream_files(spark, f"{root}/landing", spark.read.parquet(f"{root}/landing").schema)


def test_orders_share_state_rows_and_are_forgotten_one_by_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stateful, "BUCKETS", 2)
    schema, day = "order_id string, status string, at timestamp", lambda n: datetime(2024, 1, n)
    deliveries = [
        [(f"o{i}", "RECEIVED", day(1 + i % 2 * 8)) for i in range(40)],
        [("later", "RECEIVED", day(12))],
        # Even orders are forgotten by now, odd ones are known.
        [(f"o{i}", "PROCESSING", day(13)) for i in range(20)],
    ]
    sizes = []
    for rows in deliveries:
        changes = streaming.status_transitions(deliver(spark, tmp_path, rows, schema), "1 day", timedelta(days=6))
        with streaming.large_state(spark):
            query = streaming.finish(streaming.append_files(changes, f"{tmp_path}/out", f"{tmp_path}/ck"), 120)
        sizes += [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    got = sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect()))
    assert got == sorted((f"o{i}", "RECEIVED", "PROCESSING", day(13)) for i in range(1, 20, 2))
    assert max(sizes) <= 2


ID = "inv-" + "0a" * 32
ODD_IDS = [ID, ID.upper(), ID[:-1], ID + "\n", "x" * 70, "0a" * 32, "é-" + "0a" * 32, "inv-1", "", "\x01" + "a" * 63, None]


def test_packed_ids_are_the_same_texts(spark):
    rows = spark.createDataFrame([(t,) for t in ODD_IDS], "t string").repartition(1)
    packed = rows.select("t", packed_id(F.col("t")).alias("p")).collect()
    assert len({r.p for r in packed}) == len(ODD_IDS)
    assert {r.t: len(r.p) for r in packed if r.t == ID} == {ID: 37}
    back = rows.select("t", unpacked_id(packed_id(F.col("t"))).alias("back")).collect()
    assert all(r.t == r.back for r in back)


def test_merge_by_odd_ids_in_more_partitions(spark):
    schema = "inventory_id string, order_id string, status string"
    items = spark.createDataFrame([(t, "o", "PENDING") for t in ODD_IDS] + [(ID, None, "PENDING")], schema)
    batch = items.where("inventory_id IS NULL OR length(inventory_id) > 64")
    merged = items_merge(items, batch, partitions=7)
    rows = merged.rows()
    moved = {t for t in ODD_IDS if t is not None and len(t) > 64}
    want = [(t, "o", "PROCESSING" if t in moved else "PENDING") for t in ODD_IDS] + [(ID, None, "PENDING")]
    assert sorted(map(tuple, rows.collect()), key=repr) == sorted(want, key=repr)
    assert {r.inventory_id for r in merged.changed().collect()} == moved
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count(", 7)") >= 2 and "SortMergeJoin" in plan


def test_landing_rows_ask_for_partitions_by_size(spark, tmp_path, monkeypatch):
    land = landing.Landing(spark, "/root/testdata/sf0.001")
    assert land.partitions("envelopes") is None
    monkeypatch.setattr(landing, "PARTITION_BYTES", 1 << 10)
    assert land.partitions("envelopes") > int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_an_object_is_told_without_a_schema_of_its_values(spark):
    texts = ["{}", '{"a": 1}', "[]", '[{"a": 1}]', "null", "1", '"x"', '{"a": null}', "bad", None]
    feed = spark.createDataFrame([(t,) for t in texts], "data string")
    rejected = readers.decode_mixed(feed).rejected
    assert sorted(r.data or "" for r in rejected.collect()) == sorted(t or "" for t in texts if t not in texts[1:8:6])
    assert "schema_of_variant" not in rejected._jdf.queryExecution().optimizedPlan().toString()


def test_text_landing_is_compressed_in_many_files(spark, monkeypatch):
    monkeypatch.setattr(landing, "TEXT_RECORDS", 100)
    land = landing.Landing(spark, "/root/testdata/sf0.001")
    texts = spark.read.text(land.path("json"))
    files = texts.inputFiles()
    assert files and all(f.endswith(".gz") for f in files)
    assert texts.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] <= 100
    want = landing.json_lines(land.envelopes())
    assert texts.exceptAll(want).isEmpty() and want.exceptAll(texts).isEmpty()


def test_envelopes_are_built_in_partitions_by_size(spark, monkeypatch):
    sf_dir, before = "/root/testdata/sf0.001", spark.conf.get("spark.sql.shuffle.partitions")
    want = landing.Landing(spark, sf_dir).envelopes()
    total = landing.file_bytes(spark, f"{sf_dir}/lineitem.parquet")
    monkeypatch.setattr(landing, "LINE_BYTES", -(-total // 23))
    got = landing.Landing(spark, sf_dir).envelopes()
    assert len(got.inputFiles()) == 23
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"
