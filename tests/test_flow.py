from datetime import datetime

import pytest

from parcelflow.plans.order_flow import OrderTables, apply_batch, run_order_flow, shortages
from parcelflow.schemas import ENVELOPE, PACKAGES, RAW_RECORD
from parcelflow.sources import readers
from parcelflow.sources.landing import raw_records
from parcelflow.streaming import finish
from test_projections import envelope, envelopes, item, package

AT = datetime(2030, 1, 1)


def setup(spark, path, stock=100):
    tables = OrderTables.at(spark, str(path), package_slices=4)
    tables.packages.replace(
        spark.createDataFrame([("k1", 1, stock), ("k2", 1, stock)], PACKAGES)
    )
    return tables


def state(tables):
    stock = {r.package_id: r.stock_quantity for r in tables.packages.read().collect()}
    orders = sorted((r.order_id, r.status) for r in tables.orders.read().collect())
    items = sorted((r.order_id, r.items_quantity, r.status) for r in tables.items.read().collect())
    events = sorted((r.event_type, r.order_id) for r in tables.events.read().collect())
    return stock, orders, items, events


def first_batch(spark):
    return envelopes(
        spark,
        envelope("o1", [item([package("k1")])], "e1"),
        envelope("o2", [item([package("k1"), package("k2")])], "e2", status="PENDING"),
    )


EXPECTED = (
    {"k1": 88, "k2": 94},
    [("o1", "PROCESSING"), ("o2", "PENDING")],
    [("o1", 6, "PROCESSING"), ("o2", 6, "PROCESSING"), ("o2", 6, "PROCESSING")],
    [("INVENTORY_UPDATED", "o1"), ("ORDER_CREATED", "o1"), ("ORDER_CREATED", "o2")],
)


def test_batch_and_replay(spark, tmp_path):
    tables = setup(spark, tmp_path)
    apply_batch(tables, first_batch(spark), "feed", 0, AT)
    assert state(tables) == EXPECTED
    apply_batch(tables, first_batch(spark), "feed", 0, AT)
    assert state(tables) == EXPECTED
    assert [tuple(r) for r in tables.changes.read().collect()] == [("o1", "RECEIVED", "PROCESSING")]


def test_items_without_an_order_stay_pending(spark, tmp_path):
    tables = setup(spark, tmp_path)
    lost = envelopes(spark, envelope(None, [item([package("k2")])], "e9"))
    apply_batch(tables, lost, "feed", 0, AT)
    assert [r.status for r in tables.items.read().collect()] == ["PENDING"]


def test_compaction_between_batches_keeps_rows(spark, tmp_path):
    """Many batches; the list of slices stays short and the rows are those without compaction."""
    landing = str(tmp_path / "landing")
    for n in range(6):
        batch = envelopes(spark, envelope(f"o{n}", [item([package("k1")])], f"e{n}"))
        batch.coalesce(1).write.mode("append").parquet(landing)
    states = []
    for every in (0, 2):
        tables = setup(spark, tmp_path / f"t{every}")
        stream = readers.stream_files(spark, landing, ENVELOPE, files_per_batch=1)
        checkpoint = str(tmp_path / f"c{every}")
        finish(run_order_flow(stream, tables, checkpoint, "feed", at=AT, compact_every=every))
        states.append(state(tables))
        slices = len(tables.items.slices())
        assert slices == 6 if every == 0 else slices <= 3
    assert states[0] == states[1]


@pytest.mark.parametrize("step", range(1, 9))
def test_lost_anywhere_and_repeated(spark, tmp_path, monkeypatch, step):
    """The job dies at its n-th publish; the batch comes again."""
    from parcelflow.sources.snapshots import SnapshotTable

    tables = setup(spark, tmp_path)
    commit, calls = SnapshotTable._commit, []

    def dying(self, *args):
        calls.append(self.path)
        if len(calls) == step:
            raise RuntimeError("lost")
        commit(self, *args)

    monkeypatch.setattr(SnapshotTable, "_commit", dying)
    try:
        apply_batch(tables, first_batch(spark), "feed", 0, AT)
    except RuntimeError:
        pass
    monkeypatch.setattr(SnapshotTable, "_commit", commit)
    apply_batch(tables, first_batch(spark), "feed", 0, AT)
    assert state(tables) == EXPECTED


def test_short_stock(spark, tmp_path):
    tables = setup(spark, tmp_path, stock=11)
    batch = first_batch(spark)
    apply_batch(tables, batch, "feed", 0, AT)
    stock, _, items, _ = state(tables)
    assert stock == {"k1": 11, "k2": 5}
    assert {s for _, _, s in items} == {"PROCESSING"}
    from parcelflow.operators.projections import item_rows

    kept = [(r.package_id, r.stock_quantity, r.items_quantity) for r in tables.shortages.read().collect()]
    assert kept == [("k1", 11, 12)]
    short = shortages(
        spark.createDataFrame([("k1", 1, 11), ("k2", 1, 11)], PACKAGES), item_rows(batch)
    )
    assert [tuple(r) for r in short.collect()] == [("k1", 1, 11, 12)]


def test_later_batch_reaches_earlier_rows_of_its_orders(spark, tmp_path):
    tables = setup(spark, tmp_path)
    apply_batch(tables, first_batch(spark), "feed", 0, AT)
    more = envelopes(spark, envelope("o2", [item([package("k2")])], "e3"))
    apply_batch(tables, more, "feed", 1, AT)
    _, orders, _, events = state(tables)
    assert orders == [("o1", "PROCESSING"), ("o2", "PROCESSING"), ("o2", "PROCESSING")]
    assert events.count(("INVENTORY_UPDATED", "o2")) == 2
    ids = [r.event_id for r in tables.events.read().collect()]
    assert len(set(ids)) == len(ids)


def test_stream_of_envelopes_in_two_runs(spark, tmp_path):
    tables = setup(spark, tmp_path / "t")
    landing = str(tmp_path / "landing")

    def run():
        stream = readers.stream_files(spark, landing, ENVELOPE)
        finish(run_order_flow(stream, tables, str(tmp_path / "c"), "feed", at=AT))

    first_batch(spark).write.parquet(landing)
    run()
    assert state(tables) == EXPECTED
    run()
    assert state(tables) == EXPECTED
    envelopes(spark, envelope("o3", [item([package("k2")])], "e3")).write.mode("append").parquet(
        landing
    )
    run()
    assert state(tables)[0] == {"k1": 88, "k2": 88}


def test_raw_stream_keeps_what_it_cannot_read(spark, tmp_path):
    tables = setup(spark, tmp_path / "t")
    landing = str(tmp_path / "raw")
    raw_records(first_batch(spark)).write.parquet(landing)
    bad = spark.createDataFrame([(bytearray(b"garbage"),)], RAW_RECORD)
    bad.write.mode("append").parquet(landing)
    stream = readers.stream_files(spark, landing, RAW_RECORD)
    finish(run_order_flow(stream, tables, str(tmp_path / "c"), "feed", raw=True, at=AT))
    assert state(tables) == EXPECTED
    assert [bytes(r.data) for r in tables.rejected.read().collect()] == [b"garbage"]


def test_command_line(spark, tmp_path):
    from parcelflow.__main__ import arguments, main

    tables = setup(spark, tmp_path / "t")
    first_batch(spark).write.parquet(str(tmp_path / "landing"))
    main(
        ["--landing", str(tmp_path / "landing"), "--tables", str(tmp_path / "t"),
         "--checkpoint", str(tmp_path / "c"), "--app", "feed", "--package-slices", "4",
         "--batch-bytes", "1000000"]
    )
    assert state(tables) == EXPECTED
    with pytest.raises(SystemExit):
        arguments(["--topic", "t", "--tables", "x", "--checkpoint", "y", "--app", "z"])
