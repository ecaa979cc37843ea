"""The same checks with a third of all rows on one key."""

import compare
import pytest

import __spark_entry__ as spark_entry
from parcelflow.plans import catalog
from parcelflow.sources import landing

BASE = "/root/testdata/sf0.001"

NAMES = [
    "items_explode",
    "items_explode_v1",
    "orders_flatten",
    "package_demand",
    "items_measures",
    "stock_decrement",
    "items_to_processing",
    "items_by_product",
    "orders_to_processing",
    "orders_to_processing_v1",
    "merge_case",
    "events_from_status",
    "stock_outcome",
    "interval_join",
    "stream_interval_join",
    "stream_inner_join",
    "flow_events",
    "flow_orders",
    "flow_items",
    "flow_stock",
]


@pytest.fixture(scope="module")
def hot_dir(tmp_path_factory):
    """One order, one part and one user take a third of the rows each."""
    out = str(tmp_path_factory.mktemp("hot"))
    db = compare.connect(BASE)
    hot = "CASE WHEN row_number() OVER () % 3 = 0 THEN 7 ELSE {0} END AS {0}"
    changed = {
        "lineitem": f"""SELECT * REPLACE ({hot.format("l_orderkey")},
            CASE WHEN row_number() OVER () % 3 = 1 THEN 5 ELSE l_partkey END AS l_partkey)
            FROM lineitem""",
        "events": f"""SELECT * REPLACE ({hot.format("user_id")}) FROM events""",
    }
    for name in compare.TABLES:
        body = changed.get(name, f"SELECT * FROM {name}")
        db.execute(f"COPY ({body}) TO '{out}/{name}.parquet' (FORMAT parquet)")
    return out


@pytest.fixture(scope="module")
def db(hot_dir):
    return compare.connect(hot_dir)


@pytest.fixture(params=[1, 64])
def shares(request, monkeypatch):
    """Whole orders, and orders cut into many shares, all alike."""
    monkeypatch.setattr(landing, "SHARES", request.param)
    landing._landings.clear()
    catalog._flows.clear()
    yield request.param
    landing._landings.clear()
    catalog._flows.clear()


def test_shares_add_up(spark, hot_dir, shares):
    envelopes = landing.landing(spark, hot_dir).envelopes()
    hot = envelopes.where("order_id = 'ord-7'").selectExpr(
        "event_id", "size(order_details.items) AS n"
    ).collect()
    assert len({r.event_id for r in hot}) == len(hot)
    assert max(r.n for r in hot) < 1.5 * sum(r.n for r in hot) / shares + 20
    orders = spark.read.parquet(f"{hot_dir}/orders.parquet")
    sums = envelopes.selectExpr(
        "sum(order_details.total_amount) AS price", "sum(size(order_details.items)) AS lines"
    ).first()
    assert sums.price == pytest.approx(orders.agg({"o_totalprice": "sum"}).first()[0])
    assert sums.lines == spark.read.parquet(f"{hot_dir}/lineitem.parquet").count()


@pytest.mark.parametrize("name", ["orders_flatten", "items_explode", "merge_case", "flow_events"])
def test_query_over_shares(spark, hot_dir, shares, name):
    assert compare.check(spark, compare.connect(hot_dir), name, hot_dir) > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_on_hot_keys(spark, db, hot_dir, name):
    assert compare.check(spark, db, name, hot_dir) > 0


@pytest.fixture
def no_broadcast(spark):
    """Every join shuffles, and partitions count as skewed from 2 kB on."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.files.openCostInBytes": "0",
        "spark.sql.files.maxPartitionBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    # Landing tables of several files: a partition is split between map tasks.
    landing._landings.clear()
    yield
    landing._landings.clear()
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize(
    "name",
    ["items_by_product", "orders_to_processing_v1", "merge_case", "stock_outcome", "join_using"],
)
def test_hot_key_is_split_at_run_time(spark, hot_dir, no_broadcast, monkeypatch, name):
    # Many envelopes for the hot order.
    monkeypatch.setattr(landing, "SHARES", 512)
    df = spark_entry.queries()[name](spark, hot_dir)
    df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
