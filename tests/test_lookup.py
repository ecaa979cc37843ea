import pytest
from pyspark.sql import functions as F

from parcelflow.operators.projections import item_review
from parcelflow.schemas import ENVELOPE
from parcelflow.sources import readers
from parcelflow.sources.landing import landing, shared_folder
from parcelflow.sources.writers import save, save_for_lookup

SF_DIR = "/root/testdata/sf0.001"
FILES = 8


def rows_read(df):
    """Rows that the one scan of a plan without exchanges gives to the rest of it."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    assert leaves.size() == 1
    return leaves.head().metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def written(spark):
    envelopes = landing(spark, SF_DIR).envelopes().repartition(FILES, F.col("event_id"))
    root = shared_folder(spark)
    save_for_lookup(envelopes, f"{root}/indexed", "order_id")
    save(envelopes, f"{root}/plain")
    return f"{root}/indexed", f"{root}/plain"


def test_a_lookup_skips_files(spark, written):
    indexed, plain = (readers.read_files(spark, p, schema=ENVELOPE) for p in written)
    n, ids = plain.count(), [r[0] for r in plain.select("order_id").distinct().orderBy("order_id").collect()]
    found = item_review(indexed, order_id=ids[len(ids) // 2])
    assert 0 < rows_read(found) <= n / FILES * 2
    expected = item_review(plain, order_id=ids[len(ids) // 2])
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))


def test_an_absent_key_reads_next_to_nothing(spark, written):
    """Keys between the least and the largest of every file, so that ranges alone skip none."""
    indexed = readers.read_files(spark, written[0], schema=ENVELOPE)
    ids = [r[0] for r in indexed.select("order_id").orderBy("order_id").collect()]
    absent = [f"{ids[len(ids) * k // 10]}x" for k in range(3, 8)]
    assert sum(rows_read(item_review(indexed, order_id=i)) for i in absent) <= len(ids) / FILES


def test_large_row_groups_have_bloom_filters(spark):
    """Keys too many for a dictionary: the filter does it. Null keys are kept and never found."""
    path = f"{shared_folder(spark)}/wide"
    ids = F.when(F.col("id") % 1000 != 0, F.sha2(F.col("id").cast("string"), 256))
    save_for_lookup(spark.range(0, 200_000, 1, 4).select("id", ids.alias("key")), path, "key")
    rows = spark.read.parquet(path)
    assert rows.count() == 200_000 and rows.where("key IS NULL").count() == 200
    one = rows.where(F.col("key") == F.sha2(F.lit("12345"), 256))
    assert rows_read(one) <= 1000 and [r.id for r in one.collect()] == [12345]
    assert rows_read(rows.where(F.col("key") == F.sha2(F.lit("absent"), 256))) <= 1000


def test_rows_are_appended(spark):
    path = f"{shared_folder(spark)}/twice"
    for part in (0, 1):
        save_for_lookup(spark.range(10).where(F.col("id") % 2 == part), path, "id")
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(10))
