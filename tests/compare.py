"""Run a query in Spark and its SQL twin in DuckDB and compare all rows."""

import duckdb
import pandas as pd

import __spark_entry__ as spark_entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _text(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
        return None
    if hasattr(value, "year"):
        return str(pd.Timestamp(value))
    return repr(float(value)) if isinstance(value, float) else str(value)


def rows(df: pd.DataFrame) -> list[tuple]:
    columns = [df[c].map(_text) for c in sorted(df.columns)]
    return sorted(zip(*columns), key=repr)


def check(spark, db, name: str, sf_dir: str) -> int:
    got = spark_entry.queries()[name](spark, sf_dir).toPandas()
    want = db.execute(spark_entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
    return len(got)
