"""State of stream joins."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # What a batch changed and what is kept of the state, both of which lie beside the input's own size.
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    # All parts of a join's state in one store per task, in place of four.
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


_COUNTED = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"


@contextmanager
def large_state(spark: SparkSession, counted: bool = True) -> Iterator[None]:
    """Queries started inside keep their state on disk instead of in the memory
    of the executors, and checkpoint only what changed in a batch. If their rows are not
    ``counted`` for the progress, a row is written without being looked up first."""
    settings = _SETTINGS | {_COUNTED: str(counted).lower()}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
