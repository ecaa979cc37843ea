"""Streaming sinks, triggers and the handling of running queries.

Every sink function starts its query and returns it. The default trigger takes
what is there and stops; without a source limit that is one batch.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener
from pyspark.sql.types import LongType, StructField, StructType

Trigger = Mapping[str, Any]

# As in sources/snapshots.py: half of what snappy makes of row ids.
COMPRESSION = "zstd"

AVAILABLE_NOW: Trigger = {"availableNow": True}


def every(interval: str) -> Trigger:
    """Start a batch at a fixed interval, ``every("5 seconds")``."""
    return {"processingTime": interval}


def _writer(
    stream: DataFrame, mode: str, trigger: Trigger, checkpoint: str | None, name: str | None
) -> DataStreamWriter:
    writer = stream.writeStream.outputMode(mode).trigger(**trigger)
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    return writer if name is None else writer.queryName(name)


def _compressed(writer: DataStreamWriter, fmt: str) -> DataStreamWriter:
    return writer.option("compression", COMPRESSION) if fmt == "parquet" else writer


def append_files(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    trigger: Trigger = AVAILABLE_NOW,
    name: str | None = None,
) -> StreamingQuery:
    writer = _writer(stream, "append", trigger, checkpoint, name).format(fmt)
    return _compressed(writer, fmt).start(path)


def to_table(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    trigger: Trigger = AVAILABLE_NOW,
    fmt: str = "parquet",
) -> StreamingQuery:
    writer = _writer(stream, "append", trigger, checkpoint, None).format(fmt)
    return _compressed(writer, fmt).toTable(table)


def to_function(
    stream: DataFrame,
    function: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: Trigger = AVAILABLE_NOW,
    name: str | None = None,
) -> StreamingQuery:
    """Call ``function(rows, batch_id)`` for every batch. After a failure the
    last batch comes again with the same id and the same rows."""
    return _writer(stream, "update", trigger, checkpoint, name).foreachBatch(function).start()


def append_updates(
    stream: DataFrame, path: str, checkpoint: str, trigger: Trigger = AVAILABLE_NOW
) -> StreamingQuery:
    """Keep what every batch of an update-mode stream changed, in a folder ``batch=<id>`` of its own: a batch
    that comes again replaces its folder."""

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}", compression=COMPRESSION)

    return to_function(stream, write, checkpoint, trigger)


def latest_updates(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str]) -> DataFrame:
    """The last row of each key in a folder of updates."""
    stored = StructType([*schema.fields, StructField("batch", LongType())])
    rows = spark.read.schema(stored).parquet(path)
    values = [c for c in schema.names if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_last"))
    return last.select(*(f"_last.{c}" if c in values else c for c in schema.names))


def replace_result(
    stream: DataFrame, path: str, checkpoint: str, trigger: Trigger = AVAILABLE_NOW
) -> StreamingQuery:
    """Complete mode: every batch gives the whole result of an aggregate, in sorted files if the stream is sorted,
    and takes the place of the one before. Results lie in ``path/result-<batch>``; ``path/latest`` names the last one."""

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/result-{batch}")
        rows.sparkSession.range(1).select(F.lit(f"result-{batch}").alias("value")).coalesce(1).write.mode(
            "overwrite"
        ).text(f"{path}/latest")

    writer = _writer(stream, "complete", trigger, checkpoint, None)
    return writer.foreachBatch(write).start()


def latest_result(spark: SparkSession, path: str, *order: Column | str) -> DataFrame:
    """The whole result of the last batch. Files have no order among them: name it to get it."""
    rows = spark.read.parquet(f"{path}/{spark.read.text(f'{path}/latest').first()[0]}")
    return rows.orderBy(*order) if order else rows


def observed(rows: DataFrame, name: str, /, **metrics: Column) -> DataFrame:
    """Aggregates of the rows that pass here, reported with the progress of each batch (``inspect``) without
    a pass of their own."""
    return rows.observe(name, *(value.alias(key) for key, value in metrics.items()))


def skip_present(stream: DataFrame, checkpoint: str) -> None:
    """Start at the latest: mark all that the source holds now as taken, without reading
    it. A ``to_function`` query on the same checkpoint then begins with what comes later."""
    finish(to_function(stream, lambda rows, batch: None, checkpoint))


def to_memory(stream: DataFrame, name: str, trigger: Trigger = AVAILABLE_NOW) -> StreamingQuery:
    """Keep the rows on the driver as table ``name``; for looking at small streams."""
    return _writer(stream, "append", trigger, None, name).format("memory").start()


def to_console(
    stream: DataFrame, trigger: Trigger = AVAILABLE_NOW, rows: int = 20
) -> StreamingQuery:
    writer = _writer(stream, "append", trigger, None, None).format("console")
    return writer.option("numRows", rows).start()


def to_kafka(
    messages: DataFrame,
    servers: str,
    topic: str,
    checkpoint: str,
    trigger: Trigger = AVAILABLE_NOW,
) -> StreamingQuery:
    """Send keyed messages (``partitionKey``, ``data``) to a topic."""
    rows = messages.selectExpr("partitionKey AS key", "data AS value")
    writer = _writer(rows, "append", trigger, checkpoint, None).format("kafka")
    return writer.option("kafka.bootstrap.servers", servers).option("topic", topic).start()


def finish(query: StreamingQuery, seconds: float | None = None) -> StreamingQuery:
    """Wait for the end; a failure of the query is raised here."""
    ended = query.awaitTermination() if seconds is None else query.awaitTermination(seconds)
    if ended is False:
        query.stop()
        raise TimeoutError(f"streaming query still running after {seconds} seconds")
    return query


def stop_all(spark: SparkSession) -> int:
    """Stop the active queries of the session and tell how many there were."""
    running = spark.streams.active
    for query in running:
        query.stop()
    return len(running)


def inspect(query: StreamingQuery) -> dict[str, Any]:
    last = query.lastProgress
    return {
        "active": query.isActive,
        "message": query.status["message"],
        "batch": None if last is None else last["batchId"],
        "input_rows": None if last is None else last["numInputRows"],
        "metrics": {} if last is None else {k: dict(_fields(v)) for k, v in last["observedMetrics"].items()},
    }


def _fields(metrics) -> Mapping[str, Any]:
    return metrics.asDict() if hasattr(metrics, "asDict") else metrics


class ProgressLog(StreamingQueryListener):
    """Hands (query name, batch, input rows) of every finished batch to a function;
    without one they are listed in ``batches``, for runs of few batches."""

    def __init__(self, record: Callable[[tuple[str | None, int, int]], None] | None = None):
        self.batches: list[tuple[str | None, int, int]] = []
        self.record = self.batches.append if record is None else record

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        self.record((p.name, p.batchId, p.numInputRows))

    def onQueryTerminated(self, event):
        pass
