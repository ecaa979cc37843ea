"""What the operators share: columns of documents, saved tables, batches of texts."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.sources.landing import shared_folder

#: Rows of one Arrow batch that a Python operator gives back.
ROWS_OUT = 512


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it. Where executors have
    it elsewhere, ship it (``--py-files``); the extra path does no harm."""
    root, env = str(Path(__file__).parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` of documents, a null text as the empty one; other columns
    only where named, so that no column of the caller clashes with those of a result."""
    return docs.select("doc_id", *more, F.coalesce("text", F.lit("")).alias("text"))


def whole_row(docs: DataFrame) -> Column:
    """All columns of ``docs`` as one, so that no name of theirs clashes with those of a step."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns))


def saved(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read from there: later steps neither compute
    it again nor depend on the executors that made it."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def about(df: DataFrame, most: int) -> DataFrame:
    """About ``most`` rows of a written table, or all if there are not more: a filter on the places of rows,
    which copies of a row don't share, so the bound holds for any data (up to chance) without a sort."""
    n = df.count()
    if n <= most:
        return df
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 32))
    return df.where(place < int(most / n * (1 << 32)))


def crc_of_id(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the document's number as text (of the empty text for a null)."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))


def batches(rows: Iterable[tuple], schema: pa.Schema, most: int = ROWS_OUT) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded length."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def grouped_texts(incoming: Iterator[pa.RecordBatch], points: int) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of (id, text) batches, about ``points`` code points at a time; a text is
    never cut."""
    ids: list = []
    group: list[str] = []
    size = 0
    for batch in incoming:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            ids.append(doc_id)
            group.append(text)
            size += len(text) + 1
            if size >= points:
                yield ids, group
                ids, group, size = [], [], 0
    if ids:
        yield ids, group
