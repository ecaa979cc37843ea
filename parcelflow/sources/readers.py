"""Batch and stream readers, and the decoding of raw records."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelflow.schemas import ENVELOPE, ENVELOPE_V1


def read_json(spark: SparkSession, path: str, schema: StructType = ENVELOPE) -> Decoded:
    """JSON lines under a declared schema; nothing is inferred, and lines that
    cannot be read are kept apart."""
    return _parsed(spark.read.text(path), F.col("value"), schema)


def read_files(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None
) -> DataFrame:
    reader = spark.read.format(fmt)
    return (reader if schema is None else reader.schema(schema)).load(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def stream_files(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    newest_first: bool = False,
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
    name_pattern: str | None = None,
) -> DataFrame:
    """Stream the files of a folder, from the oldest unless ``newest_first``. To
    leave out the files that are there already, see ``streaming.skip_present``.

    Without a limit the first batch holds all files present. ``bytes_per_batch``
    is the limit to use on large folders.
    """
    options = {
        "latestFirst": "true" if newest_first else None,
        "maxFilesPerTrigger": files_per_batch,
        "maxBytesPerTrigger": bytes_per_batch,
        "pathGlobFilter": name_pattern,
    }
    reader = spark.readStream.format(fmt).schema(schema)
    for key, value in options.items():
        if value is not None:
            reader = reader.option(key, value)
    return reader.load(path)


def kafka_options(
    servers: str,
    topic: str,
    start: str = "earliest",
    records_per_batch: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    if start not in ("earliest", "latest"):
        raise ValueError(f"start must be earliest or latest, not {start!r}")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
        "maxOffsetsPerTrigger": records_per_batch,
        "minPartitions": min_partitions,
    }
    return {k: str(v) for k, v in options.items() if v is not None}


def stream_kafka(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Records of a topic with their bytes in ``data``. Needs Spark's Kafka
    package on the class path."""
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options))
    return reader.load().withColumnRenamed("value", "data")


@dataclass(frozen=True)
class Decoded:
    """Records with their parsed row in ``_row``."""

    parsed: DataFrame

    @property
    def _usable(self) -> Column:
        names = self.parsed.schema["_row"].dataType.names
        return reduce(or_, (F.col(f"_row.`{name}`").isNotNull() for name in names))

    @property
    def rows(self) -> DataFrame:
        """The fields of the schema."""
        return self.parsed.where(self._usable).select("_row.*")

    @property
    def rejected(self) -> DataFrame:
        """The records that gave none of the fields, as they came."""
        return self.parsed.where(~self._usable).drop("_row")


def _parsed(records: DataFrame, text: Column, schema: StructType) -> Decoded:
    # The one-element explode keeps the optimizer from parsing the text again
    # for every use of the row.
    return Decoded(
        records.select("*", F.explode(F.array(F.from_json(text, schema))).alias("_row"))
    )


def decode(records: DataFrame, schema: StructType = ENVELOPE, column: str = "data") -> Decoded:
    """JSON text in a binary column. A field of the wrong type becomes null and
    its record is kept. Whatever a schema leaves out is not parsed; a record counts
    as readable by the fields at the top, so give those in full."""
    return _parsed(records, F.col(column).cast("string"), schema)


def decode_base64(
    records: DataFrame, schema: StructType = ENVELOPE, column: str = "data"
) -> Decoded:
    """JSON text in base64. Text that is no base64 is rejected like bad JSON."""
    text = F.expr(f"CAST(try_to_binary(`{column}`, 'base64') AS STRING)")
    return _parsed(records, text, schema)


@dataclass(frozen=True)
class Mixed:
    """Records of both envelope generations in one feed, parsed once: the text of a record becomes a VARIANT, and
    its shape tells the generation."""

    parsed: DataFrame

    @staticmethod
    def of(records: DataFrame, text: Column) -> Mixed:
        kept = F.explode(F.array(F.struct(F.try_parse_json(text).alias("value"))))  # see _parsed
        return Mixed(records.withColumn("_one", kept).withColumn("_doc", F.col("_one.value")).drop("_one"))

    @property
    def _is_object(self) -> Column:
        # Fields as they lie; a schema of the whole document would visit every value of it.
        fields = F.expr("try_variant_get(_doc, '$', 'map<string, variant>')")
        return F.coalesce(F.size(fields) > 0, F.lit(False))

    @property
    def _is_older(self) -> Column:
        """Older envelopes have items without packages and no volume."""
        packages = F.expr("try_variant_get(_doc, '$.order_details.items[0].packages', 'variant')")
        volume = F.expr("try_variant_get(_doc, '$.order_details.total_volume', 'variant')")
        details = F.expr("try_variant_get(_doc, '$.order_details', 'variant')")
        return details.isNotNull() & packages.isNull() & volume.isNull()

    def _rows(self, schema: StructType, which: Column) -> DataFrame:
        row = F.expr(f"try_variant_get(_doc, '$', '{schema.simpleString()}')")
        names = schema.names
        typed = self.parsed.where(self._is_object & which).select(F.explode(F.array(row)).alias("_row"))
        known = reduce(or_, (F.col(f"_row.`{name}`").isNotNull() for name in names))
        return typed.where(known).select("_row.*")

    def current(self, schema: StructType = ENVELOPE) -> DataFrame:
        return self._rows(schema, ~self._is_older)

    def older(self, schema: StructType = ENVELOPE_V1) -> DataFrame:
        return self._rows(schema, self._is_older)

    @property
    def rejected(self) -> DataFrame:
        """Records that are no JSON object, as they came."""
        return self.parsed.where(~self._is_object).drop("_doc")


def decode_mixed(records: DataFrame, column: str = "data") -> Mixed:
    """Binary records of either generation."""
    return Mixed.of(records, F.col(column).cast("string"))
