"""Order envelopes built from the star-schema tables, and the landing tables
that hold them.

One order is one envelope whose items are its line items. Where messages or tasks
must not hold a whole order, ``shares`` cuts every order alike: a line goes to one
of so many envelopes by a hash of its values. Shares without lines are left out,
but for share 0, which also has the money of the order, so that sums over
envelopes stay what they are. Exact copies of one line share an envelope.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelflow.schemas import (
    ENVELOPE,
    ENVELOPE_V1,
    ORDER_CREATED,
    PACKAGES,
    PENDING,
    PROCESSING,
    PRODUCTS,
    RAW_RECORD,
    RAW_TEXT_RECORD,
    RECEIVED,
)

# Envelopes that every order is cut into, at most.
SHARES = 1

# Bytes of landing files per partition, for joins that shuffle all rows made of them: items
# of that many bytes take some 80 MB to sort.
PARTITION_BYTES = 2 << 20

# Bytes of the given line items per partition while envelopes are built: their order's lines
# and joins then sort in memory, whatever the session's number of partitions.
LINE_BYTES = 6 << 20

# Records in a file of text, at most.
TEXT_RECORDS = 1 << 17

# Status of an order by its letter in the orders table.
STATUS_OF_LETTER = {"O": RECEIVED, "P": PENDING, "F": PROCESSING}

# Fixed value: the time of the last stock count.
STOCK_TIME = "2000-01-01 00:00:00"


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its times, stored without zone, are read as UTC."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    stamps = [f.name for f in df.schema if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in stamps})


def file_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the parquet files at a path, asked of Spark's own reader."""
    files = spark.read.schema("_ int").parquet(path)
    sizes = files.select("_metadata.file_path", "_metadata.file_size").distinct()
    return sizes.agg(F.sum("file_size")).first()[0] or 0


@contextmanager
def shuffles_for(spark: SparkSession, total: int, each: int) -> Iterator[None]:
    """Jobs run inside shuffle into as many partitions as ``total`` bytes make at ``each``, where that is more
    than the session's, and keep them apart, so that no task has more to sort than its memory holds."""
    wanted = -(-total // each)
    if wanted <= int(spark.conf.get("spark.sql.shuffle.partitions")):
        yield
        return
    settings = {
        "spark.sql.shuffle.partitions": str(wanted),
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _line_items(spark: SparkSession, sf_dir: str, shares: int) -> DataFrame:
    """Line items with their product and the share of their order (``part_nr``)."""
    lines = base_table(spark, sf_dir, "lineitem").withColumn(
        "quantity", F.col("l_quantity").cast("bigint")
    )
    parts = base_table(spark, sf_dir, "part")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", _share(shares).alias("part_nr"), *_LINE_ORDER, "p_name", "p_size"
    )


def _share(shares: int) -> Column:
    if shares == 1:
        return F.lit(0).cast("bigint")
    fingerprint = F.md5(
        F.concat_ws(
            "|",
            *(F.col(c).cast("string") for c in ("l_linenumber", "l_partkey", "l_suppkey")),
            F.col("l_shipdate").cast("date").cast("string"),
            F.col("quantity").cast("string"),
            *(
                F.floor(F.col(c) * 100).cast("bigint").cast("string")
                for c in ("l_extendedprice", "l_discount", "l_tax")
            ),
        )
    )
    return F.conv(F.substring(fingerprint, 1, 8), 16, 10).cast("bigint") % shares


# The order of the items in an envelope.
_LINE_ORDER = (
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_extendedprice",
    "l_shipdate",
    "quantity",
)


def _item(line: Column) -> Column:
    """A line item as envelope item. Its part has p_size % 3 + 1 packages."""

    def package(i: Column) -> Column:
        return F.struct(
            F.concat(F.lit("pkg-"), line["l_partkey"]).alias("package_id"),
            i.alias("subpackage_id"),
            i.cast("bigint").alias("quantity"),
            (line["p_size"] * 0.5).alias("weight"),
            (line["p_size"] * 0.25).alias("volume"),
        )

    numbers = F.slice(F.array(*map(F.lit, (1, 2, 3))), 1, line["p_size"] % 3 + 1)
    return F.struct(
        F.concat(F.lit("prd-"), line["l_partkey"]).alias("product_id"),
        line["p_name"].alias("product_name"),
        line["l_extendedprice"].alias("price"),
        line["quantity"].alias("quantity"),
        F.transform(numbers, package).alias("packages"),
    )


def _item_v1(line: Column) -> Column:
    return F.struct(
        F.concat(F.lit("prd-"), line["l_partkey"]).alias("product_id"),
        line["p_name"].alias("product_name"),
        line["l_extendedprice"].alias("price"),
        (line["p_size"] * 0.5).alias("weight"),
        line["quantity"].alias("quantity"),
    )


def build_envelopes(
    spark: SparkSession, sf_dir: str, older: bool = False, shares: int = 1
) -> DataFrame:
    """Order envelopes of the current or the older generation, with the fields
    that the tables have; the declared schema adds the others when they are read."""
    # Package i holds i units, so n packages hold n(n+1)/2.
    n = F.col("p_size") % 3 + 1
    size = F.col("quantity") * (n * (n + 1) / 2) * F.col("p_size")
    # Collecting lines does not shrink them, so they are shuffled as narrow rows
    # and collected once, behind the shuffle that the grouping needs anyway. They
    # stay narrow through the sorts of grouping and join: items are built last.
    keys = ["l_orderkey", "part_nr"] if shares > 1 else ["l_orderkey"]
    contents = (
        _line_items(spark, sf_dir, shares)
        .repartition(*keys)
        .select(*keys, F.struct(*_LINE_ORDER, "p_name", "p_size").alias("line"), size.alias("size"))
        .groupBy(*keys)
        .agg(F.collect_list("line").alias("lines"), F.sum("size").alias("size"))
        .select(
            *keys,
            "lines",
            (F.col("size") * 0.5).alias("weight"),
            (F.col("size") * 0.25).alias("volume"),
        )
    )
    orders = base_table(spark, sf_dir, "orders")
    customers = base_table(spark, sf_dir, "customer")
    nations = base_table(spark, sf_dir, "nation")
    headers = orders.join(customers, F.col("c_custkey") == F.col("o_custkey"), "left").join(
        nations, F.col("n_nationkey") == F.col("c_nationkey"), "left"
    )
    numbers = F.sequence(F.lit(0).cast("bigint"), F.lit(shares - 1).cast("bigint"))
    nr = F.explode(numbers) if shares > 1 else F.lit(0).cast("bigint")
    headers = headers.withColumn("part_nr", nr)
    first = F.col("h.part_nr") == 0
    status = F.create_map(*(F.lit(x) for kv in STATUS_OF_LETTER.items() for x in kv))
    key = F.col("o_orderkey").cast("string")
    suffix = F.when(first, "").otherwise(F.concat(F.lit("-"), F.col("h.part_nr")))
    items = F.transform(F.sort_array("lines"), _item_v1 if older else _item)
    details = F.struct(
        F.concat(F.lit("cus-"), "o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_timestamp"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        items.alias("items"),
        F.when(first, F.col("o_totalprice")).otherwise(0.0).alias("total_amount"),
        F.coalesce("volume", F.lit(0.0)).alias("total_volume"),
        F.coalesce("weight", F.lit(0.0)).alias("total_weight"),
        status[F.col("o_orderstatus")].alias("status"),
        F.struct(
            F.concat(F.lit("adr-"), "o_custkey").alias("address_id"),
            F.col("n_name").alias("country"),
            (F.col("c_nationkey") * 1.5).alias("lat"),
            (F.col("c_nationkey") * -2.25).alias("lon"),
        ).alias("destination_address"),
        F.struct(
            F.lit("card").alias("payment_method"),
            F.lit("paid").alias("payment_status"),
            F.concat(F.lit("txn-"), "o_orderkey").alias("transaction_id"),
        ).alias("payment_details"),
    )
    same = F.col("h.o_orderkey") == F.col("c.l_orderkey")
    if shares > 1:
        same &= F.col("h.part_nr") == F.col("c.part_nr")
    joined = headers.alias("h").join(contents.alias("c"), same, "left")
    return joined.where(first | F.col("lines").isNotNull()).select(
        F.concat(F.lit("ev-"), key, suffix).alias("event_id"),
        F.lit(ORDER_CREATED).alias("event_type"),
        F.col("o_orderdate").alias("event_timestamp"),
        F.concat(F.lit("ord-"), key).alias("order_id"),
        details.alias("order_details"),
    )


def build_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = base_table(spark, sf_dir, "part")
    return parts.select(
        F.concat(F.lit("pkg-"), "p_partkey").alias("package_id"),
        F.explode(F.sequence(F.lit(1), F.col("p_size") % 3 + 1)).alias("subpackage_id"),
        (F.col("p_size").cast("bigint") * 30).alias("stock_quantity"),
    ).to(PACKAGES)


def build_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock by product. One product in seven is not in stock at all."""
    parts = base_table(spark, sf_dir, "part").where("p_partkey % 7 <> 0")
    return parts.select(
        F.concat(F.lit("prd-"), "p_partkey").alias("product_id"),
        (F.col("p_size").cast("bigint") * 30).alias("quantity"),
        (F.col("p_size") % 2 == 0).alias("availability"),
        F.lit(STOCK_TIME).cast("timestamp").alias("updated_at"),
    ).to(PRODUCTS)


def raw_records(envelopes: DataFrame) -> DataFrame:
    """Envelopes as the bytes of a stream record."""
    return envelopes.select(
        F.to_json(F.struct(*envelopes.columns)).cast("binary").alias("data")
    )


def raw_records_base64(envelopes: DataFrame) -> DataFrame:
    return raw_records(envelopes).select(F.base64("data").alias("data"))


def json_lines(envelopes: DataFrame) -> DataFrame:
    return envelopes.select(F.to_json(F.struct(*envelopes.columns)).alias("value"))


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder that driver and executors all see: below
    ``spark.checkpoint.dir``, or a temporary one for a local session."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = _local_root(spark.sparkContext.applicationId)
    return f"{root.rstrip('/')}/parcelflow-{uuid.uuid4().hex}"


@cache
def _local_root(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"parcelflow-{application}-")


# Landing tables that are built by joins and grouping.
_JOINED = ("envelopes", "envelopes_v1")


class Landing:
    """Landing tables of one set of base tables, each written once per session."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.root = shared_folder(spark)
        self._written: set[str] = set()
        self._lock = threading.RLock()

    def _builders(self):
        return {
            "envelopes": lambda: build_envelopes(self.spark, self.sf_dir, shares=SHARES),
            "envelopes_v1": lambda: build_envelopes(
                self.spark, self.sf_dir, older=True, shares=SHARES
            ),
            "packages": lambda: build_packages(self.spark, self.sf_dir),
            "products": lambda: build_products(self.spark, self.sf_dir),
            "raw": lambda: raw_records(self.envelopes()),
            "raw_base64": lambda: raw_records_base64(self.envelopes()),
            "json": lambda: json_lines(self.envelopes()),
        }

    def path(self, name: str) -> str:
        """Folder of the named landing table, written on first use."""
        where = f"{self.root}/{name}"
        with self._lock:
            if name not in self._written:
                fmt = "text" if name == "json" else "parquet"
                source = self._builders()[name]()
                lines = file_bytes(self.spark, f"{self.sf_dir}/lineitem.parquet") if name in _JOINED else 0
                with shuffles_for(self.spark, lines, LINE_BYTES):
                    writer = source.write.mode("overwrite").format(fmt)
                    if fmt == "text":
                        # Any reader of lines knows gzip, but reads a file whole: so many records in one.
                        writer = writer.option("compression", "gzip").option("maxRecordsPerFile", TEXT_RECORDS)
                    else:
                        writer = writer.option("compression", "zstd")
                    writer.save(where)
                self._written.add(name)
        return where

    def partitions(self, name: str) -> int | None:
        """In how many partitions rows made of the named table fit a task, where that
        is more than the session's shuffles have; else None."""
        wanted = -(-file_bytes(self.spark, self.path(name)) // PARTITION_BYTES)
        return wanted if wanted > int(self.spark.conf.get("spark.sql.shuffle.partitions")) else None

    def _read(self, name: str, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path(name))

    def envelopes(self, schema: StructType = ENVELOPE) -> DataFrame:
        return self._read("envelopes", schema)

    def envelopes_v1(self) -> DataFrame:
        return self._read("envelopes_v1", ENVELOPE_V1)

    def packages(self) -> DataFrame:
        return self._read("packages", PACKAGES)

    def products(self) -> DataFrame:
        return self._read("products", PRODUCTS)

    def raw(self) -> DataFrame:
        return self._read("raw", RAW_RECORD)

    def raw_base64(self) -> DataFrame:
        return self._read("raw_base64", RAW_TEXT_RECORD)


_landings: dict[tuple[str, str], Landing] = {}


def landing(spark: SparkSession, sf_dir: str) -> Landing:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landings:
        _landings[key] = Landing(spark, sf_dir)
    return _landings[key]
