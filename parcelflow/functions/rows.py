"""Row builders shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BLOCK = 10_000


def is_large(df: DataFrame) -> bool:
    """Whether Spark takes the rows for too many to broadcast, so that a join with them shuffles both sides."""
    threshold = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) > threshold


def hashed_if_large(df: DataFrame) -> DataFrame:
    """The smaller side of a join, narrow and with few rows a key. Where it is not broadcast, each task
    makes a hash table of its part, so that the larger side is neither sorted nor spilled."""
    return df.hint("shuffle_hash") if is_large(df) else df


def numbered(df: DataFrame, count: str, name: str) -> DataFrame:
    """Each row ``count`` times, numbered from 0 in column ``name``. Counts in two
    steps, so that a large count does not become one long array."""
    total = F.col(count).cast("bigint")
    last_block = F.floor((total - 1) / _BLOCK).cast("bigint")
    first = F.col("_block") * _BLOCK
    last = F.least(first + _BLOCK, total) - 1
    return (
        df.where(total > 0)
        .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)))
        .withColumn(name, F.explode(F.sequence(first, last)))
        .drop("_block")
    )
