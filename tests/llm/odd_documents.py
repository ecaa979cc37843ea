"""A small table of documents with every oddity that an operator must bear."""

from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

CLASHING = ("kept", "digest", "node", "class", "row", "ids", "length", "votes", "key", "_item", "chunk", "score")

LONG = " ".join(f"word{i % 997}" for i in range(30_000))

ROWS = [
    (1, "the quick brown fox jumps over the lazy dog near the river bank today"),
    (2, "the quick brown fox jumps over the lazy dog near the river bank today"),
    (2, "the quick brown fox jumps over the lazy dog near the river bank today"),
    (3, None),
    (None, "a text without a number"),
    (None, None),
    (4, ""),
    (5, " \n\t "),
    (6, LONG),
    (7, LONG + " end"),
    (8, "x" * 50_000),
    (9, "naïve café — 日本語 \U0001f600 don't 'quote'"),
    (2**53 + 1, "one"),
]

SCHEMA = StructType(
    [StructField("doc_id", LongType()), StructField("text", StringType())]
    + [StructField(c, StringType()) for c in CLASHING]
    + [StructField("a.b", BooleanType())]
)


def documents(spark, rows=ROWS, parts=3):
    """The rows with clashing columns, all null but where their number is even."""
    full = [(i, t, *(["x" if (i or 0) % 2 == 0 else None] * len(CLASHING)), None) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
