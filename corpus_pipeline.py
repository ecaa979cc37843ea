"""From raw documents to packed sequences of token ids, stage by stage.

Every stage takes the written result of the one before as ``docs``. All but the last return rows of
``docs`` with all their columns; the last returns the pieces of the documents with their places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelflow.llm import exact_dedup, near_dedup, packing, pii, quality
from parcelflow.llm.common import find_package, saved, table


def accepted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier accepts."""
    return quality.keep_accepted(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text, that of the largest id."""
    return exact_dedup.keep_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates, that of the least id."""
    return near_dedup.keep_one_of_each(docs)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by surrogates."""
    return pii.hide(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    find_package(spark)
    return packing.pack(packing.piece_digests(packing.pieces(docs)))


STAGES = [
    ("quality classifier", accepted),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("surrogates", surrogates),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on the written result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = saved(docs)
    return docs


# SQL can't express the classifier, the near copies, the surrogates and the packing.
ORACLE_SQL = None
