"""The queries of the operators of this folder over the given tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm import (
    ann,
    bpe,
    exact_dedup,
    harmonic,
    language_model,
    merkle,
    near_dedup,
    packing,
    pii,
    quality,
    secrets,
    spelling,
    toxicity,
)
from parcelflow.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.piece_digests(packing.pieces(table(spark, sf_dir, "documents")))
    return packing.pack(found)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.span_digests(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op3_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(bpe.decode(bpe.encode(table(spark, sf_dir, "documents"))))


def op5_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(table(spark, sf_dir, "documents"))


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_block_matrix_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.hidden_documents(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harmonic.piece_digests(harmonic.pack(table(spark, sf_dir, "documents")))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.check_rows(table(spark, sf_dir, "documents"), merkle.without_line_ends())


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_secret_scan,
        op3_weak_label_quality,
        op4_byte_bpe,
        op5_deleted_interpolation,
        op6_order_minhash,
        op7_block_matrix_neighbours,
        op8_exact_dedup,
        op9_surrogates,
        op10_toxicity,
        op11_harmonic_packing,
        op12_spelling_variants,
        op13_merkle_manifest,
    )
}

SQL: dict[str, str] = {
    "op8_exact_dedup": exact_dedup.EXACT_DEDUP_SQL,
    "op12_spelling_variants": spelling.VARIANTS_SQL,
    "op13_merkle_manifest": merkle.MANIFEST_SQL,
}
