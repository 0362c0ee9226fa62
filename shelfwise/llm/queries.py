"""The queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import (
    alignment,
    byte_bpe,
    centroids,
    decontamination,
    html_extraction,
    line_quality,
    near_duplicates,
    pii,
    secret_scan,
    sharding,
    sql,
    token_files,
    toxicity,
    warc,
)
from shelfwise.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def _op1(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.classes(read_table(spark, folder, "documents"))


def _op2(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, folder, "documents"), 40)


def _op3(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(read_table(spark, folder, "documents"))


def _op4(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.round_trip(read_table(spark, folder, "documents"))


def _op5(spark: SparkSession, folder: str) -> DataFrame:
    benchmark = read_table(spark, folder, "benchmark")
    return decontamination.digest(decontamination.contamination(read_table(spark, folder, "documents"), benchmark))


def _op6(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def _op7(spark: SparkSession, folder: str) -> DataFrame:
    return line_quality.quality(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def _op8(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secrets(read_table(spark, folder, "documents"))


def _op9(spark: SparkSession, folder: str) -> DataFrame:
    return warc.derivative_files(read_table(spark, folder, "pages"))


def _op10(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_files(read_table(spark, folder, "documents"))


def _op11(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.clusters(read_table(spark, folder, "embeddings"))


def _op12(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.alignment(read_table(spark, folder, "documents"))


def _op13(spark: SparkSession, folder: str) -> DataFrame:
    return html_extraction.extract(read_table(spark, folder, "pages"))


def queries() -> dict[str, Query]:
    """One query for each operator."""
    return {
        "op1_near_duplicates": _op1,
        "op2_sharding": _op2,
        "op3_personal_data": _op3,
        "op4_byte_bpe": _op4,
        "op5_decontamination": _op5,
        "op6_toxicity": _op6,
        "op7_line_quality": _op7,
        "op8_secret_scan": _op8,
        "op9_warc_derivatives": _op9,
        "op10_token_files": _op10,
        "op11_centroid_clusters": _op11,
        "op12_token_alignment": _op12,
        "op13_html_extraction": _op13,
    }


def oracle_sql() -> dict[str, str]:
    """SQL twins for DuckDB, where SQL can express the operator."""
    return {"op11_centroid_clusters": sql.clusters()}
