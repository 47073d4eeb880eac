"""Queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import op1_lengths, op2_language, op3_decontaminate, op4_mixing, op5_substrings, op6_token_files, op7_licenses, op8_jaccard, op9_secrets, op10_transport_stream, op11_simhash, op12_spelling, op13_divergence, oracles


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_lengths.length_histogram(op1_lengths.token_lengths(_docs(spark, sf_dir)))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return op3_decontaminate.digest(op3_decontaminate.verbatim_matches(_docs(spark, sf_dir), bench))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_substrings.dedup_substrings(_docs(spark, sf_dir), keep_text=False).drop("kept")


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_token_files.token_files(_docs(spark, sf_dir))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_language.identify(_docs(spark, sf_dir))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_mixing.schedule(_docs(spark, sf_dir))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_licenses.scan(_docs(spark, sf_dir))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_jaccard.similar(_docs(spark, sf_dir))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_secrets.digest(op9_secrets.find_secrets(_docs(spark, sf_dir)))


def op10_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_transport_stream.transport_streams(_docs(spark, sf_dir))


def op11_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_simhash.near_copies(_docs(spark, sf_dir))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_spelling.variants(_docs(spark, sf_dir))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_divergence.divergence(_docs(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_counts": op1_token_counts,
        "op2_language_id": op2_language_id,
        "op4_source_mixing": op4_source_mixing,
        "op5_substring_dedup": op5_substring_dedup,
        "op7_license_scan": op7_license_scan,
        "op8_jaccard_join": op8_jaccard_join,
        "op9_secret_scan": op9_secret_scan,
        "op3_decontamination": op3_decontamination,
        "op6_token_output": op6_token_output,
        "op10_media_columns": op10_media_columns,
        "op11_simhash_dedup": op11_simhash_dedup,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_source_divergence": op13_source_divergence,
    }


def oracle_sql() -> dict[str, str]:
    return oracles.SQL
