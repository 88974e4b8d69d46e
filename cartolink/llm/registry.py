"""Queries of the operators in this package, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import brown, decontaminate, fingerprint, fuzzy_lines, html_text, mix, partenum, pii, quality, secrets


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix(_read(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_read(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_read(spark, sf_dir, "documents"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_edits(_read(spark, sf_dir, "documents"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_read(spark, sf_dir, "pages"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines.report(_read(spark, sf_dir, "documents"))


def op9_language_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.language_scores(_read(spark, sf_dir, "documents"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.jaccard_components(_read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_mix_sources, op2_decontamination, op3_quality_classifier, op4_personal_data, op5_secret_scan, op6_fingerprints, op7_html_extraction, op8_line_dedup, op9_language_scores, op10_ngram_jaccard_join)}


def oracle_sql() -> dict[str, str]:
    return {"op1_mix_sources": mix.ORACLE}
