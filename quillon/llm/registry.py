"""The queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillon.llm import decontaminate, html_text, licenses, line_dedup, mixing, near_dup, pii, quality_model, quality_rules, sql, token_files
from quillon.llm.text import table


def op1_extract_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"), min_words=1)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), n=3, percent=85)


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.label(table(spark, sf_dir, "documents"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.tokenise(table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_find_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_extract_html, op2_mix_sources, op3_line_dedup, op4_decontaminate, op5_near_duplicates, op6_quality_model, op7_quality_rules, op8_token_files, op9_license_scan, op10_find_pii)}


def expected_sql() -> dict[str, str]:
    """SQL for the queries that it can express whole; the others' tests hold them against brute force, round trips or held-out labels."""
    return {"op4_decontaminate": sql.DECONTAMINATE, "op5_near_duplicates": sql.NEAR_DUPLICATES, "op9_license_scan": sql.license_scan()}
