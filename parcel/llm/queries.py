"""Driver queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parcel.llm import (
    chat,
    decontamination,
    fill_in_middle,
    fingerprints,
    language_model,
    line_dedup,
    mixing,
    near_dedup,
    quality,
    secret_scan,
    suffix_dedup,
    url_filter,
    whitening,
)
from parcel.llm.common import table


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.query(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.query(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.query(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.query(table(spark, sf_dir, "documents"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.query(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.query(table(spark, sf_dir, "documents"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.query(spark, table(spark, sf_dir, "conversations"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(table(spark, sf_dir, "documents"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.query(table(spark, sf_dir, "pages"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.query(table(spark, sf_dir, "embeddings"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.query(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_line_dedup": op2_line_dedup,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_secret_scan": op4_secret_scan,
    "op5_source_mixing": op5_source_mixing,
    "op6_decontamination": op6_decontamination,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_near_dedup": op8_near_dedup,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_url_filter": op11_url_filter,
    "op12_whitening": op12_whitening,
    "op13_fill_in_middle": op13_fill_in_middle,
}

ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": line_dedup.SQL,
    "op5_source_mixing": mixing.SQL,
    "op6_decontamination": decontamination.SQL,
    "op8_near_dedup": near_dedup.SQL,
    "op9_chat_formatting": chat.SQL,
    "op13_fill_in_middle": fill_in_middle.SQL,
}
