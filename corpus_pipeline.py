"""A training-data pipeline over ``documents``.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns the documents that go on. ``run`` applies them in order; every stage's
result is written to the shared folder as Parquet and read again, so a lost
executor costs at most a part of one stage.

1. quality: documents that the classifier rejects go.
2. lines: lines repeated in many documents go, but for one copy of each.
3. near_duplicates: of each group of near copies the smallest doc_id stays.
4. benchmark: documents that hold a span of a benchmark item go.
5. mix: sources are mixed to target weights; one row for each repetition.

Defined results: a null text is an empty one, which no stage but the classifier
drops and the mix leaves out (it has no words to repeat); rows that share a
doc_id are judged each by its own text, except that near duplicates keep or drop
them together; an empty table gives no rows; extra columns pass through whatever
their names, but for ``repetition`` and ``words``, which the mix sets.

Classifier and near-duplicate groups can't be written in SQL, so there is no
``ORACLE_SQL``; tests hold every stage against a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parcel.llm import decontamination, line_dedup, mixing, near_dedup, quality
from parcel.llm.common import materialise, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept_documents(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.deduped(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.kept_documents(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' columns with ``repetition`` and ``words``, the words of
    this repetition."""
    return mixing.repetitions(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near_duplicates", near_stage),
    ("benchmark", benchmark_stage),
    ("mix", mix_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
