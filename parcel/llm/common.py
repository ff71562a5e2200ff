"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcel.session import scratch_dir

# The ASCII whitespace that the operators strip and split at.
ASCII_SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, a null one as an empty one."""
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` also changes other letters, so it serves
    pure ASCII, where it is many times faster than ``translate``."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def text_key(text: Column) -> Column:
    """Tells apart rows that share a doc_id but not a text."""
    return F.xxhash64(text)


#: Lets the shuffle files of a query go as soon as it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows sent to a Python worker at a time where they hold whole texts.
TEXT_ROWS = 1024


def materialise(df: DataFrame, label: str, batch: int | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: it cuts the
    lineage, is computed once and survives the loss of an executor. The shuffle
    files that made it are not needed after that and go at once. ``batch``: the
    most rows that its Arrow tasks get at a time."""
    spark = df.sparkSession
    path, wanted = scratch_dir(spark, label), {_CLEANUP: "true"}
    if batch and not 0 < int(spark.conf.get(_BATCH)) < batch:
        wanted[_BATCH] = str(batch)
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)
