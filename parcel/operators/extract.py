"""Q1-Q3 as DataFrame transformations.

The predicates are written on the raw column (a timestamp range rather than
``to_date(col)``) so the Parquet scan receives them as ``PushedFilters``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcel.functions.params import _as_datetime


def _day(value) -> dt.date:
    return _as_datetime(value).date()


def _day_range(df: DataFrame, column: str, first: dt.date, last: dt.date) -> Column:
    """``DATE(column) BETWEEN first AND last`` in a pushdown-friendly form."""
    dtype = df.schema[column].dataType
    c = F.col(column)
    if isinstance(dtype, T.DateType):
        return c.between(F.lit(first), F.lit(last))
    lo = dt.datetime.combine(first, dt.time())
    hi = dt.datetime.combine(last + dt.timedelta(days=1), dt.time())
    if isinstance(dtype, T.TimestampNTZType):
        return (c >= F.lit(lo)) & (c < F.lit(hi))
    if isinstance(dtype, T.TimestampType):
        # zoned instants: compare with the session-time-zone day bounds
        return (c >= F.lit(lo).cast("timestamp")) & (c < F.lit(hi).cast("timestamp"))
    return F.to_date(c).between(F.lit(first), F.lit(last))


def lookback(df: DataFrame, date_column: str, end, days: int = 7) -> DataFrame:
    """Q1: rows whose date lies in ``[DATE(end) - days, DATE(end)]``.

    Both ends are inclusive, so ``days=7`` spans eight calendar dates.
    """
    last = _day(end)
    return df.where(_day_range(df, date_column, last - dt.timedelta(days=days), last))


def single_day(df: DataFrame, ts_column: str, day) -> DataFrame:
    """Q2: ``DATE(ts_column) = day``."""
    d = _day(day)
    return df.where(_day_range(df, ts_column, d, d))


def lookback_runs(df: DataFrame, date_column: str, first_end, last_end, days: int = 7) -> DataFrame:
    """Q8 for look-back exports: every row tagged with each run date whose
    window contains it, for runs ending ``first_end .. last_end``.

    A row dated ``d`` belongs to runs ending ``d .. d + days``; the rows are
    fanned out with ``explode(sequence(...))`` (a narrow operator, no join),
    then kept only for run dates inside the backfill range. The output has a
    ``folder_date`` column (``yyyyMMdd`` of the run end).
    """
    first, last = _day(first_end), _day(last_end)
    scanned = df.where(_day_range(df, date_column, first - dt.timedelta(days=days), last))
    d = F.to_date(F.col(date_column))
    run = F.explode(F.sequence(d, F.date_add(d, days))).alias("_run_end")
    return (
        scanned.select("*", run)
        .where(F.col("_run_end").between(F.lit(first), F.lit(last)))
        .withColumn("folder_date", F.date_format("_run_end", "yyyyMMdd"))
        .drop("_run_end")
    )
