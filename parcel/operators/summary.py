"""Storage summaries and side comparison.

Summaries are two-level aggregates: (export, date) first -- a hash aggregate
of counts and byte sums with map-side partial aggregation, so an export
holding most of the files is pre-aggregated before any shuffle -- then export
over those few rows (the text min/max of the date folder makes that level
sort-based). There is no ``countDistinct`` expansion.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcel.functions.sizes import size_mb

SUMMARY_COLUMNS = (
    "export_name", "oldest_date", "newest_date", "num_dates", "total_files",
    "total_size", "avg_files_per_date", "avg_size_per_file",
)

# Fixed labels of the side comparison, tested in this order.
STATUS_OK, STATUS_SOURCE_EMPTY, STATUS_TARGET_EMPTY, STATUS_MISMATCH = "OK", "source empty", "target empty", "MISMATCH"
TOTAL_LABEL = "TOTAL"


def per_date(inv: DataFrame) -> DataFrame:
    """A2: files and bytes per (export, date folder); unknown sizes count 0."""
    return inv.groupBy("export_name", "folder_date").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum(F.coalesce(F.col("size"), F.lit(0).cast("bigint"))).alias("bytes"),
    )


def _stats(grouped, *more) -> DataFrame:
    return grouped.agg(
        *more,
        F.min("folder_date").alias("oldest_date"),
        F.max("folder_date").alias("newest_date"),
        F.count(F.lit(1)).alias("num_dates"),
        F.sum("files").alias("total_files"),
        F.sum("bytes").alias("total_size"),
    )


def _derived(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        *more,
        "export_name", "oldest_date", "newest_date", "num_dates", "total_files", "total_size",
        (F.col("total_files") / F.col("num_dates")).alias("avg_files_per_date"),
        F.when(F.col("total_files") > 0, F.col("total_size") / F.col("total_files"))
        .otherwise(F.lit(0.0)).alias("avg_size_per_file"),
    )


def storage_summary(inv: DataFrame) -> DataFrame:
    """A1 + O4: per export oldest/newest date (text order), number of dates,
    files, bytes, files per date and bytes per file. ``orderBy`` export for
    the reference's presentation order."""
    return _derived(_stats(per_date(inv).groupBy("export_name")))


def storage_summary_with_total(inv: DataFrame) -> DataFrame:
    """A1 + A3: the per-export rows plus a ``TOTAL`` row (``rollup``) that
    carries only the file and byte totals."""
    rolled = _stats(per_date(inv).rollup("export_name"), F.grouping("export_name").alias("is_total"))
    # an export may itself be called TOTAL, so the grouping tells the rows apart
    is_total = F.col("is_total") == 1
    rolled = rolled.withColumn("export_name", F.when(is_total, F.lit(TOTAL_LABEL)).otherwise(F.col("export_name")))
    d = _derived(rolled, "is_total")
    keep = lambda c: F.when(~is_total, F.col(c))
    return d.select(
        "export_name",
        keep("oldest_date").alias("oldest_date"),
        keep("newest_date").alias("newest_date"),
        keep("num_dates").alias("num_dates"),
        "total_files",
        "total_size",
        keep("avg_files_per_date").alias("avg_files_per_date"),
        keep("avg_size_per_file").alias("avg_size_per_file"),
    )


def compare_sides(source_summary: DataFrame, target_summary: DataFrame) -> DataFrame:
    """J5 + U3: full outer join of two summaries on the export name; a side
    without the export counts 0. Status: ``OK`` when files and bytes agree,
    else ``source empty`` / ``target empty`` / ``MISMATCH`` in that order."""
    s = source_summary.select("export_name", F.col("total_files").alias("source_files"),
                              F.col("total_size").alias("source_size"))
    t = target_summary.select("export_name", F.col("total_files").alias("target_files"),
                              F.col("total_size").alias("target_size"))
    j = s.join(t, "export_name", "full_outer")
    zero = F.lit(0).cast("bigint")
    sf, tf = F.coalesce("source_files", zero), F.coalesce("target_files", zero)
    ss, ts = F.coalesce("source_size", zero), F.coalesce("target_size", zero)
    status = (
        F.when((sf == tf) & (ss == ts), STATUS_OK)
        .when(sf == 0, STATUS_SOURCE_EMPTY)
        .when(tf == 0, STATUS_TARGET_EMPTY)
        .otherwise(STATUS_MISMATCH)
    )
    return j.select("export_name", sf.alias("source_files"), tf.alias("target_files"),
                    ss.alias("source_size"), ts.alias("target_size"), status.alias("status"))


def transfer_totals(inv: DataFrame, destination_dir: str | None = None, per_export: bool = False) -> DataFrame:
    """A4 + D10, overall or ``per_export``: file count, bytes (unknown sizes count 0), MB to 2 dp, and
    the destination label (``dir/file`` for one file, ``dir/`` otherwise)."""
    agg = (inv.groupBy("export_name") if per_export else inv.groupBy()).agg(
        F.count(F.lit(1)).alias("files_transferred"),
        F.sum(F.coalesce(F.col("size"), F.lit(0).cast("bigint"))).alias("total_bytes"),
        F.max("filename").alias("_only"),
    )
    total = F.coalesce(F.col("total_bytes"), F.lit(0).cast("bigint"))
    cols = [*(["export_name"] if per_export else []), F.col("files_transferred"), total.alias("total_bytes"), size_mb(total).alias("total_mb")]
    if destination_dir is not None:
        d = destination_dir.rstrip("/")
        cols.append(
            F.when(F.col("files_transferred") == 1, F.concat(F.lit(d + "/"), F.col("_only")))
            .otherwise(F.lit(d + "/")).alias("destination")
        )
    return agg.select(*cols)
