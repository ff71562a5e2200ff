"""Inventory shaping: layout and shard-name extraction, export filter,
listing order and retention candidates (I6, I7, I8, O2, P4)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcel.functions import paths
from parcel.session import stored


def with_layout(inv: DataFrame) -> DataFrame:
    """I6 (source side): keys ``export/date/.../file`` gain ``export_name`` and
    ``folder_date``; keys with fewer than three parts are dropped."""
    keep = [c for c in inv.columns if c not in ("export_name", "folder_date")]
    lay = inv.select(*keep, paths.layout("key").alias("_lay")).where(F.col("_lay").isNotNull())
    return lay.select(*keep, F.col("_lay.export_name").alias("export_name"),
                      F.col("_lay.folder_date").alias("folder_date"))


def with_shard_fields(inv: DataFrame) -> DataFrame:
    """I7 (target side): file names ``name_YYYYMMDD-N.ext`` gain
    ``export_name`` and ``folder_date``; other names are dropped."""
    keep = [c for c in inv.columns if c not in ("export_name", "folder_date")]
    sf = inv.select(*keep, paths.shard_fields("filename").alias("_sf")).where(F.col("_sf").isNotNull())
    return sf.select(*keep, F.col("_sf.export_name").alias("export_name"),
                     F.col("_sf.folder_date").alias("folder_date"))


def for_export(inv: DataFrame, export_name: str | None) -> DataFrame:
    """I8: optional equality filter on ``export_name``."""
    return inv if not export_name else inv.where(F.col("export_name") == export_name)


def directory_entries(inv: DataFrame, directory: str = "") -> DataFrame:
    """O2: entries directly under ``directory`` of an inventory: its files and
    one row per sub-folder (derived with ``distinct`` on the next path part).

    Columns ``name, is_dir, size, sort_key``; ``orderBy("sort_key")`` gives
    folders first, then names case-insensitively (a range-partitioned sort,
    not a single-task one).
    """
    base = directory.strip("/")
    rel = F.col("key") if not base else F.expr(f"substring(key, {len(base) + 2})")
    scoped = inv if not base else inv.where(F.col("key").startswith(base + "/"))
    scoped = scoped.select(rel.alias("rel"), "size")
    file_rows = scoped.where(~F.col("rel").contains("/") & (F.col("rel") != "")).select(
        F.col("rel").alias("name"), F.lit(False).alias("is_dir"), F.col("size")
    )
    dir_rows = (
        scoped.where(F.col("rel").contains("/"))
        .select(F.substring_index("rel", "/", 1).alias("name"))
        .distinct()
        .select("name", F.lit(True).alias("is_dir"), F.lit(None).cast("bigint").alias("size"))
    )
    entries = file_rows.unionByName(dir_rows)
    key = F.concat(F.when(F.col("is_dir"), F.lit("0")).otherwise(F.lit("1")), F.lower("name"))
    return entries.withColumn("sort_key", key)


def listing_order(inv: DataFrame, directory: str = "") -> DataFrame:
    return directory_entries(inv, directory).orderBy("sort_key", "name")


def listing_positions(inv: DataFrame, directory: str = "") -> DataFrame:
    """O2 with its order as data: the entries with ``ordinal``, 1 for the first
    of the listing. Entries are range-partitioned and sorted once; each
    partition counts its own, and the counts of the partitions before it are
    added, so no task holds more than its range."""
    entries = directory_entries(inv, directory)
    n = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = entries.repartitionByRange(n, "sort_key", "name").sortWithinPartitions("sort_key", "name").withColumns({
        "_part": F.spark_partition_id(),
        "_row": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
    })
    placed = stored(placed, "listing-order")
    before, total = [], 0
    held = {r["_part"]: r["count"] for r in placed.groupBy("_part").count().collect()}  # a row for each partition
    for part in range(n):
        before.append(F.lit(total).cast("bigint"))
        total += held.get(part, 0)
    ordinal = F.element_at(F.array(*before), F.col("_part") + 1) + F.col("_row") + 1
    return placed.withColumn("ordinal", ordinal).drop("_part", "_row")


def retention_candidates(inv: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Objects last modified more than ``days`` days before ``as_of``.

    Returns the rows (with their age in whole days); it never deletes.
    """
    if isinstance(as_of, str):
        as_of = dt.datetime.fromisoformat(as_of)
    if isinstance(as_of, dt.date) and not isinstance(as_of, dt.datetime):
        as_of = dt.datetime(as_of.year, as_of.month, as_of.day)
    cutoff = as_of - dt.timedelta(days=days)
    return inv.where(F.col("mtime") < F.lit(cutoff)).withColumn(
        "age_days", F.datediff(F.lit(as_of.date()), F.to_date("mtime"))
    )
