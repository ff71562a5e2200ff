"""Composite jobs: export -> deliver -> verify (P1), find missing -> retry
(P2), the storage report (P3), many exports per run (Q6, Q7) and backfill
(Q8).

The driver only orchestrates: every data step is a Spark job, and the few
values collected are one-row verdicts and per-export result rows.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcel.functions import paths
from parcel.functions.params import ExportSpec, Interval
from parcel.functions.sizes import truncate
from parcel.operators.deliver import RetryPolicy, deliver, delivery_counts, work_list
from parcel.operators.extract import _day, lookback_runs
from parcel.operators.reconcile import classify, extra_on_target, missing_on_target, verdict
from parcel.operators.summary import compare_sides, storage_summary
from parcel.sinks.export import ExportResult, write_export, write_partitioned_export
from parcel.operators.inventory import with_layout
from parcel.sinks.lists import write_uri_list
from parcel.sources.inventory import list_flat, list_folders, list_objects, read_uri_list
from parcel.sources.intervals import NotCorrelated, run_over
from parcel.sources.query import run_spec

PIPELINE_SCHEMA = (
    "export_name string, folder_date string, source_path string, rows_exported bigint, "
    "files bigint, bytes bigint, files_delivered bigint, in_sync boolean, outcome string, error string"
)

MESSAGE_CHARS = 200


def _in_pool(spark: SparkSession, fn, items, threads: int):
    """Q7: submit independent Spark jobs from a small driver thread pool; with
    ``spark.scheduler.mode=FAIR`` each export gets its own pool share."""

    def call(indexed):
        i, item = indexed
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"parcel-{i}")
        try:
            return fn(item)
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    indexed = list(enumerate(items))
    if threads <= 1 or len(items) <= 1:
        return [call(i) for i in indexed]
    with ThreadPoolExecutor(max_workers=threads) as pool:
        return list(pool.map(call, indexed))


def active_specs(specs: list[ExportSpec], overrides: dict[str, str | None] | None = None) -> list[ExportSpec]:
    """Q6: apply run-time query overrides; empty/None overrides skip."""
    out = [s.with_override(overrides) for s in specs]
    return [s for s in out if not s.skipped]


def run_exports(
    spark: SparkSession,
    specs: list[ExportSpec],
    interval: Interval,
    root: str,
    overrides: dict[str, str | None] | None = None,
    shards=None,
    threads: int = 3,
) -> list[ExportResult]:
    """Q6 + Q7 + K1: export every active spec for one interval."""

    def one(spec: ExportSpec) -> ExportResult:
        df = run_spec(spark, spec, interval)
        return write_export(df, root, spec.name, interval.folder_date, spec.format, spec.compression, shards)

    return _in_pool(spark, one, active_specs(specs, overrides), threads)


def _of_all_runs(spark: SparkSession, spec: ExportSpec, runs: list[Interval]) -> DataFrame | None:
    """The spec's rows of all runs in one scan, if its query allows it."""
    if spec.skipped:
        raise ValueError(f"export {spec.name!r} has no query (skipped)")
    try:
        return run_over(spark, spec.query, runs)
    except NotCorrelated:
        return None


def backfill(
    spark: SparkSession,
    spec: ExportSpec,
    first_end,
    last_end,
    root: str,
    shards_per_date=None,
    date_column: str | None = None,
    one_scan: bool = True,
) -> list[ExportResult]:
    """Q8 for any export query: the daily runs ending ``first_end ..
    last_end`` become one Spark job, written once with
    ``partitionBy(folder_date)`` and published as plain date folders.

    With ``date_column``, the query has to select its interval
    (``data_interval_start`` to ``data_interval_end``) on that column; it is
    then run once for the whole range, and each row goes to the run of its
    day; the range reaches the scan. Without, the run dates are joined to the
    query's rows by its own conditions (``sources.intervals``): one scan of its
    tables, whole. With ``one_scan=False``, and for a query that can't be joined
    so, each day's query is bound on its own, which is better for few days of
    tables that are partitioned by date."""
    first, last = _day(first_end), _day(last_end)
    if first > last:
        raise ValueError("backfill range is empty")
    days = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
    runs = [Interval.ending(day, days=1) for day in days]
    dates = [iv.folder_date for iv in runs]
    if date_column is not None:
        # one scan: the query over the whole range, each row tagged with the
        # one run whose day it has
        whole = run_spec(spark, spec, Interval(runs[0].start, runs[-1].end))
        tagged = lookback_runs(whole, date_column, runs[0].ds, runs[-1].ds, days=0)
        ended = F.date_format(F.date_add(F.to_date("folder_date", "yyyyMMdd"), 1), "yyyyMMdd")
        union = tagged.withColumn("folder_date", ended)
    else:
        union = _of_all_runs(spark, spec, runs) if one_scan and len(runs) > 1 else None
        if union is None:
            union = reduce(DataFrame.unionByName, [
                run_spec(spark, spec, iv).withColumn("folder_date", F.lit(iv.folder_date)) for iv in runs])
    return write_partitioned_export(union, root, spec.name, spec.format, spec.compression,
                                    shards_per_date=shards_per_date, expected_dates=dates)


def lookback_backfill(
    df: DataFrame,
    date_column: str,
    first_end,
    last_end,
    root: str,
    export_name: str,
    days: int = 7,
    fmt: str = "CSV",
    compression: str = "GZIP",
) -> list[ExportResult]:
    """Q8 for look-back exports in a single scan: each row is tagged with
    every run (ending ``first_end .. last_end``) whose window holds it, and
    all run folders are written by one partitioned job."""
    tagged = lookback_runs(df, date_column, first_end, last_end, days)
    first, last = _day(first_end), _day(last_end)
    dates = [(first + dt.timedelta(days=i)).strftime("%Y%m%d") for i in range((last - first).days + 1)]
    return write_partitioned_export(tagged, root, export_name, fmt, compression, expected_dates=dates)


@dataclass
class _Row:
    export_name: str
    folder_date: str
    source_path: str | None = None
    rows_exported: int | None = None
    files: int | None = None
    bytes: int | None = None
    files_delivered: int | None = None
    in_sync: bool | None = None
    outcome: str = "error"
    error: str | None = None


def _deliver_and_verify(spark, rows, exported, source_root, target_dir, folder_date,
                        deliver_mode, workers, policy) -> None:
    """One delivery job and one grouped verdict for all of today's exports."""
    src = with_layout(list_folders(spark, source_root, [f"{n}/{folder_date}/" for n in exported]))
    log = deliver(work_list(src), target_dir, mode=deliver_mode, workers=workers, policy=policy,
                  raise_on_failure=False)
    uris = src.select(paths.location("bucket", "key").alias("source_uri"), "export_name")
    per_export = log.join(uris, "source_uri").groupBy("export_name").agg(
        F.count_if(F.col("status") != "superseded").alias("files_tried"),
        F.count_if(F.col("status") == "ok").alias("files_ok"),
        F.min("error").alias("first_error"),
    )
    checked = verdict(src, list_flat(spark, target_dir), exports=exported).select(
        "export_name", "in_sync", "outcome").join(per_export, "export_name", "left")
    for r in checked.collect():  # one row per export
        row = rows[r["export_name"]]
        row.files_delivered = r["files_ok"] or 0
        row.in_sync, row.outcome = bool(r["in_sync"]), r["outcome"]
        failed = (r["files_tried"] or 0) - (r["files_ok"] or 0)
        if failed:
            row.outcome = "error"
            row.error = f"{failed} of {r['files_tried']} files were not delivered; first: {r['first_error']}"


def run_pipeline(
    spark: SparkSession,
    specs: list[ExportSpec],
    interval: Interval,
    source_root: str,
    target_dir: str,
    overrides: dict[str, str | None] | None = None,
    shards=None,
    deliver_mode: str = "parallel",
    workers: int | None = None,
    policy: RetryPolicy = RetryPolicy(),
    threads: int = 3,
) -> DataFrame:
    """Query -> sharded files -> copies in ``target_dir`` -> verdict,
    for every active export of one run.

    The exports are written concurrently (Q7); then all of today's folders
    are listed as one relation, copied by one delivery job, and reconciled by
    one grouped verdict, so the cluster works on all exports at once. A
    failure stays with its export: an export whose query or write fails, or
    any of whose files cannot be delivered, gets ``outcome = 'error'`` and the
    full text in ``error`` and its first 200 characters (F4) in ``message``;
    the others are unaffected.
    """
    folder_date = interval.folder_date
    active = active_specs(specs, overrides)
    rows = {s.name: _Row(s.name, folder_date) for s in active}

    def export_one(spec: ExportSpec):
        try:
            df = run_spec(spark, spec, interval)
            return spec.name, write_export(df, source_root, spec.name, folder_date, spec.format,
                                           spec.compression, shards), None
        except Exception as exc:  # noqa: BLE001 - one export's failure is its own row
            return spec.name, None, exc

    exported = []
    for name, res, exc in _in_pool(spark, export_one, active, threads):
        row = rows[name]
        if exc is not None:
            row.outcome, row.error = "error", f"{type(exc).__name__}: {exc}"
            continue
        row.source_path, row.rows_exported, row.files, row.bytes = res.path, res.rows, len(res.files), res.bytes
        exported.append(name)

    if exported:
        try:
            _deliver_and_verify(spark, rows, exported, source_root, target_dir, folder_date,
                                deliver_mode, workers, policy)
        except Exception as exc:  # noqa: BLE001 - e.g. an unwritable landing folder
            for name in exported:
                rows[name].outcome, rows[name].error = "error", f"{type(exc).__name__}: {exc}"

    df = spark.createDataFrame([tuple(vars(rows[s.name]).values()) for s in active], PIPELINE_SCHEMA)
    return df.withColumn("message", truncate("error", MESSAGE_CHARS))


def verify_uri(
    spark: SparkSession,
    root: str,
    prefix: str,
    target_dir: str,
    export_name: str,
    pattern: str | None = None,
    include_extra: bool = False,
) -> DataFrame:
    """A5 for one source location: the files under ``root``/``prefix`` (the
    prefix and glob rules of S2) against the flat ``target_dir``. One row:
    counts, sorted name samples (``verify_names`` has every name), ``in_sync``, ``no_files_found`` and the
    ``outcome`` (``ok`` / ``no_files`` / ``out_of_sync``)."""
    src = list_objects(spark, root, prefix, pattern)
    return verdict(src, list_flat(spark, target_dir), label=export_name, include_extra=include_extra)


def verify_names(
    spark: SparkSession, root: str, prefix: str, target_dir: str, pattern: str | None = None
) -> DataFrame:
    """The complete lists behind ``verify_uri``: every source name with
    ``source_uri``, both sizes, ``on_target`` and ``state`` (``ok``, ``missing``,
    ``mismatch``), and every other target name with the state ``extra``."""
    src, tgt = list_objects(spark, root, prefix, pattern), list_flat(spark, target_dir)
    named = src.select("filename", "size", paths.location("bucket", "key").alias("key"))
    known = classify(named, tgt).withColumnRenamed("key", "source_uri")
    extra = extra_on_target(src, tgt).select(
        "filename", F.col("size").alias("target_size"), F.lit(True).alias("on_target"), F.lit("extra").alias("state"))
    return known.drop("size_match").unionByName(extra, allowMissingColumns=True)


def find_missing(src: DataFrame, target_inv: DataFrame) -> DataFrame:
    """P2 step 1 (J1 + F3): missing files with their real source URI (the
    object's own key, not prefix + basename)."""
    as_uri = src.select("filename", "size", paths.location("bucket", "key").alias("key"))
    return missing_on_target(as_uri, target_inv).select(F.col("key").alias("uri"), "filename", "size")


def missing_then_retry(
    spark: SparkSession,
    src: DataFrame,
    target_dir: str,
    list_path: str | None = None,
    workers: int | None = None,
    policy: RetryPolicy = RetryPolicy(),
) -> tuple[DataFrame, DataFrame]:
    """List what is missing in ``target_dir``, optionally write it as a
    sorted URI list (K5) and read it back (S4), re-deliver it (D8), and
    return ``(delivery log, A6 counts)``."""
    missing = find_missing(src, list_flat(spark, target_dir))
    if list_path is not None:
        write_uri_list(missing, list_path)
        uris = read_uri_list(spark, list_path)
        work = uris.select(F.col("uri").alias("source_uri"),
                           F.substring_index("uri", "/", -1).alias("filename"),
                           F.lit(None).cast("bigint").alias("size"))
    else:
        work = missing.select(F.col("uri").alias("source_uri"), "filename", "size")
    log = deliver(work, target_dir, mode="parallel", workers=workers, policy=policy, raise_on_failure=False)
    return log, delivery_counts(log)


def report(source_inv: DataFrame | None, target_inv: DataFrame | None):
    """Per-side storage summaries and, when both sides have exports,
    their comparison. Inventories must carry ``export_name``/``folder_date``
    (see ``with_layout`` and ``with_shard_fields``)."""
    s = storage_summary(source_inv) if source_inv is not None else None
    t = storage_summary(target_inv) if target_inv is not None else None
    # emptiness is tested on the inventories (a limit-1 scan), not on the
    # summaries, whose aggregation would otherwise run an extra time
    both = s is not None and t is not None and not source_inv.isEmpty() and not target_inv.isEmpty()
    return s, t, (compare_sides(s, t) if both else None)


__all__ = [
    "active_specs", "run_exports", "backfill", "lookback_backfill", "run_pipeline", "verify_uri",
    "find_missing", "missing_then_retry", "report", "verify_names",
]
