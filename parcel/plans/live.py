"""Driver queries that write and read real files.

Each call works in a fresh folder under the shared checkpoint root, runs the
export / delivery jobs, and returns a DataFrame over what it reads back (so
the oracle compares the *delivered* data with the tables).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcel import files
from parcel.functions import paths
from parcel.functions.params import ExportSpec, Interval, shard_name
from parcel.operators import inventory as inv_ops
from parcel.operators.deliver import RetryPolicy, deliver, delivery_counts, work_list
from parcel.operators.reconcile import verdict
from parcel.plans import jobs
from parcel.session import scratch_dir
from parcel.sinks.export import read_export, read_options, write_export
from parcel.sinks.publish import Publication, _move, recover
from parcel.sources.inventory import list_flat, list_objects
from parcel.sources.query import register_tables, run_query, run_spec

# Fixed configuration of the driver scenarios.
RUN = Interval.ending("1998-06-08")  # folder 19980608
PRIORITIES = (("1-URGENT", "URGENT"), ("2-HIGH", "HIGH"), ("3-MEDIUM", "MEDIUM"),
              ("4-NOT SPECIFIED", "NOT_SPECIFIED"), ("5-LOW", "LOW"))
PRIORITY_SPECS = [ExportSpec(name, f"SELECT * FROM orders WHERE o_orderpriority = '{p}'") for p, name in PRIORITIES]
LOOKBACK_SQL = (
    "SELECT * FROM orders WHERE CAST(o_orderdate AS DATE) "
    "BETWEEN date_sub(DATE('{data_interval_end}'), 7) AND DATE('{data_interval_end}')"
)
NO_WAIT = RetryPolicy(attempts=3, wait_min=0.0, wait_max=0.0)


def _prep(spark: SparkSession, sf: str, tables) -> dict[str, DataFrame]:
    return register_tables(spark, sf, tables)


def _roundtrip(spark, df: DataFrame, name: str, fmt: str, compression: str, shards) -> DataFrame:
    root = scratch_dir(spark, f"export-{name.lower()}")
    res = write_export(df, root, name, RUN.folder_date, fmt, compression, shards)
    return read_export(spark, res.path, df.schema, fmt)


# ------------------------------------------------------------------ extract --

def lookback_extract(spark, sf) -> DataFrame:
    """S1 + Q1 + Q4 + K1 + K4: the reference's configured look-back query,
    exported as CSV/GZIP shards and read back."""
    _prep(spark, sf, ("orders",))
    spec = ExportSpec("ORDERS", LOOKBACK_SQL)
    return _roundtrip(spark, run_spec(spark, spec, RUN), spec.name, spec.format, spec.compression, None)


def single_day_extract(spark, sf) -> DataFrame:
    """Q2 with a typed named parameter."""
    _prep(spark, sf, ("events",))
    return run_query(spark, "SELECT * FROM events WHERE DATE(ts) = :ds", Interval.of("2024-01-02"))


def column_subset_extract(spark, sf) -> DataFrame:
    """Q3: a configured column subset of a whole table."""
    _prep(spark, sf, ("orders",))
    return run_query(spark, "SELECT o_orderkey, o_custkey, o_totalprice FROM orders", RUN)


def interval_extract(spark, sf) -> DataFrame:
    """Q4: the two interval-bound placeholders."""
    _prep(spark, sf, ("events",))
    q = ("SELECT * FROM events WHERE ts >= CAST('{data_interval_start}' AS TIMESTAMP_NTZ) "
         "AND ts < CAST('{data_interval_end}' AS TIMESTAMP_NTZ)")
    return run_query(spark, q, Interval.of("2024-01-02"))


def full_export_roundtrip(spark, sf) -> DataFrame:
    """K1 at table scale: all of lineitem as CSV/GZIP; Spark sizes the shards."""
    t = _prep(spark, sf, ("lineitem",))
    return _roundtrip(spark, t["lineitem"], "LINEITEM", "CSV", "GZIP", "auto")


def export_documents_roundtrip(spark, sf) -> DataFrame:
    """CSV fidelity: quotes, '|', newlines and accents in free text."""
    t = _prep(spark, sf, ("documents",))
    return _roundtrip(spark, t["documents"], "DOCUMENTS", "CSV", "GZIP", "auto")


def export_json_roundtrip(spark, sf) -> DataFrame:
    """K2: JSON without compression; microsecond timestamps survive."""
    t = _prep(spark, sf, ("events",))
    return _roundtrip(spark, t["events"], "EVENTS", "JSON", "NONE", "auto")


def export_parquet_roundtrip(spark, sf) -> DataFrame:
    """K2: Parquet with Snappy (``.parquet.snappy`` names)."""
    t = _prep(spark, sf, ("lineitem",))
    return _roundtrip(spark, t["lineitem"], "LINEITEM", "PARQUET", "SNAPPY", "auto")


def export_shard_names(spark, sf) -> DataFrame:
    """K2 + K3 + S2 + I5 + I7: four shards, listed and parsed back."""
    t = _prep(spark, sf, ("orders",))
    root = scratch_dir(spark, "shards")
    res = write_export(t["orders"], root, "ORDERS", RUN.folder_date, "CSV", "GZIP", shards=4)
    listed = inv_ops.with_shard_fields(list_objects(spark, root, f"ORDERS/{RUN.folder_date}/"))
    return listed.select(
        "filename", "export_name", "folder_date",
        F.regexp_extract("filename", r"-([0-9]+)[.]", 1).cast("bigint").alias("shard"),
        F.lit(res.rows).cast("bigint").alias("rows_exported"),
    )


def _content() -> Column:
    """One number over all columns of all orders rows: a sum of hashes, so a
    corrupted or shifted value shows."""
    row = F.concat_ws(
        "|", "o_orderkey", "o_custkey", "o_orderstatus", F.round(F.col("o_totalprice") * 100).cast("bigint"),
        F.date_format("o_orderdate", "yyyyMMddHHmmss"), "o_orderpriority")
    return F.sum(F.conv(F.substring(F.md5(row), 1, 8), 16, 10).cast("bigint")).alias("content")


def _read_back(spark, results, schema, fmt="CSV") -> DataFrame:
    frames = [read_export(spark, r.path, schema, fmt).withColumn("export_name", F.lit(r.export_name))
              for r in results]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.groupBy("export_name").agg(F.count(F.lit(1)).alias("rows_exported"), _content())


def override_and_skip(spark, sf) -> DataFrame:
    """Q6: one query replaced at run time, two exports skipped."""
    t = _prep(spark, sf, ("orders",))
    specs = PRIORITY_SPECS
    overrides = {
        "HIGH": "SELECT * FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'F'",
        "MEDIUM": None,
        "NOT_SPECIFIED": "",
    }
    res = jobs.run_exports(spark, specs, RUN, scratch_dir(spark, "override"), overrides=overrides)
    return _read_back(spark, res, t["orders"].schema)


def multi_export(spark, sf) -> DataFrame:
    """Q7: five exports of one run submitted concurrently."""
    t = _prep(spark, sf, ("orders",))
    res = jobs.run_exports(spark, PRIORITY_SPECS, RUN, scratch_dir(spark, "multi"), shards="auto", threads=3)
    return _read_back(spark, res, t["orders"].schema)


def backfill_range(spark, sf) -> DataFrame:
    """Q8: five daily look-back runs written by one partitioned job."""
    t = _prep(spark, sf, ("orders",))
    res = jobs.lookback_backfill(t["orders"], "o_orderdate", "1998-06-01", "1998-06-05",
                                 scratch_dir(spark, "backfill"), "ORDERS", days=7)
    schema = t["orders"].schema
    frames = [read_export(spark, r.path, schema).withColumn("folder_date", F.lit(r.folder_date)) for r in res]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.groupBy("folder_date").agg(F.count(F.lit(1)).alias("rows_exported"), _content())


def backfill_queries(spark, sf) -> DataFrame:
    """Q8 for a daily query that names its date column: one scan, one write."""
    t = _prep(spark, sf, ("orders",))
    spec = ExportSpec("DAILY", "SELECT * FROM orders WHERE o_orderdate >= :data_interval_start AND o_orderdate < :data_interval_end")
    res = jobs.backfill(spark, spec, "1998-06-02", "1998-06-06", scratch_dir(spark, "backfill-q"), date_column="o_orderdate")
    frames = [read_export(spark, r.path, t["orders"].schema).withColumn("folder_date", F.lit(r.folder_date))
              for r in res]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.groupBy("folder_date").agg(F.count(F.lit(1)).alias("rows_exported"), _content())


def backfill_any_query(spark, sf) -> DataFrame:
    """Q8 for a query that doesn't name its date column: sixty look-back runs
    in one scan, joined with the run dates by the query's own range."""
    t = _prep(spark, sf, ("orders",))
    spec = ExportSpec("LOOKBACK", LOOKBACK_SQL)
    res = jobs.backfill(spark, spec, "1998-05-01", "1998-06-29", scratch_dir(spark, "backfill-any"))
    sums = {r.folder_date: r.rows for r in res}
    back = spark.read.schema(t["orders"].schema).options(**read_options("CSV")).csv([r.path for r in res])
    day = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    out = back.groupBy(day.alias("folder_date")).agg(F.count(F.lit(1)).alias("rows_exported"), _content())
    counted = F.create_map(*[F.lit(x) for pair in sums.items() for x in pair])
    return out.withColumn("rows_counted", F.try_element_at(counted, F.col("folder_date")).cast("bigint"))


def export_failed_republish(spark, sf) -> DataFrame:
    """K1 + K3: what an export's folder holds after republishing it went wrong.
    ``blocked``: a move fails and is undone, so the earlier export stays.
    ``lost``: the driver is lost after the earlier shards went aside, and
    recovery brings the new ones in. ``lost_undoing``: it is lost while undoing,
    and recovery ends that."""
    orders = _prep(spark, sf, ("orders",))["orders"]
    root, again = scratch_dir(spark, "republish"), orders.where("o_orderstatus = 'F'")
    frames = []
    for name in ("BLOCKED", "LOST", "LOST_UNDOING"):
        first = write_export(orders, root, name, RUN.folder_date, shards=2)
        if name == "BLOCKED":
            _block(first.path, [shard_name(name, RUN.folder_date, 2, "csv.gz")])
            try:
                write_export(again, root, name, RUN.folder_date, shards=3)
            except OSError:
                pass
        else:
            staged = write_export(again, f"{root}-staged", name, RUN.folder_date, shards=3)
            stage = files.join(root, name, f"_stage-{RUN.folder_date}-{'0' * 12}")
            files.makedirs(stage)
            _move(spark, [(files.join(staged.path, n), files.join(stage, n)) for n in staged.files])
            lost = Publication.planned(stage, first.path, [(n, n) for n in staged.files])
            lost.set_aside(spark)
            if name == "LOST_UNDOING":
                lost.move_in(spark)
                lost.withdraw(spark)
            recover(spark, root, name)
        found = list_objects(spark, root, f"{name}/").where(~F.col("key").endswith(".keep")).count()
        back = read_export(spark, files.join(first.path, "*.gz"), orders.schema) if name != "BLOCKED" else read_export(
            spark, files.join(first.path, "BLOCKED_*00[01].csv.gz"), orders.schema)
        frames.append(back.withColumns({"export_name": F.lit(name), "shards": F.lit(found).cast("bigint")}))
    rows = reduce(DataFrame.unionByName, frames)
    return rows.groupBy("export_name", "shards").agg(F.count(F.lit(1)).alias("rows_held"), _content())


# ----------------------------------------------------------------- delivery --

def _read_landing(spark, target: str, schema) -> DataFrame:
    """Rows of every delivered CSV shard, tagged with the export parsed
    from its file name."""
    df = (spark.read.format("csv").options(**read_options("CSV")).schema(schema)
          .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv.gz").load(target))
    sf = paths.shard_fields(F.col("_metadata.file_name"))
    return df.withColumn("export_name", sf["export_name"])


def _delivered_rows(spark, target, schema) -> DataFrame:
    return _read_landing(spark, target, schema).groupBy("export_name").agg(
        F.count(F.lit(1)).alias("rows_delivered"), _content())


def _deliver_and_verify(spark, sf, mode: str, workers) -> DataFrame:
    t = _prep(spark, sf, ("orders",))
    base = scratch_dir(spark, f"deliver-{mode}")
    target = files.join(base, "landing")
    runs = jobs.run_pipeline(spark, PRIORITY_SPECS, RUN, files.join(base, "source"), target,
                             shards=2, deliver_mode=mode, workers=workers)
    rows = _delivered_rows(spark, target, t["orders"].schema)
    return runs.join(rows, "export_name", "left").select(
        "export_name", F.coalesce("rows_delivered", F.lit(0).cast("bigint")).alias("rows_delivered"),
        "content", "in_sync", "outcome")


def deliver_and_verify(spark, sf) -> DataFrame:
    """P1 + D1/D2/D4/D10/D11 + S3 + A5: export, copy in parallel, reconcile,
    and count the rows of the delivered copies."""
    return _deliver_and_verify(spark, sf, "parallel", None)


def deliver_ordered(spark, sf) -> DataFrame:
    """D3: name-ordered, fail-fast delivery (range-partitioned over 2 tasks)."""
    return _deliver_and_verify(spark, sf, "ordered", 2)


def _block(target: str, names) -> None:
    """Make target names unwritable: a non-empty folder sits at each name."""
    for name in names:
        d = files.join(target, name)
        files.makedirs(d)
        fs, p = files.resolve(files.join(d, ".keep"))
        with fs.open_output_stream(p, compression=None) as out:
            out.write(b"x")


def deliver_partial_failure(spark, sf) -> DataFrame:
    """D4 + D5 + A6: every file is tried; one export's names cannot be
    written, so its copies fail after all retries while the others land."""
    t = _prep(spark, sf, ("orders",))
    base = scratch_dir(spark, "partial")
    source, target = files.join(base, "source"), files.join(base, "landing")
    res = jobs.run_exports(spark, PRIORITY_SPECS, RUN, source, shards=2)
    files.makedirs(target)
    _block(target, [n for r in res if r.export_name == "LOW" for n in r.files])
    src = inv_ops.with_layout(list_objects(spark, source))
    log = deliver(work_list(src), target, policy=NO_WAIT, raise_on_failure=False)
    per_export = log.select(paths.shard_fields("filename")["export_name"].alias("export_name"),
                            "status", "attempts").groupBy("export_name").agg(
        F.count_if(F.col("status") == "ok").alias("files_ok"),
        F.count_if(F.col("status") == "failed").alias("files_failed"),
        F.sum("attempts").cast("bigint").alias("attempts"),
    )
    rows = _delivered_rows(spark, target, t["orders"].schema)
    return per_export.join(rows, "export_name", "left").select(
        "export_name", "files_ok", "files_failed", "attempts", "content",
        F.coalesce("rows_delivered", F.lit(0).cast("bigint")).alias("rows_delivered"))


def deliver_ordered_failure(spark, sf) -> DataFrame:
    """D3 + A6: name-ordered delivery of all exports; the second shard of one
    can't be written, so everything after it in name order is skipped."""
    _prep(spark, sf, ("orders",))
    base = scratch_dir(spark, "ordered-failure")
    source, target = files.join(base, "source"), files.join(base, "landing")
    jobs.run_exports(spark, PRIORITY_SPECS, RUN, source, shards=2)
    _block(target, [shard_name("MEDIUM", RUN.folder_date, 1, "csv.gz")])
    log = deliver(work_list(list_objects(spark, source)), target, mode="ordered", workers=1, policy=NO_WAIT, raise_on_failure=False)
    counts = delivery_counts(log).first()  # one row
    state = log.select(paths.shard_fields("filename")["export_name"].alias("export_name"), "status").groupBy("export_name").agg(
        F.array_join(F.sort_array(F.collect_list("status")), ",").alias("statuses"))
    return state.select(*[F.lit(n).cast("bigint").alias(name) for name, n in counts.asDict().items()], *state.columns)


def deliver_resumed(spark, sf) -> DataFrame:
    """D4 + D5 + D8: deliveries with a ledger, large files in byte ranges. The
    first run fails for one export, the second copies only that, the third
    nothing. Counts are of distinct files, though the list has each twice."""
    t = _prep(spark, sf, ("orders",))
    base = scratch_dir(spark, "resumed")
    source, target, ledger = (files.join(base, x) for x in ("source", "landing", "ledger"))
    jobs.run_exports(spark, PRIORITY_SPECS, RUN, source, shards=2)
    work = work_list(list_objects(spark, source))
    blocked = [shard_name("LOW", RUN.folder_date, i, "csv.gz") for i in range(2)]
    _block(target, blocked)
    frames = []
    for run in (1, 2, 3):
        log = deliver(work.unionByName(work), target, policy=NO_WAIT, raise_on_failure=False, part_bytes=10_000, ledger=ledger)
        frames.append(delivery_counts(log).select(F.lit(run).alias("run"), "attempted", "succeeded", "failed", "unchanged"))
        for name in blocked if run == 1 else ():
            files.delete_dir(files.join(target, name))
    rows = _delivered_rows(spark, target, t["orders"].schema).agg(F.sum("rows_delivered").alias("rows_delivered"), F.sum("content").alias("content")).first()
    return reduce(DataFrame.unionByName, frames).withColumns({c: F.lit(n).cast("bigint") for c, n in rows.asDict().items()})


def listed_names(spark, sf) -> DataFrame:
    """S2c + S3b + F5: the names of an export area under a prefix, and the target's shards
    with their export and date, delivered into a folder for date and export."""
    from parcel.operators.deliver import deliver_uri
    from parcel.sources.inventory import list_names, list_target_exports

    _prep(spark, sf, ("orders",))
    base = scratch_dir(spark, "names")
    source = files.join(base, "source")
    jobs.run_exports(spark, PRIORITY_SPECS, RUN, source, shards=2)
    target = paths.target_dir(files.join(base, "landing"), RUN.folder_date, "HIGH")
    deliver_uri(spark, source, f"HIGH/{RUN.folder_date}/", target, "HIGH")
    landed = list_target_exports(spark, f"{base}/landing/{RUN.folder_date}/HIGH").select(F.lit("target").alias("side"), "filename", "export_name", "folder_date")
    names = list_names(spark, source, "").select(F.lit("source").alias("side"), "filename")
    return names.unionByName(landed, allowMissingColumns=True)


def missing_then_retry(spark, sf) -> DataFrame:
    """P2 + J1 + K5 + S4 + D8: two delivered shards disappear, are found
    missing, listed, re-delivered, and the exports verify again."""
    t = _prep(spark, sf, ("orders",))
    base = scratch_dir(spark, "retry")
    source, target = files.join(base, "source"), files.join(base, "landing")
    jobs.run_pipeline(spark, PRIORITY_SPECS, RUN, source, target, shards=2)
    for name in ("URGENT", "HIGH"):
        files.delete_file(files.join(target, shard_name(name, RUN.folder_date, 0, "csv.gz")))
    src = inv_ops.with_layout(list_objects(spark, source))
    # the listing is taken now, before the retry below
    before = jobs.find_missing(src, list_flat(spark, target)).select(
        paths.shard_fields("filename")["export_name"].alias("export_name")
    ).groupBy("export_name").agg(F.count(F.lit(1)).alias("missing_before"))
    log, _counts = jobs.missing_then_retry(spark, src, target, list_path=scratch_dir(spark, "missing-list"))
    retried = log.select(paths.shard_fields("filename")["export_name"].alias("export_name"), "status") \
        .groupBy("export_name").agg(F.count_if(F.col("status") == "ok").alias("retried_ok"))
    v = verdict(src, list_flat(spark, target)).select("export_name", "in_sync")
    rows = _delivered_rows(spark, target, t["orders"].schema)
    zero = F.lit(0).cast("bigint")
    return (v.join(before, "export_name", "left").join(retried, "export_name", "left")
            .join(rows, "export_name", "left")
            .select("export_name",
                    F.coalesce("missing_before", zero).alias("missing_before"),
                    F.coalesce("retried_ok", zero).alias("retried_ok"),
                    F.coalesce("rows_delivered", zero).alias("rows_delivered"),
                    "content", "in_sync"))


def export_area_summary(spark, sf) -> DataFrame:
    """S2 + I6 + A1 over real files: five exports with
    two shards each, summarised from a listing run inside executors. Compressed
    sizes aren't in the tables, so the byte totals are held against what the
    export wrote."""
    _prep(spark, sf, ("orders",))
    from parcel.operators.summary import storage_summary

    root = scratch_dir(spark, "area")
    done = jobs.run_exports(spark, PRIORITY_SPECS, RUN, root, shards=2)
    inv = inv_ops.with_layout(list_objects(spark, root))
    written = F.create_map(*[F.lit(x) for r in done for x in (r.export_name, r.bytes)])
    return storage_summary(inv).select(
        "export_name", "oldest_date", "newest_date", "num_dates", "total_files",
        (F.col("total_size") == F.try_element_at(written, F.col("export_name"))).alias("bytes_agree"))


def deliver_uri_glob(spark, sf) -> DataFrame:
    """D1 + S2b + D10: a wildcard URI selects one export's shards, which are
    delivered; returns the transfer figures and the rows read back."""
    from parcel.operators.deliver import deliver_uri
    from parcel.sources.inventory import list_with_mb

    t = _prep(spark, sf, ("orders",))
    base = scratch_dir(spark, "deliver-uri")
    source, target = files.join(base, "source"), files.join(base, "landing")
    write_export(t["orders"], source, "ORDERS", RUN.folder_date, shards=3)
    res = deliver_uri(spark, source, f"ORDERS/{RUN.folder_date}/ORDERS_*.csv.gz", target, "ORDERS")
    sizes = list_objects(spark, source).select(F.col("key").alias("name"), F.bround(F.col("size") / F.lit(1048576.0), 2).alias("mb"))
    listed = list_with_mb(spark, source, f"ORDERS/{RUN.folder_date}/*").join(sizes, "name").where("size_mb = mb AND updated IS NOT NULL").count()
    rows = _delivered_rows(spark, target, t["orders"].schema)
    return rows.select(
        F.lit(res.files_transferred).cast("bigint").alias("files_transferred"),
        F.lit(res.destination.endswith("/")).alias("destination_is_dir"),
        F.lit(listed).cast("bigint").alias("listed_files"),
        F.col("rows_delivered"),
        "content",
    )
