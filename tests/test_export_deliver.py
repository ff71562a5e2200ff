import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from parcel import files
from parcel.functions.params import ExportSpec, Interval
from parcel.operators.deliver import (
    DeliveryError,
    RetryPolicy,
    deliver,
    deliver_uri,
    delivery_counts,
    retry_from_list,
    work_list,
)
from parcel.operators.extract import lookback, single_day
from parcel.plans import jobs
from parcel.sinks.export import read_export, write_export, write_partitioned_export
from parcel.sinks.lists import write_uri_list
from parcel.sources.inventory import list_flat, list_objects

from table_paths import SF_SMALL

NO_WAIT = RetryPolicy(attempts=3, wait_min=0.0, wait_max=0.0)


def _visible(path):
    return sorted(n for n in os.listdir(path) if not n.startswith("."))


def test_lookback_is_inclusive_and_pushed_down(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    q = lookback(o, "o_orderdate", "1998-06-08", 90)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    d = o.select(F.to_date("o_orderdate").alias("d"))
    expected = d.where(F.col("d").between(F.lit("1998-03-10").cast("date"), F.lit("1998-06-08").cast("date"))).count()
    assert q.count() == expected == 70
    assert single_day(o, "o_orderdate", "1998-06-01").count() == \
        d.where(F.col("d") == F.lit("1998-06-01").cast("date")).count()


def test_csv_payload_round_trip(spark, tmp_root):
    rows = [(1, "a|b"), (2, 'say "hi"'), (3, "line1\nline2"), (4, None), (5, ""), (6, "back\\slash"),
            (7, " lead"), (8, "trail "), (9, "naïve")]
    df = spark.createDataFrame(rows, "id int, text string")
    res = write_export(df, tmp_root, "T", "20250101", shards=2)
    back = {r["id"]: r["text"] for r in read_export(spark, res.path, df.schema).collect()}
    expected = dict(rows)
    expected[5] = None  # '' and NULL both read back as NULL (documented CSV limit)
    assert back == expected


def test_shards_names_and_rerun_with_fewer_shards(spark, tmp_root):
    df = spark.range(100).withColumnRenamed("id", "x")
    r1 = write_export(df, tmp_root, "E", "20250101", shards=5)
    assert r1.files == [f"E_20250101-{i:012d}.csv.gz" for i in range(5)] and r1.rows == 100
    r2 = write_export(df, tmp_root, "E", "20250101", shards=2)
    assert _visible(files.local_path(r2.path)) == [f"E_20250101-{i:012d}.csv.gz" for i in range(2)]
    assert not [n for n in os.listdir(f"{tmp_root}/E") if n.startswith("_stage")]
    assert read_export(spark, r2.path, df.schema).count() == 100


def test_empty_export_writes_header_only_file(spark, tmp_root):
    df = spark.range(0).withColumnRenamed("id", "x")
    r = write_export(df, tmp_root, "E", "20250101")
    assert r.rows == 0 and len(r.files) == 1
    assert read_export(spark, r.path, df.schema).count() == 0


@pytest.mark.parametrize("fmt,codec,ext", [("JSON", "NONE", "json"), ("PARQUET", "SNAPPY", "parquet.snappy"),
                                           ("CSV", "SNAPPY", "csv.snappy")])
def test_other_formats(spark, tmp_root, fmt, codec, ext):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    r = write_export(ev, tmp_root, "EV", "20250101", fmt, codec, shards=2)
    assert all(n.endswith("." + ext) for n in r.files)
    back = read_export(spark, r.path, ev.schema, fmt)
    assert back.exceptAll(ev).count() == 0 and ev.exceptAll(back).count() == 0


def test_partitioned_export_layout(spark, tmp_root):
    df = spark.createDataFrame([(i, f"2025010{i % 3 + 1}") for i in range(30)], "x int, folder_date string")
    res = write_partitioned_export(df, tmp_root, "B", shards_per_date=2)
    assert [r.folder_date for r in res] == ["20250101", "20250102", "20250103"]
    assert _visible(f"{tmp_root}/B") == ["20250101", "20250102", "20250103"]
    for r in res:
        assert r.files == [f"B_{r.folder_date}-{i:012d}.csv.gz" for i in range(len(r.files))]


def test_backfill_generic(spark, tmp_root):
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").createOrReplaceTempView("orders")
    spec = ExportSpec("D", "SELECT * FROM orders WHERE DATE(o_orderdate) = :ds")
    res = jobs.backfill(spark, spec, "1998-06-02", "1998-06-04", tmp_root)
    assert [r.folder_date for r in res] == ["19980602", "19980603", "19980604"]
    o = spark.table("orders")
    for r in res:
        day = (dt.datetime.strptime(r.folder_date, "%Y%m%d") - dt.timedelta(days=1)).date()
        expected = o.where(F.to_date("o_orderdate") == F.lit(day)).count()
        assert read_export(spark, r.path, o.schema).count() == expected


def test_backfill_writes_empty_days(spark, tmp_root):
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").createOrReplaceTempView("orders")
    spec = ExportSpec("D", "SELECT * FROM orders WHERE DATE(o_orderdate) = :ds AND o_orderkey < 0")
    res = jobs.backfill(spark, spec, "1998-06-02", "1998-06-03", tmp_root)
    assert [(r.folder_date, len(r.files)) for r in res] == [("19980602", 1), ("19980603", 1)]
    assert _visible(f"{tmp_root}/D") == ["19980602", "19980603"]


# ------------------------------------------------------------------ delivery --

def _exported(spark, root, n=3):
    df = spark.range(300).withColumnRenamed("id", "x")
    return write_export(df, root, "E", "20250101", shards=n)


def test_deliver_parallel_and_verify(spark, tmp_root):
    res = _exported(spark, f"{tmp_root}/src")
    target = f"{tmp_root}/land"
    log = deliver(work_list(list_objects(spark, f"{tmp_root}/src")), target, workers=3)
    assert log.where("status = 'ok' AND source_size = target_size").count() == 3
    assert _visible(target) == res.files
    c = delivery_counts(log).first()
    assert (c["attempted"], c["succeeded"], c["failed"], c["attempts"]) == (3, 3, 0, 3)
    # a second delivery replaces the files in place
    deliver(work_list(list_objects(spark, f"{tmp_root}/src")), target)
    assert _visible(target) == res.files


def test_deliver_uri_no_files_is_an_error(spark, tmp_root):
    os.makedirs(f"{tmp_root}/src/E/20250101")
    with pytest.raises(FileNotFoundError):
        deliver_uri(spark, f"{tmp_root}/src", "E/20250101/", f"{tmp_root}/land", "E")


def test_deliver_uri_destination_label(spark, tmp_root):
    _exported(spark, f"{tmp_root}/src", n=1)
    r = deliver_uri(spark, f"{tmp_root}/src", "E/20250101/", f"{tmp_root}/land", "E")
    assert r.files_transferred == 1 and r.destination == f"{tmp_root}/land/E_20250101-000000000000.csv.gz"
    _exported(spark, f"{tmp_root}/src2", n=2)
    r = deliver_uri(spark, f"{tmp_root}/src2", "E/20250101/*.csv.gz", f"{tmp_root}/land2", "E")
    assert r.files_transferred == 2 and r.destination == f"{tmp_root}/land2/"


def _block(target, name):
    os.makedirs(f"{target}/{name}")
    with open(f"{target}/{name}/.keep", "w") as f:
        f.write("x")


def test_partial_failure_raises_after_trying_all(spark, tmp_root):
    res = _exported(spark, f"{tmp_root}/src")
    target = f"{tmp_root}/land"
    _block(target, res.files[1])
    with pytest.raises(DeliveryError, match="1 of 3") as err:
        deliver(work_list(list_objects(spark, f"{tmp_root}/src")), target, policy=NO_WAIT)
    log = {r["filename"]: r for r in err.value.log.collect()}
    assert log[res.files[1]]["status"] == "failed" and log[res.files[1]]["attempts"] == 3
    assert log[res.files[0]]["status"] == "ok" and log[res.files[2]]["status"] == "ok"


def test_missing_source_is_not_retried(spark, tmp_root):
    work = spark.createDataFrame([(f"{tmp_root}/nope.csv", "nope.csv", None)], "source_uri string, filename string, size bigint")
    log = deliver(work, f"{tmp_root}/land", policy=NO_WAIT, raise_on_failure=False).first()
    assert log["status"] == "failed" and log["attempts"] == 1 and "no such source" in log["error"]


def test_ordered_mode_stops_at_first_failure(spark, tmp_root):
    res = _exported(spark, f"{tmp_root}/src", n=4)
    target = f"{tmp_root}/land"
    _block(target, res.files[1])
    log = deliver(work_list(list_objects(spark, f"{tmp_root}/src")), target, mode="ordered", workers=1,
                  policy=NO_WAIT, raise_on_failure=False)
    status = [r["status"] for r in log.orderBy("filename").collect()]
    assert status == ["ok", "failed", "skipped", "skipped"]


def test_missing_list_and_retry(spark, tmp_root):
    res = _exported(spark, f"{tmp_root}/src")
    target = f"{tmp_root}/land"
    deliver(work_list(list_objects(spark, f"{tmp_root}/src")), target)
    os.remove(f"{target}/{res.files[0]}")
    src = list_objects(spark, f"{tmp_root}/src")
    missing = jobs.find_missing(src, list_flat(spark, target))
    lst = write_uri_list(missing, f"{tmp_root}/missing")
    log = retry_from_list(spark, lst, target, policy=NO_WAIT)
    assert [(r["filename"], r["status"]) for r in log.collect()] == [(res.files[0], "ok")]
    assert _visible(target) == res.files


def test_run_pipeline_isolates_failures(spark, tmp_root):
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").createOrReplaceTempView("orders")
    specs = [ExportSpec("good", "SELECT * FROM orders WHERE o_orderpriority = '1-URGENT'"),
             ExportSpec("bad", "SELECT * FROM no_such_table"),
             ExportSpec("skip", "SELECT 1")]
    out = jobs.run_pipeline(spark, specs, Interval.ending("1998-06-08"), f"{tmp_root}/src", f"{tmp_root}/land",
                            overrides={"skip": ""}, shards=2)
    rows = {r["export_name"]: r for r in out.collect()}
    assert set(rows) == {"good", "bad"}
    assert rows["good"]["outcome"] == "ok" and rows["good"]["in_sync"] and rows["good"]["files_delivered"] == 2
    assert rows["bad"]["outcome"] == "error" and len(rows["bad"]["error"]) > 200
    assert rows["bad"]["message"] == rows["bad"]["error"][:200]


def test_failed_write_leaves_previous_export_and_no_stage(spark, tmp_root):
    df = spark.range(10).withColumnRenamed("id", "x")
    first = write_export(df, tmp_root, "E", "20250101", shards=2)
    bad = spark.range(10).selectExpr("raise_error('boom') AS x")
    with pytest.raises(Exception, match="boom"):
        write_export(bad, tmp_root, "E", "20250101", shards=2)
    assert _visible(files.local_path(first.path)) == first.files
    assert not [n for n in os.listdir(f"{tmp_root}/E") if n.startswith("_stage")]


def test_retried_attempt_removes_earlier_temp(tmp_root):
    from parcel.operators.deliver import _copy_file, _temp_name

    os.makedirs(f"{tmp_root}/land")
    with open(f"{tmp_root}/src.csv", "wb") as f:
        f.write(b"payload")
    stale = _temp_name(f"{tmp_root}/land", "job1", 3, 0, "src.csv")
    with open(stale, "wb") as f:  # what a lost attempt 0 left behind
        f.write(b"pay")
    sizes = _copy_file(f"{tmp_root}/src.csv", f"{tmp_root}/land", "src.csv", "job1", 3, 1)
    assert sizes == (7, 7)
    assert os.listdir(f"{tmp_root}/land") == ["src.csv"]


def test_shard_names_follow_the_writing_order(spark, tmp_root):
    df = spark.range(200).withColumnRenamed("id", "x")
    r = write_export(df, tmp_root, "M", "20250101", shards=7)
    assert _visible(files.local_path(r.path)) == [f"M_20250101-{i:012d}.csv.gz" for i in range(7)]
    assert read_export(spark, r.path, df.schema).count() == 200
    assert _visible(f"{tmp_root}/M") == ["20250101"]


@pytest.mark.parametrize("partitioned", [False, True])
@pytest.mark.parametrize("failing", [1, 2])
def test_failed_move_leaves_the_earlier_export(spark, tmp_root, monkeypatch, partitioned, failing):
    import parcel.sinks.publish as X

    df = spark.range(10).selectExpr("id AS x")
    first = write_export(df, tmp_root, "E", "20250101", shards=3)
    moves, calls = X._move, []

    def broken(spark_, pairs):
        calls.append(pairs)
        if len(calls) == failing:  # 1: the earlier shards aside, 2: the new ones in
            moves(spark_, pairs[:1])
            raise OSError("move failed")
        moves(spark_, [(a, b) for a, b in pairs if files.exists(a) or files.exists(b)])

    monkeypatch.setattr(X, "_move", broken)
    more = spark.range(50).selectExpr("id AS x")
    with pytest.raises(OSError, match="move failed"):
        if partitioned:
            write_partitioned_export(more.withColumn("folder_date", F.lit("20250101")), tmp_root, "E")
        else:
            write_export(more, tmp_root, "E", "20250101", shards=2)
    assert _visible(files.local_path(first.path)) == first.files
    assert sorted(r["x"] for r in read_export(spark, first.path, df.schema).collect()) == list(range(10))
    assert _visible(f"{tmp_root}/E") == ["20250101"]


def test_overwrite_can_be_refused(spark, tmp_root):
    df = spark.range(3).selectExpr("id AS x")
    write_export(df, tmp_root, "E", "20250101", overwrite=False)
    with pytest.raises(FileExistsError):
        write_export(df, tmp_root, "E", "20250101", overwrite=False)


def test_backfilled_dates_have_row_counts(spark, tmp_root):
    df = spark.range(5).selectExpr("id AS x", "CASE WHEN id < 2 THEN '20250101' ELSE '20250102' END AS folder_date")
    res = write_partitioned_export(df, tmp_root, "B", expected_dates=["20250101", "20250102", "20250103"])
    assert [(r.folder_date, r.rows) for r in res] == [("20250101", 2), ("20250102", 3), ("20250103", 0)]


def test_backfill_scans_once(spark, tmp_root):
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").createOrReplaceTempView("orders")
    spec = ExportSpec("D", "SELECT * FROM orders WHERE o_orderdate >= :data_interval_start AND o_orderdate < :data_interval_end")
    by_scan = {r.folder_date: r.rows for r in jobs.backfill(spark, spec, "1998-06-01", "1998-07-30", f"{tmp_root}/a", date_column="o_orderdate")}
    assert len(by_scan) == 60
    few = jobs.backfill(spark, spec, "1998-06-01", "1998-06-03", f"{tmp_root}/b")
    assert {r.folder_date: r.rows for r in few} == {d: by_scan[d] for d in ("19980601", "19980602", "19980603")}


def test_short_copy_is_an_error(tmp_root, monkeypatch):
    import parcel.operators.deliver as D

    os.makedirs(f"{tmp_root}/land")
    with open(f"{tmp_root}/src.csv", "wb") as f:
        f.write(b"payload")
    whole = D.files.resolve

    class Short:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def open_input_stream(self, path, compression=None):
            import io

            return io.BytesIO(b"pay")

    monkeypatch.setattr(D.files, "resolve", lambda uri: (Short(whole(uri)[0]), whole(uri)[1]))
    with pytest.raises(OSError, match="7 bytes, its copy 3"):
        D._copy_file(f"{tmp_root}/src.csv", f"{tmp_root}/land", "src.csv", "j", 0, 0)
    assert os.listdir(f"{tmp_root}/land") == []


def test_verify_names_are_complete(spark, tmp_root):
    for i in range(50):
        os.makedirs(f"{tmp_root}/src/E", exist_ok=True)
        with open(f"{tmp_root}/src/E/f{i:02d}.csv", "w") as f:
            f.write("x")
    os.makedirs(f"{tmp_root}/land")
    with open(f"{tmp_root}/land/other.csv", "w") as f:
        f.write("x")
    names = jobs.verify_names(spark, f"{tmp_root}/src", "E/", f"{tmp_root}/land").collect()
    assert sum(r["state"] == "missing" for r in names) == 50 and [r["filename"] for r in names if r["state"] == "extra"] == ["other.csv"]


def test_same_basename_last_key_wins_on_delivery(spark, tmp_root):
    for folder, payload in (("d1", b"first"), ("d2", b"second-and-longer")):
        os.makedirs(f"{tmp_root}/src/E/{folder}", exist_ok=True)
        with open(f"{tmp_root}/src/E/{folder}/f.csv", "wb") as f:
            f.write(payload)
    src = list_objects(spark, f"{tmp_root}/src")
    log = deliver(work_list(src), f"{tmp_root}/land", workers=4)
    assert sorted(r["status"] for r in log.collect()) == ["ok", "superseded"]
    with open(f"{tmp_root}/land/f.csv", "rb") as f:
        assert f.read() == b"second-and-longer"
    from parcel.operators.reconcile import verdict

    v = verdict(src, list_flat(spark, f"{tmp_root}/land"), label="E").first()
    assert v["in_sync"]


def test_earlier_temps_kept_when_attempts_may_overlap(tmp_root):
    from parcel.operators.deliver import _copy_file, _temp_name

    os.makedirs(f"{tmp_root}/land")
    with open(f"{tmp_root}/src.csv", "wb") as f:
        f.write(b"payload")
    live = _temp_name(f"{tmp_root}/land", "job2", 0, 0, "src.csv")
    with open(live, "wb") as f:  # a speculative twin still writing
        f.write(b"pay")
    _copy_file(f"{tmp_root}/src.csv", f"{tmp_root}/land", "src.csv", "job2", 0, 1, clean_earlier=False)
    assert sorted(os.listdir(f"{tmp_root}/land")) == sorted([os.path.basename(live), "src.csv"])


def test_run_pipeline_reports_unwritable_landing_per_export(spark, tmp_root):
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").createOrReplaceTempView("orders")
    with open(f"{tmp_root}/land", "w") as f:  # a file where the landing folder should be
        f.write("x")
    specs = [ExportSpec("a", "SELECT * FROM orders WHERE o_orderpriority = '1-URGENT'"),
             ExportSpec("b", "SELECT * FROM orders WHERE o_orderpriority = '2-HIGH'")]
    out = jobs.run_pipeline(spark, specs, Interval.ending("1998-06-08"), f"{tmp_root}/src", f"{tmp_root}/land")
    rows = {r["export_name"]: r for r in out.collect()}
    assert {n: r["outcome"] for n, r in rows.items()} == {"a": "error", "b": "error"}
    assert all(r["rows_exported"] > 0 and r["error"] for r in rows.values())
