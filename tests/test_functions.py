import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from parcel.functions import params, paths, sizes
from parcel.functions.params import (
    ExportSpec,
    Interval,
    file_extension,
    resolve_placeholders,
    shard_name,
)


# ------------------------------------------------------------ parameters --

def test_placeholders_all_six_and_unknown_kept():
    iv = Interval(dt.datetime(2025, 1, 8, 6, 0, 0), dt.datetime(2025, 1, 9, 6, 0, 0))
    q = "{ds}|{ds_nodash}|{date}|{date_dash}|{data_interval_start}|{data_interval_end}|{x}"
    assert resolve_placeholders(q, iv) == (
        "2025-01-08|20250108|20250108|2025-01-08|2025-01-08 06:00:00|2025-01-09 06:00:00|{x}"
    )


def test_zoned_interval_drops_time_zone_in_text():
    tz = dt.timezone(dt.timedelta(hours=2))
    iv = Interval(dt.datetime(2025, 1, 8, tzinfo=tz), dt.datetime(2025, 1, 9, tzinfo=tz))
    assert resolve_placeholders("{data_interval_end}", iv) == "2025-01-09 00:00:00"
    assert iv.sql_args()["data_interval_end"] == dt.datetime(2025, 1, 9)


def test_folder_date_is_interval_end():
    iv = Interval.of("2025-01-08")
    assert iv.ds_nodash == "20250108"
    assert iv.folder_date == "20250109"


@pytest.mark.parametrize("fmt,codec,ext", [
    ("CSV", "GZIP", "csv.gz"), ("csv", "snappy", "csv.snappy"),
    ("PARQUET", "SNAPPY", "parquet.snappy"), ("JSON", "NONE", "json"), ("CSV", "DEFLATE", "csv"),
])
def test_file_extension(fmt, codec, ext):
    assert file_extension(fmt, codec) == ext


def test_shard_name_is_twelve_digits():
    assert shard_name("Product", "20260127", 0, "csv.gz") == "Product_20260127-000000000000.csv.gz"


@pytest.mark.parametrize("bad", ["", "_hidden", ".dot", "a/b"])
def test_export_names_that_listings_would_hide_are_rejected(bad):
    with pytest.raises(ValueError):
        ExportSpec(bad, "SELECT 1")


@pytest.mark.parametrize("override,skipped", [("", True), (None, True), ("SELECT 2", False)])
def test_override_and_skip(override, skipped):
    spec = ExportSpec("a", "SELECT 1").with_override({"a": override})
    assert spec.skipped is skipped
    assert ExportSpec("a", "SELECT 1").with_override({"b": ""}).query == "SELECT 1"


# --------------------------------------------------------------- paths --

def _one(spark, col_expr, value):
    return spark.createDataFrame([(value,)], "v string").select(col_expr(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("uri,bucket,key", [
    ("gs://bucket-name/path/to/file.csv", "bucket-name", "path/to/file.csv"),
    ("gs://bucket-name/file.csv", "bucket-name", "file.csv"),
    ("gs://bucket-name", "bucket-name", ""),
])
def test_split_uri_tolerant(spark, uri, bucket, key):
    r = _one(spark, lambda c: paths.split_uri(c, scheme="gs"), uri)
    assert (r["bucket"], r["key"]) == (bucket, key)


@pytest.mark.parametrize("uri", ["s3://bucket/file.csv", "bucket/file.csv"])
def test_split_uri_rejects_other_schemes(spark, uri):
    with pytest.raises(PySparkException, match="Invalid URI"):
        _one(spark, lambda c: paths.split_uri(c, scheme="gs"), uri)


def test_split_uri_strict_requires_path(spark):
    with pytest.raises(PySparkException, match="Invalid URI format"):
        _one(spark, lambda c: paths.split_uri(c, strict=True, scheme="gs"), "gs://bucket-name")
    r = _one(spark, lambda c: paths.split_uri(c, strict=True, scheme="gs"), "gs://bucket-name/")
    assert (r["bucket"], r["key"]) == ("bucket-name", "")


@pytest.mark.parametrize("name,expected", [
    ("Product_20260127-000000000000.csv.gz", ("Product", "20260127")),
    ("a_20250101-1_20260101-2.csv", ("a_20250101-1", "20260101")),
    ("readme.txt", None),
    ("a_2025-1.csv", None),
])
def test_shard_fields(spark, name, expected):
    r = _one(spark, paths.shard_fields, name)
    assert (None if r is None else (r["export_name"], r["folder_date"])) == expected


def test_basename_and_layout(spark):
    assert _one(spark, paths.basename, "a/20250101/x/f.csv") == "f.csv"
    assert _one(spark, paths.basename, "a/20250101/") == ""
    lay = _one(spark, paths.layout, "a/20250101/x/f.csv")
    assert (lay["export_name"], lay["folder_date"]) == ("a", "20250101")
    assert _one(spark, paths.layout, "a/file.csv") is None


@pytest.mark.parametrize("prefix,pattern,expected", [
    ("a/20250101/*.csv.gz", None, ("a/20250101/", "*.csv.gz")),
    ("a/*/f.csv", "ignored", ("a/", "*/f.csv")),
    ("*.csv", None, ("", "*.csv")),
    ("a/20250101/", "f_?.csv", ("a/20250101/", "f_?.csv")),
    ("a/f_?.csv", None, ("a/f_?.csv", None)),  # '?' alone does not switch globbing on
])
def test_split_listing(prefix, pattern, expected):
    rule = paths.ListingRule.parse(prefix, pattern)
    assert (rule.prefix, rule.glob) == expected


NAMES = ["f_1.csv", "f_0.csv", "F_1.csv", "f_10.csv", "x.csv.gz", "y.CSV.GZ", "f_$.csv",
         "f_+.csv", "a.b", "f_1.csv\n", "[x].csv"]
GLOBS = ["f_?.csv", "f_[!0].csv", "*.csv.gz", "F_*", "f_[0-9]*.csv", "*", "f_+.csv", "[[]x].csv", "*.b"]


@pytest.mark.parametrize("glob", GLOBS)
def test_glob_matches_fnmatchcase(spark, glob):
    import fnmatch

    df = spark.createDataFrame([(n,) for n in NAMES], "filename string")
    got = {r["filename"] for r in df.where(paths.glob_match("filename", glob)).collect()}
    assert got == {n for n in NAMES if fnmatch.fnmatchcase(n, glob)}


def test_target_dir():
    assert paths.target_dir("/uploads/", "20250101", "exp") == "/uploads/20250101/exp"
    assert paths.target_dir("/uploads") == "/uploads"


# --------------------------------------------------------------- sizes --

def _py_format_size(n):
    # the spaced, abs-based ladder (F1)
    v = n
    for unit in ["B", "KB", "MB", "GB", "TB"]:
        if abs(v) < 1024:
            return f"{v:.1f} {unit}"
        v /= 1024
    return f"{v:.1f} PB"


def _py_format_compact(n):
    # the compact ladder (F2)
    v = n
    for unit in ["B", "KB", "MB", "GB", "TB"]:
        if v < 1024:
            return f"{v:.1f}{unit}" if unit != "B" else f"{v}{unit}"
        v /= 1024
    return f"{v:.1f}PB"


EDGE_SIZES = [0, 1, 1023, 1024, 1280, 1331, 2304, 1048575, 1048576, 1310720, 5 * 1024 ** 3 + 256 * 1024 ** 2,
              1024 ** 4, 1024 ** 5, 3 * 1024 ** 5 + 1, -1, -1280, -(1024 ** 2)]


def _check_sizes(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "n bigint")
    rows = df.select("n", sizes.human_size("n").alias("h"), sizes.human_size_compact("n").alias("c")).collect()
    for r in rows:
        assert r["h"] == _py_format_size(r["n"]), r["n"]
        assert r["c"] == _py_format_compact(r["n"]), r["n"]


def test_human_size_edges(spark):
    _check_sizes(spark, EDGE_SIZES)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=-(2 ** 52), max_value=2 ** 52), min_size=50, max_size=200))
def test_human_size_matches_python(spark, values):
    _check_sizes(spark, values)


def test_size_mb_half_even(spark):
    df = spark.createDataFrame([(131072,), (393216,), (0,), (None,)], "n bigint")  # 0.125, 0.375 MiB
    got = [r["m"] for r in df.select(sizes.size_mb("n").alias("m")).collect()]
    assert got == [round(0.125, 2), round(0.375, 2), 0.0, None]


def test_truncate(spark):
    assert _one(spark, lambda c: sizes.truncate(c, 3), "abcdef") == "abc"


def test_interval_timestamps_bind_as_session_wall_clock(spark):
    from parcel.sources.query import run_query

    iv = Interval(dt.datetime(2024, 1, 2, 6, 30), dt.datetime(2024, 1, 3, 6, 30))
    q = "SELECT CAST(:data_interval_start AS TIMESTAMP_NTZ) AS s, :ds AS d"
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        r = run_query(spark, q, iv).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert r["s"] == dt.datetime(2024, 1, 2, 6, 30) and r["d"] == dt.date(2024, 1, 2)


_GLOB_ALPHABET = st.sampled_from(list("ab.*?[]!-_$+^()|\\{}"))
_NAME_ALPHABET = st.sampled_from(list("ab._-$+^()|\\{}[]!*?\n"))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(_GLOB_ALPHABET, min_size=1, max_size=6), min_size=1, max_size=3),
       st.lists(st.text(_NAME_ALPHABET, max_size=6), min_size=5, max_size=30))
def test_glob_translation_matches_fnmatchcase(spark, globs, names):
    import fnmatch
    import re

    df = spark.createDataFrame([(n,) for n in names], "filename string")
    for glob in globs:
        try:
            re.compile(fnmatch.translate(glob))
        except re.error:
            continue
        got = sorted(r["filename"] for r in df.where(paths.glob_match("filename", glob)).collect())
        assert got == sorted(n for n in names if fnmatch.fnmatchcase(n, glob)), glob


def test_three_part_names_run_unchanged(spark):
    from parcel.sources.query import register_view, run_query

    register_view(spark.read.parquet("/root/testdata/sf0.001/orders.parquet"), "proj.sales.orders")
    q = ("SELECT count(*) AS n FROM `proj.sales.orders` WHERE CAST(o_orderdate AS DATE) "
         "BETWEEN date_sub(DATE('{data_interval_end}'), 7) AND DATE('{data_interval_end}')")
    assert run_query(spark, q, Interval.ending("1998-06-08")).first()["n"] == 8


@pytest.mark.parametrize("pattern", ["x[a[]y", "x[]]y", "x[!]a]y", "x[^a]y", "x[a&&b]y", "x[a-c-]y", "x[c-a]y", "x[a", "a.c", "[\\\\]", "*[é]*", "[!c-a]"])
def test_globs_with_odd_sets(spark, pattern):
    import fnmatch

    names = ["xay", "x[y", "x]y", "x&y", "x-y", "xby", "x^y", "xcy", "x[a", "abc", "a.c", "\\", "é", "xy", "x!y", "x\ny", "a"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r.n for r in df.where(paths.glob_match("n", pattern)).collect()}
    assert got == {n for n in names if fnmatch.fnmatchcase(n, pattern)}


@pytest.mark.parametrize("fmt, compression", [("CSV", "LZ4"), ("PARQUET", "DEFLATE"), ("JSON", "zip")])
def test_codecs_are_checked(fmt, compression):
    with pytest.raises(ValueError, match="compression"):
        params.file_extension(fmt, compression)
