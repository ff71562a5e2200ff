import datetime as dt
import os

from pyspark.sql import functions as F

from parcel.operators import inventory as inv_ops
from parcel.sources.inventory import (
    INVENTORY_SCHEMA,
    filter_objects,
    list_flat,
    list_objects,
    read_uri_list,
)

T0 = dt.datetime(2025, 1, 1)


def _inv(spark, rows):
    return spark.createDataFrame(
        [("gs://b", k, k.rsplit("/", 1)[-1], s, T0) for k, s in rows], INVENTORY_SCHEMA
    )


def _keys(df):
    return sorted(r["key"] for r in df.select("key").collect())


def test_markers_dropped_and_string_prefix(spark):
    inv = _inv(spark, [("exp/20250101/", 0), ("exp/20250101/f.csv", 1), ("exp_old/20250101/g.csv", 2),
                       ("other/x.csv", 3)])
    assert _keys(filter_objects(inv, "exp")) == ["exp/20250101/f.csv", "exp_old/20250101/g.csv"]


def test_glob_on_basename_case_sensitive(spark):
    inv = _inv(spark, [("a/20250101/f_1.csv", 1), ("a/20250101/f_0.csv", 1), ("a/20250101/F_1.csv", 1),
                       ("a/20250101/x.csv.gz", 1)])
    assert _keys(filter_objects(inv, "a/20250101/", "f_[!0].csv")) == ["a/20250101/f_1.csv"]
    assert _keys(filter_objects(inv, "a/20250101/", "f_?.csv")) == ["a/20250101/f_0.csv", "a/20250101/f_1.csv"]


def test_layout_rules(spark):
    inv = _inv(spark, [("a/file.csv", 1), ("a/20250101/x/f.csv", 2), ("a/latest/f.csv", 3)])
    rows = {r["key"]: (r["export_name"], r["folder_date"], r["filename"])
            for r in inv_ops.with_layout(inv).collect()}
    assert rows == {"a/20250101/x/f.csv": ("a", "20250101", "f.csv"), "a/latest/f.csv": ("a", "latest", "f.csv")}


def test_shard_fields_drop_non_matching(spark):
    inv = _inv(spark, [("Product_20260127-000000000000.csv.gz", 1), ("readme.txt", 1), ("a_2025-1.csv", 1)])
    out = inv_ops.with_shard_fields(inv).collect()
    assert [(r["export_name"], r["folder_date"]) for r in out] == [("Product", "20260127")]


def test_listing_order_dirs_first_case_insensitive(spark):
    inv = _inv(spark, [("d/b.csv", 1), ("d/A.csv", 1), ("d/zz/x", 1), ("d/Yy/x", 1), ("d/Yy/z", 1)])
    got = [(r["name"], r["is_dir"]) for r in inv_ops.listing_order(inv, "d").collect()]
    assert got == [("Yy", True), ("zz", True), ("A.csv", False), ("b.csv", False)]


def test_retention_candidates(spark):
    rows = [("gs://b", "a", "a", 1, dt.datetime(2025, 1, 1)), ("gs://b", "b", "b", 1, dt.datetime(2025, 2, 15))]
    inv = spark.createDataFrame(rows, INVENTORY_SCHEMA)
    out = inv_ops.retention_candidates(inv, "2025-03-01", days=30).collect()
    assert [(r["key"], r["age_days"]) for r in out] == [("a", 59)]


def _touch(path, data=b"x"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def test_live_listing(spark, tmp_root):
    _touch(f"{tmp_root}/exp/20250101/exp_20250101-000000000000.csv.gz", b"abc")
    _touch(f"{tmp_root}/exp/20250101/exp_20250101-000000000001.csv.gz", b"abcd")
    _touch(f"{tmp_root}/exp_old/20250101/f.csv", b"a")
    _touch(f"{tmp_root}/exp/_stage-20250101-0123456789ab/part-0", b"hidden")
    inv = list_objects(spark, tmp_root, "exp")
    got = sorted((r["key"], r["size"]) for r in inv.collect())
    assert got == [("exp/20250101/exp_20250101-000000000000.csv.gz", 3),
                   ("exp/20250101/exp_20250101-000000000001.csv.gz", 4),
                   ("exp_old/20250101/f.csv", 1)]
    star = list_objects(spark, tmp_root, "exp/20250101/*1.csv.gz")
    assert [r["filename"] for r in star.collect()] == ["exp_20250101-000000000001.csv.gz"]
    assert list_objects(spark, tmp_root, "exp/*/x.csv").count() == 0


def test_flat_listing_and_missing_dir(spark, tmp_root):
    _touch(f"{tmp_root}/land/a.csv", b"12")
    _touch(f"{tmp_root}/land/sub/b.csv", b"1")
    assert [r["filename"] for r in list_flat(spark, f"{tmp_root}/land").collect()] == ["a.csv"]
    assert list_flat(spark, f"{tmp_root}/nope").count() == 0


def test_uri_list_trims_and_drops_blanks(spark, tmp_root):
    p = f"{tmp_root}/missing.txt"
    with open(p, "w") as f:
        f.write("  gs://b/x/a.csv \n\n   \ngs://b/y/b.csv\n")
    assert [r["uri"] for r in read_uri_list(spark, p).collect()] == ["gs://b/x/a.csv", "gs://b/y/b.csv"]


def test_mtime_is_utc_wall_clock(spark, tmp_root):
    _touch(f"{tmp_root}/t/a.csv")
    os.utime(f"{tmp_root}/t/a.csv", (0, 86400 + 3600))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = list_objects(spark, f"{tmp_root}/t").select(F.col("mtime")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == dt.datetime(1970, 1, 2, 1, 0)


def test_listing_equals_a_walk(spark, tmp_root):
    odd = ["top.txt", "exp0/shallow.txt", "exp1/20250101/.dot.csv", "exp1/20250101/_under.csv", "exp[1]/a b/{x}/f?.csv", "d/e/f/g/h/i.csv",
           "_stage-report.csv", "_stage-data/x.csv", "exp0/.parcel-mine.part", "exp0/_stage-20250101-0123456789ab.csv"]
    for i, name in enumerate(odd):
        _touch(f"{tmp_root}/{name}", b"x" * (i + 1))
    _touch(f"{tmp_root}/exp0/_stage-backfill-0123456789ab/part-0")
    _touch(f"{tmp_root}/exp0/.parcel-0123456789ab-p0-a0-f.csv.part")
    got = {r["key"]: r["size"] for r in list_objects(spark, tmp_root).collect()}
    assert got == {name: i + 1 for i, name in enumerate(odd)}
    assert [r["key"] for r in list_objects(spark, tmp_root, "exp[1]/").collect()] == ["exp[1]/a b/{x}/f?.csv"]
    assert list_objects(spark, tmp_root, "exp1/").count() == 2
    assert list_objects(spark, f"{tmp_root}/nope").count() == 0
    assert sorted(r["key"] for r in list_flat(spark, tmp_root).collect()) == ["_stage-report.csv", "top.txt"]


def test_all_names_are_delivered(spark, tmp_root):
    from parcel.operators.deliver import deliver_uri

    for name in ("a.csv", "_hid.csv", ".dot.csv"):
        _touch(f"{tmp_root}/src/E/{name}")
    r = deliver_uri(spark, f"{tmp_root}/src", "E/", f"{tmp_root}/land", "E")
    assert r.files_transferred == 3 and sorted(os.listdir(f"{tmp_root}/land")) == [".dot.csv", "_hid.csv", "a.csv"]


def test_names_target_exports_and_mb_listing(spark, tmp_root):
    from parcel.sources.inventory import list_names, list_target_exports, list_with_mb

    _touch(f"{tmp_root}/src/e/20250101/e_20250101-000000000000.csv.gz", b"x" * 1310720)  # 1.25 MiB
    _touch(f"{tmp_root}/land/e_20250101-000000000000.csv.gz", b"x")
    _touch(f"{tmp_root}/land/readme.txt", b"x")
    assert [r["filename"] for r in list_names(spark, f"{tmp_root}/src", "e/").collect()] == \
        ["e_20250101-000000000000.csv.gz"]
    got = [(r["export_name"], r["folder_date"]) for r in list_target_exports(spark, f"{tmp_root}/land").collect()]
    assert got == [("e", "20250101")]
    mb = list_with_mb(spark, f"{tmp_root}/src", "e/2025*").collect()
    assert [(r["name"], r["size_mb"]) for r in mb] == [("e/20250101/e_20250101-000000000000.csv.gz", 1.25)]


def test_list_folders_skips_missing_ones(spark, tmp_root):
    from parcel.sources.inventory import list_folders

    _touch(f"{tmp_root}/a/20250101/a_20250101-000000000000.csv.gz", b"1")
    _touch(f"{tmp_root}/b/20250101/b_20250101-000000000000.csv.gz", b"22")
    _touch(f"{tmp_root}/b/20250102/b_20250102-000000000000.csv.gz", b"333")
    inv = list_folders(spark, tmp_root, ["a/20250101/", "b/20250101/", "c/20250101/"])
    assert sorted((r["key"], r["size"]) for r in inv.collect()) == [
        ("a/20250101/a_20250101-000000000000.csv.gz", 1), ("b/20250101/b_20250101-000000000000.csv.gz", 2)]
    assert list_folders(spark, tmp_root, ["nope/"]).count() == 0


def test_a_large_folder_is_listed_in_ranges(spark, tmp_root):
    names = {f"big/n{i * 7919 % 5000:04d}.csv": i % 3 for i in range(5000)} | {"big/sub/x.csv": 1, "small/y.csv": 2}
    for name, size in names.items():
        _touch(f"{tmp_root}/{name}", b"x" * size)
    got = list_objects(spark, tmp_root, split=300)
    assert {r["key"]: r["size"] for r in got.collect()} == names and got.count() == len(names)
    flat = list_flat(spark, f"{tmp_root}/big", split=300)
    assert flat.count() == 5000 and flat.agg(F.sum("size")).first()[0] == sum(names.values()) - 3


def test_ranges_cover_a_folder(tmp_root):
    from parcel.sources.inventory import MOST_RANGES, _ranges

    for i in range(1000):
        _touch(f"{tmp_root}/f/{i}")
    assert _ranges(f"{tmp_root}/f", 1000) is None and _ranges(f"{tmp_root}/nope", 1) is None
    ranges = _ranges(f"{tmp_root}/f", 100)
    assert len(ranges) == 10 and ranges[0][0] is None and ranges[-1][1] is None
    assert all(a[1] == b[0] for a, b in zip(ranges, ranges[1:]))
    held = [sum((lo is None or str(i) >= lo) and (hi is None or str(i) < hi) for i in range(1000)) for lo, hi in ranges]
    assert sum(held) == 1000 and max(held) < 200
    assert len(_ranges(f"{tmp_root}/f", 1)) <= MOST_RANGES


def test_positions_equal_the_sorted_listing(spark):
    rows = [("gs://b", f"d/{n}", n, i, None) for i, n in enumerate(["b.csv", "A.csv", "a.csv", "c.csv"])] + [("gs://b", f"d/{s}/x.csv", "x.csv", 1, None) for s in ("Z", "y")]
    got = inv_ops.listing_positions(spark.createDataFrame(rows, INVENTORY_SCHEMA), "d").orderBy("ordinal").collect()
    assert [r["name"] for r in got] == ["y", "Z", "A.csv", "a.csv", "b.csv", "c.csv"]
    assert [r["ordinal"] for r in got] == list(range(1, 7))
