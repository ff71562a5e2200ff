"""Byte ranges, the ledger, the stop marker, repeated lines."""

import os

import pytest

import parcel.operators.deliver as D
from parcel.operators.deliver import RetryPolicy, deliver, delivery_counts, read_ledger, retry_from_list, work_list
from parcel.sources.inventory import list_objects

NO_WAIT = RetryPolicy(attempts=2, wait_min=0.0, wait_max=0.0)


def _write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def _read(path):
    with open(path, "rb") as f:
        return f.read()


def test_large_files_go_in_ranges(spark, tmp_root):
    sizes = {"a.bin": 100_000, "b.bin": 999, "c.bin": 1000, "d.bin": 1001, "e.bin": 0}
    for name, n in sizes.items():
        _write(f"{tmp_root}/src/{name}", os.urandom(n))
    log = deliver(work_list(list_objects(spark, f"{tmp_root}/src")), f"{tmp_root}/land", part_bytes=1000, workers=3)
    got = {r["filename"]: r for r in log.collect()}
    assert {k: (r["status"], r["source_size"], r["target_size"]) for k, r in got.items()} == {k: ("ok", n, n) for k, n in sizes.items()}
    assert got["a.bin"]["attempts"] == 100 and log.count() == 5
    assert sorted(os.listdir(f"{tmp_root}/land")) == sorted(sizes)
    assert all(_read(f"{tmp_root}/src/{n}") == _read(f"{tmp_root}/land/{n}") for n in sizes)


def test_a_failed_range_fails_its_file(spark, tmp_root):
    _write(f"{tmp_root}/src/a.bin", os.urandom(5000))
    _write(f"{tmp_root}/src/b.bin", os.urandom(5000))
    _write(f"{tmp_root}/land/a.bin", b"earlier")
    inv = list_objects(spark, f"{tmp_root}/src").collect()
    inv = spark.createDataFrame([{**r.asDict(), "size": 6000 if r["filename"] == "a.bin" else 5000} for r in inv], list_objects(spark, tmp_root).schema)
    log = {r["filename"]: r for r in deliver(work_list(inv), f"{tmp_root}/land", part_bytes=1000, policy=NO_WAIT, raise_on_failure=False).collect()}
    assert log["a.bin"]["status"] == "failed" and "planned" in log["a.bin"]["error"] and log["b.bin"]["status"] == "ok"
    assert _read(f"{tmp_root}/land/a.bin") == b"earlier" and sorted(os.listdir(f"{tmp_root}/land")) == ["a.bin", "b.bin"]


def test_a_range_is_checked_and_repeatable(tmp_root, monkeypatch):
    _write(f"{tmp_root}/s.bin", os.urandom(3000))
    os.makedirs(f"{tmp_root}/land")
    for offset in (2000, 0, 1000, 0):
        assert D._copy_part(f"{tmp_root}/s.bin", f"{tmp_root}/land", "s.bin", "j", offset, 1000, 3000) == (1000, 1000)
    assert D._end_parts(f"{tmp_root}/land", "s.bin", "j", 3000) == 3000
    assert D._end_parts(f"{tmp_root}/land", "s.bin", "j", 3000) == 3000  # again, after a lost executor
    assert _read(f"{tmp_root}/land/s.bin") == _read(f"{tmp_root}/s.bin")
    monkeypatch.setattr(D.os, "pread", lambda *a: b"else")
    with pytest.raises(OSError, match="differ"):
        D._copy_part(f"{tmp_root}/s.bin", f"{tmp_root}/land", "s.bin", "k", 0, 1000, 3000)


def test_ledger_makes_a_second_run_copy_nothing(spark, tmp_root):
    for n in ("a", "b", "c"):
        _write(f"{tmp_root}/src/{n}.csv", n.encode() * 10)
    run = lambda: delivery_counts(deliver(work_list(list_objects(spark, f"{tmp_root}/src")), f"{tmp_root}/land",
                                          ledger=f"{tmp_root}/ledger", policy=NO_WAIT, raise_on_failure=False)).first()
    os.makedirs(f"{tmp_root}/land/b.csv/x")  # can't be replaced
    first = run()
    assert (first["succeeded"], first["failed"], first["unchanged"]) == (2, 1, 0)
    os.rename(f"{tmp_root}/land/b.csv", f"{tmp_root}/elsewhere")
    second, third = run(), run()
    assert (second["succeeded"], second["unchanged"]) == (1, 2) and (third["succeeded"], third["unchanged"], third["attempts"]) == (0, 3, 0)
    _write(f"{tmp_root}/src/a.csv", b"changed since")
    assert run()["succeeded"] == 1 and _read(f"{tmp_root}/land/a.csv") == b"changed since"
    assert read_ledger(spark, f"{tmp_root}/ledger").count() == 4


def test_ledger_of_a_list_without_sizes(spark, tmp_root):
    _write(f"{tmp_root}/src/a.csv", b"x")
    _write(f"{tmp_root}/list/l.txt", f"{tmp_root}/src/a.csv\n{tmp_root}/src/a.csv\n{tmp_root}/src/no.csv\n".encode())
    for n, want in enumerate(((1, 1, 0), (0, 1, 1))):
        got = delivery_counts(retry_from_list(spark, f"{tmp_root}/list", f"{tmp_root}/land", policy=NO_WAIT, ledger=f"{tmp_root}/ledger")).first()
        assert (got["succeeded"], got["failed"], got["unchanged"]) == want and got["attempted"] == 2


def test_a_line_listed_twice_is_one_file(spark, tmp_root):
    _write(f"{tmp_root}/src/a.csv", b"x")
    _write(f"{tmp_root}/list/l.txt", f"{tmp_root}/src/a.csv\n{tmp_root}/src/a.csv\n".encode())
    log = retry_from_list(spark, f"{tmp_root}/list", f"{tmp_root}/land", policy=NO_WAIT)
    assert [(r["status"], r["attempts"]) for r in log.collect()] == [("ok", 1)]


def test_a_failure_stops_all_ranges(tmp_root):
    """A range that finds the marker of another skips what it has left."""
    import pandas as pd

    for n in ("a", "b", "c"):
        _write(f"{tmp_root}/src/{n}.csv", b"x")
    os.makedirs(f"{tmp_root}/land")
    rows = lambda *names: [pd.DataFrame({"source_uri": [f"{tmp_root}/src/{n}.csv" for n in names], "filename": [f"{n}.csv" for n in names],
                                         "size": 1, "offset": None, "length": None})]
    copier = D._copier(f"{tmp_root}/land", NO_WAIT, f"{tmp_root}/failed", "j", True)
    status = lambda *names: list(next(copier(rows(*names)))["status"])
    assert status("a") == ["ok"] and status("no", "b") == ["failed", "skipped"] and status("c") == ["skipped"]
    assert os.listdir(f"{tmp_root}/land") == ["a.csv"]
