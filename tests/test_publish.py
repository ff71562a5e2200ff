"""Publications that fail in both directions, or whose driver is lost."""

import os

import pytest
from pyspark.sql import functions as F

import parcel.sinks.publish as P
from parcel import files
from parcel.sinks.export import read_export, write_export, write_partitioned_export


class DriverLost(BaseException):
    pass


def _export(spark, root, n, shards, partitioned=False):
    df = spark.range(n).selectExpr("id AS x")
    if partitioned:
        return write_partitioned_export(df.withColumn("folder_date", F.lit("20250101")), root, "E", shards_per_date=shards)
    return write_export(df, root, "E", "20250101", shards=shards)


def _rows(spark, root):
    return read_export(spark, f"{root}/E/20250101", spark.range(0).selectExpr("id AS x").schema).count()


def _stages(root):
    return [n for n in os.listdir(f"{root}/E") if n.startswith("_stage")]


def _broken(monkeypatch, fails, error):
    """The moves of these numbers move one file and then fail."""
    moves, calls = P._move, []

    def move(spark, pairs):
        calls.append(pairs)
        if len(calls) in fails:
            moves(spark, pairs[:1])
            raise error("storage is down")
        moves(spark, pairs)

    monkeypatch.setattr(P, "_move", move)


@pytest.mark.parametrize("partitioned", [False, True])
@pytest.mark.parametrize("fails", [{1, 2}, {2, 3}, {2, 4}])
def test_way_back_fails_too(spark, tmp_root, monkeypatch, partitioned, fails):
    _export(spark, tmp_root, 10, 3)
    _broken(monkeypatch, fails, OSError)
    with pytest.raises(P.PublishInterrupted):
        _export(spark, tmp_root, 50, 2, partitioned)
    monkeypatch.undo()
    assert _stages(tmp_root)  # with the only copy of some shards
    assert P.recover(spark, tmp_root, "E") == {"20250101": "earlier"}
    assert _rows(spark, tmp_root) == 10 and len(os.listdir(f"{tmp_root}/E/20250101")) == 3
    assert partitioned or not _stages(tmp_root)


@pytest.mark.parametrize("at", [1, 2])
def test_lost_driver(spark, tmp_root, monkeypatch, at):
    _export(spark, tmp_root, 10, 3)
    _broken(monkeypatch, {at}, DriverLost)
    with pytest.raises(DriverLost):
        _export(spark, tmp_root, 50, 2)
    monkeypatch.undo()
    assert P.recover(spark, tmp_root, "E", ["20250102"]) == {} and _stages(tmp_root)
    assert P.recover(spark, tmp_root, "E") == {"20250101": "new"}
    assert _rows(spark, tmp_root) == 50 and not _stages(tmp_root)
    assert P.recover(spark, tmp_root, "E") == {}


def test_driver_lost_on_the_way_back(spark, tmp_root, monkeypatch):
    _export(spark, tmp_root, 10, 3)
    moves, calls = P._move, []

    def move(spark_, pairs):
        calls.append(pairs)
        if len(calls) >= 2:
            moves(spark_, pairs[:1])
            raise OSError("down") if len(calls) == 2 else DriverLost()
        moves(spark_, pairs)

    monkeypatch.setattr(P, "_move", move)
    with pytest.raises(DriverLost):
        _export(spark, tmp_root, 50, 2)
    monkeypatch.undo()
    assert P.recover(spark, tmp_root, "E") == {"20250101": "earlier"}
    assert _rows(spark, tmp_root) == 10


def test_next_run_recovers_its_date(spark, tmp_root, monkeypatch):
    _export(spark, tmp_root, 10, 3)
    _broken(monkeypatch, {2, 3}, OSError)
    with pytest.raises(P.PublishInterrupted):
        _export(spark, tmp_root, 50, 2)
    monkeypatch.undo()
    with pytest.raises(FileExistsError):  # the earlier shards are back
        write_export(spark.range(1).selectExpr("id AS x"), tmp_root, "E", "20250101", overwrite=False)
    _export(spark, tmp_root, 20, 1)
    assert _rows(spark, tmp_root) == 20 and not _stages(tmp_root)


def test_many_moves_are_a_job(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(P, "DRIVER_MOVES", 1)
    _export(spark, tmp_root, 10, 3)
    _export(spark, tmp_root, 30, 4)
    assert _rows(spark, tmp_root) == 30 and len(os.listdir(f"{tmp_root}/E/20250101")) == 4


def test_plan_is_read_where_it_lies(spark, tmp_root):
    stage = files.join(tmp_root, "E", "_stage-20250101-0123456789ab")
    files.makedirs(stage)
    files.write_whole(files.join(stage, "part-0"), b"x")
    P.Publication.planned(stage, files.join(tmp_root, "E", "20250101"), [("part-0", "E_20250101-0.csv")])
    assert list(P.unfinished(tmp_root, "E")) == ["20250101"]
    assert P.recover(spark, tmp_root, "E") == {"20250101": "new"}
    assert os.listdir(f"{tmp_root}/E/20250101") == ["E_20250101-0.csv"]
