import json
import os

from parcel import cli
from parcel.functions.params import shard_name

from table_paths import SF_SMALL


def test_run_summary_missing_retry(spark, tmp_root, capsys):
    cfg = f"{tmp_root}/exports.json"
    with open(cfg, "w") as f:
        json.dump({"exports": {
            "URGENT": {"query": "SELECT * FROM orders WHERE o_orderpriority = '1-URGENT'"},
            "HIGH": {"query": "SELECT * FROM orders WHERE o_orderpriority = '2-HIGH'", "format": "JSON",
                     "compression": "NONE"},
            "LOW": {"query": "SELECT * FROM orders WHERE o_orderpriority = '5-LOW'"},
        }}, f)
    src, land = f"{tmp_root}/src", f"{tmp_root}/land"
    code = cli.main(["run", "--config", cfg, "--end", "1998-06-08", "--source", src, "--target", land,
                     "--tables", SF_SMALL, "--override", "LOW="])
    rows = [json.loads(line) for line in capsys.readouterr().out.splitlines()]
    assert code == 0 and sorted(r["export_name"] for r in rows) == ["HIGH", "URGENT"]
    assert all(r["outcome"] == "ok" and r["in_sync"] for r in rows)

    cli.main(["summary", "--source", src, "--target", land, "--json"])
    out = [json.loads(line) for line in capsys.readouterr().out.splitlines()]
    assert {(r["side"], r["export_name"]) for r in out} == {
        ("source", "URGENT"), ("source", "HIGH"), ("target", "URGENT"), ("target", "HIGH")}

    gone = shard_name("URGENT", "19980608", 0, "csv.gz")
    os.remove(f"{land}/{gone}")
    cli.main(["missing", "--source", src, "--target", land, "--out", f"{tmp_root}/missing"])
    counts = json.loads(capsys.readouterr().out)
    assert counts["missing_on_target"] == 1

    code = cli.main(["retry", "--list", f"{tmp_root}/missing", "--target", land])
    c = json.loads(capsys.readouterr().out)
    assert code == 0 and (c["attempted"], c["succeeded"]) == (1, 1)
    assert os.path.exists(f"{land}/{gone}")


def test_transfer_and_verify_commands(spark, tmp_root, capsys):
    from parcel.sinks.export import write_export

    df = spark.range(50).withColumnRenamed("id", "x")
    r = write_export(df, f"{tmp_root}/src", "E", "20250101", shards=3)
    land = f"{tmp_root}/land"
    uri = f"{tmp_root}/src/E/20250101/"
    assert cli.main(["verify", "--uri", uri, "--target", land, "--export-name", "E"]) == 3
    v = json.loads(capsys.readouterr().out)
    assert v["outcome"] == "out_of_sync" and v["missing_count"] == 3
    assert cli.main(["transfer", "--uri", f"{tmp_root}/src/E/nothing/", "--target", land, "--export-name", "E"]) == 2
    assert json.loads(capsys.readouterr().out)["outcome"] == "no_files"
    assert cli.main(["transfer", "--uri", uri + "*.csv.gz", "--target", land, "--export-name", "E"]) == 0
    t = json.loads(capsys.readouterr().out)
    assert t["files_transferred"] == 3 and t["destination"] == land + "/"
    assert cli.main(["verify", "--uri", uri, "--target", land, "--export-name", "E"]) == 0
    v = json.loads(capsys.readouterr().out)
    assert v["in_sync"] and v["source_sample"] == r.files[:3] and v["extra_count"] == 0


def test_retention_command(spark, tmp_root, capsys):
    for name, age_days in (("old.csv", 40), ("new.csv", 5)):
        path = f"{tmp_root}/src/E/d/{name}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write("x")
        t = 1_700_000_000 - age_days * 86400
        os.utime(path, (t, t))
    as_of = "2023-11-14T22:13:20"  # 1_700_000_000 in UTC
    assert cli.main(["retention", "--source", f"{tmp_root}/src", "--as-of", as_of, "--out", f"{tmp_root}/ret"]) == 0
    out = json.loads(capsys.readouterr().out)
    assert out["objects"] == 1 and out["bytes"] == 1
    lines = [line for f in sorted(os.listdir(f"{tmp_root}/ret")) if f.startswith("part-")
             for line in open(f"{tmp_root}/ret/{f}").read().splitlines()]
    assert lines == [f"file:{tmp_root}/src/E/d/old.csv"]


def test_run_dry_run_writes_nothing(spark, tmp_root, capsys):
    cfg = f"{tmp_root}/exports.json"
    with open(cfg, "w") as f:
        json.dump({"exports": {"URGENT": {"query": "SELECT * FROM orders WHERE DATE(o_orderdate) = '{date_dash}'"}}}, f)
    code = cli.main(["run", "--config", cfg, "--end", "1998-06-08", "--source", f"{tmp_root}/src",
                     "--target", f"{tmp_root}/land", "--tables", SF_SMALL, "--dry-run"])
    out = capsys.readouterr().out
    assert code == 0 and "DATE(o_orderdate) = '1998-06-07'" in out
    assert not os.path.exists(f"{tmp_root}/src") and not os.path.exists(f"{tmp_root}/land")


def test_backfill_command(spark, tmp_root, capsys):
    cfg = f"{tmp_root}/exports.json"
    with open(cfg, "w") as f:
        json.dump({"exports": {"DAILY": {"query": "SELECT * FROM orders WHERE DATE(o_orderdate) = :ds"}}}, f)
    code = cli.main(["backfill", "--config", cfg, "--first", "1998-06-02", "--last", "1998-06-04",
                     "--source", f"{tmp_root}/src", "--tables", SF_SMALL])
    rows = [json.loads(line) for line in capsys.readouterr().out.splitlines()]
    assert code == 0 and [r["folder_date"] for r in rows] == ["19980602", "19980603", "19980604"]
    assert sorted(os.listdir(f"{tmp_root}/src/DAILY")) == ["19980602", "19980603", "19980604"]
