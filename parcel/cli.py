"""Command line entry points (``python -m parcel.cli <command>``).

    run      export -> deliver -> verify for every export of a JSON config (P1)
    backfill export every configured export for a range of run dates, one
             Spark job per export (Q8)
    transfer deliver the files of one source URI into a landing folder (D1)
    verify   reconcile one source URI with a landing folder (A5, D11)
    summary  per-export storage summary of a source and/or target area, their
             comparison, as a table or JSON lines (P3, A1, A3, J5, K6)
    missing  files of a source area missing in a target folder, written as a
             sorted URI list (J1, J2, K5)
    retry    re-deliver the URIs of a list into a target folder (D8, A6)
    retention  objects older than N days (default 30) as a URI list; nothing
             is deleted (P4)

Only argument handling lives here; every step is a Spark job from the
library.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from parcel.functions.params import ExportSpec, Interval
from parcel.functions.paths import target_dir
from parcel.operators.deliver import delivery_counts, retry_from_list
from parcel.operators.inventory import for_export, with_layout, with_shard_fields
from parcel.operators.reconcile import extra_on_target
from parcel.operators.summary import storage_summary_with_total
from parcel.plans.jobs import find_missing, report, run_pipeline
from parcel.session import get_session
from parcel.sinks.lists import summary_json, write_uri_list
from parcel.sources.inventory import list_flat, list_objects
from parcel.sources.query import register_tables, register_view


def _specs(path: str) -> list[ExportSpec]:
    """Exports from a JSON file ``{"exports": {name: {query, format?, compression?}}}``."""
    with open(path) as f:
        cfg = json.load(f)
    out = []
    for name, body in cfg.get("exports", {}).items():
        out.append(ExportSpec(name, body.get("query"), body.get("format", "CSV"), body.get("compression", "GZIP")))
    return out


def _overrides(pairs: list[str]) -> dict[str, str | None]:
    out = {}
    for pair in pairs or []:
        name, _, query = pair.partition("=")
        out[name] = query or None
    return out


def cmd_run(spark, args) -> int:
    if args.tables:
        register_tables(spark, args.tables)
    for pair in args.view or []:
        name, _, path = pair.partition("=")
        register_view(spark.read.parquet(path), name)
    interval = Interval.of(args.start, args.end) if args.start else Interval.ending(args.end)
    if args.dry_run:
        # resolved text and Spark's plan for each active export; nothing is written
        from parcel.functions.params import resolve_placeholders
        from parcel.plans.jobs import active_specs
        from parcel.sources.query import run_spec

        for spec in active_specs(_specs(args.config), _overrides(args.override)):
            print(f"-- {spec.name} -> {args.source}/{spec.name}/{interval.folder_date}/ ({spec.extension})")
            print(resolve_placeholders(spec.query, interval))
            run_spec(spark, spec, interval).explain("formatted")
        return 0
    result = run_pipeline(spark, _specs(args.config), interval, args.source, args.target,
                          overrides=_overrides(args.override), deliver_mode=args.mode, workers=args.workers)
    rows = result.collect()  # one row per export
    for r in rows:
        print(json.dumps(r.asDict(), default=str))
    return 0 if all(r["outcome"] == "ok" for r in rows) else 1


def _split_root(uri: str) -> tuple[str, str]:
    """``scheme://bucket/prefix`` -> (``scheme://bucket``, ``prefix``); a
    local path -> (``/``, path without the leading slash)."""
    if "://" in uri:
        scheme, rest = uri.split("://", 1)
        bucket, _, prefix = rest.partition("/")
        return f"{scheme}://{bucket}", prefix
    from parcel.files import local_path

    return "/", local_path(uri).lstrip("/") + ("/" if uri.endswith("/") else "")


def cmd_backfill(spark, args) -> int:
    from parcel.plans.jobs import active_specs, backfill

    if args.tables:
        register_tables(spark, args.tables)
    for pair in args.view or []:
        name, _, path = pair.partition("=")
        register_view(spark.read.parquet(path), name)
    for spec in active_specs(_specs(args.config), _overrides(args.override)):
        for r in backfill(spark, spec, args.first, args.last, args.source, date_column=args.date_column):
            print(json.dumps({"export_name": r.export_name, "folder_date": r.folder_date, "path": r.path,
                              "files": len(r.files), "bytes": r.bytes}))
    return 0


# D11 status contract as exit codes: ok, no files, out of sync, other error.
EXIT_CODES = {"ok": 0, "error": 1, "no_files": 2, "out_of_sync": 3}


def cmd_transfer(spark, args) -> int:
    from parcel.operators.deliver import DeliveryError, deliver_uri

    root, prefix = _split_root(args.uri)
    try:
        r = deliver_uri(spark, root, prefix, args.target, args.export_name, workers=args.workers,
                        mode=args.mode)
    except FileNotFoundError as exc:
        print(json.dumps({"outcome": "no_files", "export_name": args.export_name, "error": str(exc)}))
        return EXIT_CODES["no_files"]
    except DeliveryError as exc:
        print(json.dumps({"outcome": "error", "export_name": args.export_name, "error": str(exc)}))
        return EXIT_CODES["error"]
    print(json.dumps({"outcome": "ok", "export_name": r.export_name, "files_transferred": r.files_transferred,
                      "total_mb": r.total_mb, "destination": r.destination,
                      "total_time_seconds": r.seconds, "source": args.uri}))
    return EXIT_CODES["ok"]


def cmd_verify(spark, args) -> int:
    from parcel.plans.jobs import verify_names, verify_uri

    root, prefix = _split_root(args.uri)
    v = verify_uri(spark, root, prefix, args.target, args.export_name, include_extra=True).first()
    print(json.dumps(v.asDict(recursive=True)))
    if args.names:
        verify_names(spark, root, prefix, args.target).write.json(args.names)
    return EXIT_CODES[v["outcome"]]


def _print_rows(df) -> None:
    """Every row, tab-separated under the column names, streamed."""
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def cmd_summary(spark, args) -> int:
    src = for_export(with_layout(list_objects(spark, args.source)), args.export) \
        if args.source else None
    tgt = for_export(with_shard_fields(list_flat(spark, args.target)), args.export) if args.target else None
    s, t, cmp = report(src, tgt)
    if args.json:
        parts = [p for p in (summary_json(s, "source") if s is not None else None,
                             summary_json(t, "target") if t is not None else None) if p is not None]
        for p in parts:
            for r in p.orderBy("export_name").collect():  # one row per export
                print(json.dumps(r.asDict()))
        return 0
    for side in (src, tgt):
        if side is not None:
            _print_rows(storage_summary_with_total(side).orderBy(F.col("num_dates").isNull(), "export_name"))
    if cmp is not None:
        _print_rows(cmp.orderBy("export_name"))
    return 0


def cmd_missing(spark, args) -> int:
    src = list_objects(spark, args.source, args.prefix or "")
    tgt = list_flat(spark, target_dir(args.target, args.date, args.export_name))
    missing = find_missing(src, tgt)
    write_uri_list(missing, args.out)
    counts = {
        "source_files": src.select("filename").distinct().count(),
        "target_files": tgt.count(),
        "missing_on_target": missing.count(),
        "extra_on_target": extra_on_target(src, tgt).count(),
        "missing_list": args.out,
    }
    print(json.dumps(counts))
    return 0


def cmd_retry(spark, args) -> int:
    log = retry_from_list(spark, args.list, target_dir(args.target, args.date, args.export_name),
                          workers=args.workers)
    c = delivery_counts(log).first()
    print(json.dumps(c.asDict()))
    return 0 if c["failed"] == 0 else 1


def cmd_retention(spark, args) -> int:
    import datetime as dt

    from parcel.functions.paths import location
    from parcel.operators.inventory import retention_candidates

    as_of = args.as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat(timespec="seconds")
    old = retention_candidates(list_objects(spark, args.source, args.prefix or ""),
                               as_of, days=args.days)
    listed = old.select(location("bucket", "key").alias("uri"), "size", "age_days")
    if args.out:
        write_uri_list(listed, args.out)
    c = listed.agg(F.count(F.lit(1)).alias("objects"), F.sum(F.coalesce("size", F.lit(0))).alias("bytes")).first()
    print(json.dumps({"objects": c["objects"], "bytes": c["bytes"] or 0, "days": args.days, "as_of": as_of,
                      "list": args.out}))
    return 0


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="parcel")
    sub = p.add_subparsers(dest="command", required=True)

    r = sub.add_parser("run", help="export, deliver and verify every configured export")
    r.add_argument("--config", required=True, help="JSON file with an 'exports' object")
    r.add_argument("--end", required=True, help="interval end (date or datetime); folder date")
    r.add_argument("--start", help="interval start (default: one day before --end)")
    r.add_argument("--source", required=True, help="export root (shared storage)")
    r.add_argument("--target", required=True, help="landing folder")
    r.add_argument("--tables", help="folder of <table>.parquet files to expose as views")
    r.add_argument("--view", action="append", help="NAME=PARQUET_PATH; dotted names such as proj.ds.table work")
    r.add_argument("--override", action="append", help="NAME=QUERY; an empty QUERY skips the export")
    r.add_argument("--mode", default="parallel", choices=["parallel", "ordered"])
    r.add_argument("--workers", type=int)
    r.add_argument("--dry-run", action="store_true", help="print resolved queries and plans only")
    r.set_defaults(fn=cmd_run)

    b = sub.add_parser("backfill", help="export a range of run dates, one job per export")
    b.add_argument("--config", required=True)
    b.add_argument("--first", required=True, help="first run end date (folder date)")
    b.add_argument("--last", required=True, help="last run end date (folder date)")
    b.add_argument("--source", required=True, help="export root")
    b.add_argument("--tables")
    b.add_argument("--view", action="append")
    b.add_argument("--override", action="append")
    b.add_argument("--date-column", help="column on which the queries select their interval: one scan for all dates")
    b.set_defaults(fn=cmd_backfill)

    tr = sub.add_parser("transfer", help="deliver the files of one source URI")
    tr.add_argument("--uri", required=True, help="scheme://bucket/prefix[/glob] or a local folder")
    tr.add_argument("--target", required=True)
    tr.add_argument("--export-name", required=True)
    tr.add_argument("--mode", default="parallel", choices=["parallel", "ordered"])
    tr.add_argument("--workers", type=int)
    tr.set_defaults(fn=cmd_transfer)

    ve = sub.add_parser("verify", help="reconcile one source URI with a landing folder")
    ve.add_argument("--uri", required=True)
    ve.add_argument("--target", required=True)
    ve.add_argument("--export-name", required=True)
    ve.add_argument("--names", help="folder for the complete lists (JSON lines: every name with its state)")
    ve.set_defaults(fn=cmd_verify)

    s = sub.add_parser("summary", help="storage summary of a source and/or target area")
    s.add_argument("--source", help="export root (layout export/date/file)")
    s.add_argument("--target", help="flat landing folder (shard-named files)")
    s.add_argument("--export", help="only this export")
    s.add_argument("--json", action="store_true")
    s.set_defaults(fn=cmd_summary)

    m = sub.add_parser("missing", help="list source files missing in the target folder")
    m.add_argument("--source", required=True)
    m.add_argument("--prefix")
    m.add_argument("--target", required=True)
    m.add_argument("--date")
    m.add_argument("--export-name")
    m.add_argument("--out", required=True, help="folder for the sorted URI list")
    m.set_defaults(fn=cmd_missing)

    t = sub.add_parser("retry", help="re-deliver the files of a URI list")
    t.add_argument("--list", required=True)
    t.add_argument("--target", required=True)
    t.add_argument("--date")
    t.add_argument("--export-name")
    t.add_argument("--workers", type=int)
    t.set_defaults(fn=cmd_retry)
    rt = sub.add_parser("retention", help="objects older than N days (listed, never deleted)")
    rt.add_argument("--source", required=True)
    rt.add_argument("--prefix")
    rt.add_argument("--days", type=int, default=30)
    rt.add_argument("--as-of", help="reference time (default: now, UTC)")
    rt.add_argument("--out", help="folder for the sorted URI list")
    rt.set_defaults(fn=cmd_retention)
    return p


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    spark = get_session()
    return args.fn(spark, args)


if __name__ == "__main__":
    sys.exit(main())
