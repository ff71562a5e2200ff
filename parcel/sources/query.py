"""The query source. An export's SQL runs in Spark SQL over temp views or
catalog tables; interval values bind as typed named parameters."""

from __future__ import annotations

import datetime as dt
import os
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession

from parcel.functions.params import ExportSpec, Interval, resolve_placeholders

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def register_tables(spark: SparkSession, root: str, names=None) -> dict[str, DataFrame]:
    """Expose ``<root>/<name>.parquet`` as temp views named ``<name>``; without
    ``names``, every ``*.parquet`` entry of ``root`` is registered."""
    if names is None:
        from parcel import files

        names = sorted(i.base_name[: -len(".parquet")] for i in files.list_dir(root)
                       if i.base_name.endswith(".parquet") and not i.base_name.startswith(("_", ".")))
    out = {}
    for name in names:
        path = os.path.join(root, f"{name}.parquet") if "://" not in root else f"{root}/{name}.parquet"
        df = spark.read.parquet(path)
        df.createOrReplaceTempView(name)
        out[name] = df
    return out


def register_view(df: DataFrame, name: str) -> None:
    """Expose ``df`` under ``name`` for export queries. A dotted name such as
    ``project.dataset.table`` is registered as one quoted identifier, so a
    query reading ``FROM `project.dataset.table``` runs unchanged."""
    if "." in name and not name.startswith("`"):
        name = "`" + name.replace("`", "``") + "`"
    df.createOrReplaceTempView(name)


def _session_zone(spark: SparkSession) -> dt.tzinfo:
    name = spark.conf.get("spark.sql.session.timeZone")
    try:
        return ZoneInfo(name)
    except (KeyError, ValueError):
        # offsets such as "+08:00" or "GMT+8"
        text = name.upper().removeprefix("GMT").removeprefix("UTC") or "+00:00"
        sign = -1 if text.startswith("-") else 1
        hours, _, minutes = text.lstrip("+-").partition(":")
        return dt.timezone(sign * dt.timedelta(hours=int(hours), minutes=int(minutes or 0)))


def run_query(spark: SparkSession, query: str, interval: Interval | None = None) -> DataFrame:
    """Run ``query`` for ``interval``.

    Two parameter styles are accepted and may be mixed: the six ``{name}``
    text placeholders (replaced literally), and Spark named parameter markers
    ``:ds``, ``:data_interval_end``, ... bound with their SQL types. The result
    is a lazy DataFrame; Catalyst pushes the interval predicates to the scan.
    """
    if interval is None:
        return spark.sql(query)
    text = resolve_placeholders(query, interval)
    zone = _session_zone(spark)
    args = {}
    for k, v in interval.sql_args().items():
        if f":{k}" not in text:
            continue
        if isinstance(v, dt.datetime) and v.tzinfo is None:
            # bind the wall-clock value in the session zone, whatever the
            # driver machine's local zone is
            v = v.replace(tzinfo=zone)
        args[k] = v
    return spark.sql(text, args=args) if args else spark.sql(text)


def run_spec(spark: SparkSession, spec: ExportSpec, interval: Interval) -> DataFrame:
    if spec.skipped:
        raise ValueError(f"export {spec.name!r} has no query (skipped)")
    return run_query(spark, spec.query, interval)
