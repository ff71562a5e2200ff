"""K5 (missing-file list) and K6 (JSON summary) sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcel.operators.summary import SUMMARY_COLUMNS


def write_uri_list(df: DataFrame, path: str, column: str = "uri") -> str:
    """K5: sorted URIs, one per line, as a text folder.

    The sort is a range-partitioned ``orderBy``: part files are each sorted
    and follow each other in order, so reading the folder (S4) or
    concatenating the parts in name order gives the sorted list without any
    single task holding it all.
    """
    df.select(F.col(column).alias("value")).orderBy("value").write.mode("overwrite").text(path)
    return path


def summary_json(summary: DataFrame, side: str) -> DataFrame:
    """K6, row-shaped: one JSON object per export, keyed by side.

    ``side, export_name, stats`` where ``stats`` is the export's summary
    (fields in the reference's order) as a JSON object string.
    """
    fields = [c for c in SUMMARY_COLUMNS if c != "export_name"]
    return summary.select(
        F.lit(side).alias("side"),
        "export_name",
        F.to_json(F.struct(*fields)).alias("stats"),
    )


def write_summary_json(sides: dict[str, DataFrame], path: str) -> str:
    """K6 as files: JSON lines ``{"side": ..., "export_name": ..., "stats":
    {...}}`` for ``{"source": summary, "target": summary}``."""
    out = None
    for side, summary in sides.items():
        fields = F.struct(*[c for c in SUMMARY_COLUMNS if c != "export_name"])
        rows = summary.select(F.lit(side).alias("side"), "export_name", fields.alias("stats"))
        out = rows if out is None else out.unionByName(rows)
    out.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def summary_document(sides: dict[str, DataFrame]) -> DataFrame:
    """K6 as one document: a row with ``document``, the JSON object
    ``{side: {export: stats}}``. A side without exports is an empty object. It
    has a few numbers for each export, not for each file."""
    rows = None
    for side, summary in sides.items():
        stats = F.struct(*[c for c in SUMMARY_COLUMNS if c != "export_name"])
        of_side = summary.select(F.lit(side).alias("side"), F.struct("export_name", stats.alias("stats")).alias("entry"))
        none = summary.sparkSession.range(1).select(F.lit(side).alias("side"), F.lit(None).cast(of_side.schema["entry"].dataType).alias("entry"))
        rows = reduce(DataFrame.unionByName, [x for x in (rows, of_side, none) if x is not None])
    of_sides = rows.groupBy("side").agg(F.map_from_entries(F.sort_array(F.collect_list("entry"))).alias("exports"))
    whole = of_sides.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("side", F.to_json("exports", {"ignoreNullFields": "false"}).alias("json"))))).alias("sides"))
    pairs = F.transform(F.map_entries("sides"), lambda e: F.concat(F.lit('"'), e["key"], F.lit('": '), e["value"]))
    return whole.select(F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}")).alias("document"))


def write_summary_document(sides: dict[str, DataFrame], path: str) -> str:
    """K6 as one text file with the document."""
    summary_document(sides).coalesce(1).write.mode("overwrite").text(path)
    return path


def read_summary_document(spark: SparkSession, path: str) -> DataFrame:
    """The document's rows: ``side, export_name`` and the statistics."""
    stats = "oldest_date string, newest_date string, num_dates bigint, total_files bigint, total_size bigint, avg_files_per_date double, avg_size_per_file double"
    text = spark.read.option("wholetext", "true").text(path)
    sides = text.select(F.explode(F.from_json("value", f"map<string, map<string, struct<{stats}>>>")).alias("side", "exports"))
    return sides.select("side", F.explode("exports").alias("export_name", "stats")).select("side", "export_name", "stats.*")
