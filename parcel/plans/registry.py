"""Driver queries: one callable per operator group of SURVEY §2, each with
the DuckDB SQL that must give the same rows.

Inventory queries run on inventories derived from the tables
(``fixtures``); the export and delivery queries write real files under the
shared checkpoint folder and return what they read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcel.functions import paths, sizes
from parcel.operators import inventory as inv_ops
from parcel.operators import reconcile, summary
from parcel.plans import fixtures, jobs, live
from parcel.session import scratch_dir
from parcel.sources.inventory import filter_objects
from parcel.sinks.lists import read_summary_document, summary_json, write_summary_document


def _src_raw(spark, sf):
    return fixtures.source_inventory(spark, sf)


def _src(spark, sf):
    """Source objects with layout (markers and shallow keys dropped)."""
    return inv_ops.with_layout(filter_objects(_src_raw(spark, sf)))


def _tgt(spark, sf):
    return fixtures.target_inventory(spark, sf)


# ---------------------------------------------------------------- inventory --

def inventory_layout(spark, sf) -> DataFrame:
    return _src(spark, sf).select("key", "export_name", "folder_date", "filename", "size")


def shard_name_parse(spark, sf) -> DataFrame:
    return inv_ops.with_shard_fields(_tgt(spark, sf)).select("filename", "export_name", "folder_date")


def prefix_and_glob_filter(spark, sf) -> DataFrame:
    raw = _src_raw(spark, sf)
    listed = filter_objects(raw, prefix="MEDIUM/199", glob="MEDIUM_199?06??-*[05].csv.gz")
    return inv_ops.for_export(inv_ops.with_layout(listed), "MEDIUM").select("key", "filename", "size")


def uri_split(spark, sf) -> DataFrame:
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    p = pages.select("page_id", paths.split_uri("url").alias("u"))
    return p.select(
        "page_id",
        F.col("u.scheme").alias("scheme"),
        F.col("u.bucket").alias("host"),
        F.col("u.key").alias("path"),
        paths.object_uri("https", F.col("u.bucket"), F.col("u.key")).alias("https_uri"),
    )


def uri_split_strict(spark, sf) -> DataFrame:
    src = _src(spark, sf)
    uris = src.select(paths.object_uri("gs", F.lit("parcel-src"), F.col("key")).alias("uri"))
    parsed = uris.select("uri", paths.split_uri("uri", strict=True, scheme="gs").alias("u"))
    return parsed.select("uri", F.col("u.bucket").alias("bucket"), F.col("u.key").alias("key"),
                         paths.basename(F.col("u.key")).alias("filename"))


def listing_order(spark, sf) -> DataFrame:
    return inv_ops.listing_positions(filter_objects(_src_raw(spark, sf)), "HIGH")


def human_size(spark, sf) -> DataFrame:
    src = _src(spark, sf)
    scaled = src.select(F.explode(F.array(
        F.col("size"), F.col("size") * 1024, F.col("size") * 1048576, F.col("size") * 1073741824,
    )).alias("size_bytes"))
    return scaled.select("size_bytes", sizes.human_size("size_bytes").alias("human"),
                         sizes.human_size_compact("size_bytes").alias("compact"))


def retention_candidates(spark, sf) -> DataFrame:
    src = filter_objects(_src_raw(spark, sf))
    return inv_ops.retention_candidates(src, "1999-01-01", days=30).select("key", "age_days")


# ---------------------------------------------------------------- reconcile --

def missing_on_target(spark, sf) -> DataFrame:
    return reconcile.missing_on_target(_src(spark, sf), _tgt(spark, sf)).select("filename", "export_name", "size")


def extra_on_target(spark, sf) -> DataFrame:
    return reconcile.extra_on_target(_src(spark, sf), _tgt(spark, sf)).select("filename", "size")


def relevant_target(spark, sf) -> DataFrame:
    return reconcile.relevant_target(_src(spark, sf), _tgt(spark, sf)).select("filename", "size")


def size_mismatch(spark, sf) -> DataFrame:
    return reconcile.size_mismatches(_src(spark, sf), _tgt(spark, sf)).select(
        "filename", "export_name", "source_size", "target_size")


def name_set_ops(spark, sf) -> DataFrame:
    """All four sets from one pass over the names of both sides."""
    sides = reconcile.name_sides(_src(spark, sf), _tgt(spark, sf))
    sets = F.array_compact(F.array(*[F.when(reconcile.name_set(F.col("sides"), op), F.lit(op)) for op in ("missing", "extra", "common", "all")]))
    return sides.select("filename", F.explode(sets).alias("set_op")).groupBy("set_op").agg(
        F.count(F.lit(1)).alias("names"), F.min("filename").alias("first_name"), F.max("filename").alias("last_name"))


VERDICT_COLUMNS = ("export_name", "in_sync", "source_file_count", "target_file_count",
                   "missing_count", "mismatch_count", "no_files_found", "outcome")
CONFIGURED_EXPORTS = ("URGENT", "HIGH", "MEDIUM", "NOT_SPECIFIED", "LOW", "ARCHIVE")


def sync_verdict(spark, sf) -> DataFrame:
    v = reconcile.verdict(_src(spark, sf), _tgt(spark, sf), exports=list(CONFIGURED_EXPORTS))
    return v.select(*VERDICT_COLUMNS)


def sync_verdict_empty(spark, sf) -> DataFrame:
    src = inv_ops.for_export(_src(spark, sf), "ARCHIVE")
    return reconcile.verdict(src, _tgt(spark, sf), label="ARCHIVE").select(*VERDICT_COLUMNS)


def sync_verdict_global(spark, sf) -> DataFrame:
    src = _src(spark, sf).drop("export_name")
    v = reconcile.verdict(src, _tgt(spark, sf), label="ALL", include_extra=True)
    return v.select(*VERDICT_COLUMNS, "extra_count")


def sync_verdict_large(spark, sf) -> DataFrame:
    """A5 over one object per lineitem row, a third of them in one export:
    counts and the first missing names per export under a hot key."""
    src, tgt = fixtures.large_inventories(spark, sf)
    v = reconcile.verdict(inv_ops.with_layout(src), tgt)
    return v.select(*VERDICT_COLUMNS, F.array_join("missing_sample", "|").alias("missing_sample"))


def _shared_names(df: DataFrame) -> DataFrame:
    """The same file names in every export: the export's part of a name goes."""
    return df.withColumn("filename", F.regexp_replace("filename", "^[A-Z_]+_([0-9]{8}-)", "data_$1"))


def sync_verdict_shared_names(spark, sf) -> DataFrame:
    """A5 where all exports hold the same file names."""
    return reconcile.verdict(_shared_names(_src(spark, sf)), _shared_names(_tgt(spark, sf))).select(*VERDICT_COLUMNS)


def verify_names_full(spark, sf) -> DataFrame:
    """A5 / O1: every name of both sides with its state."""
    s, t = _src(spark, sf), _tgt(spark, sf)
    known = reconcile.classify(s, t).select("filename", "export_name", "source_size", "target_size", "state")
    extra = reconcile.extra_on_target(s, t).select("filename", F.col("size").alias("target_size"), F.lit("extra").alias("state"))
    return known.unionByName(extra, allowMissingColumns=True)


def sync_samples(spark, sf) -> DataFrame:
    v = reconcile.verdict(_src(spark, sf), _tgt(spark, sf))
    mism = F.transform("mismatch_sample", lambda x: F.concat_ws(
        ":", x["filename"], F.coalesce(x["source_size"].cast("string"), F.lit("null")),
        F.coalesce(x["target_size"].cast("string"), F.lit("null"))))
    return v.select(
        "export_name",
        F.array_join("source_sample", "|").alias("source_sample"),
        F.array_join("target_sample", "|").alias("target_sample"),
        F.array_join("missing_sample", "|").alias("missing_sample"),
        F.array_join(mism, "|").alias("mismatch_sample"),
    )


# ------------------------------------------------------------------ summary --

def storage_summary(spark, sf) -> DataFrame:
    return summary.storage_summary(_src(spark, sf))


def storage_summary_total(spark, sf) -> DataFrame:
    return summary.storage_summary_with_total(_src(spark, sf))


def target_summary(spark, sf) -> DataFrame:
    return summary.storage_summary(inv_ops.with_shard_fields(_tgt(spark, sf)))


def side_comparison(spark, sf) -> DataFrame:
    s = summary.storage_summary(_src(spark, sf))
    t = summary.storage_summary(inv_ops.with_shard_fields(_tgt(spark, sf)))
    return summary.compare_sides(s, t)


def transfer_totals(spark, sf) -> DataFrame:
    return summary.transfer_totals(_src(spark, sf), "/landing", per_export=True)


def summary_json_rows(spark, sf) -> DataFrame:
    s = summary.storage_summary(_src(spark, sf))
    t = summary.storage_summary(inv_ops.with_shard_fields(_tgt(spark, sf)))
    return summary_json(s, "source").unionByName(summary_json(t, "target"))


def summary_document(spark, sf) -> DataFrame:
    """K6: both sides' summary as one JSON file, written and read back."""
    s = summary.storage_summary(_src(spark, sf))
    t = summary.storage_summary(inv_ops.with_shard_fields(_tgt(spark, sf)))
    return read_summary_document(spark, write_summary_document({"source": s, "target": t, "archive": s.limit(0)}, scratch_dir(spark, "summary-document")))


def report_sides(spark, sf) -> DataFrame:
    """Both summaries and their comparison, as the report job gives them."""
    s, t, both = jobs.report(_src(spark, sf), inv_ops.with_shard_fields(_tgt(spark, sf)))
    lone = jobs.report(_src(spark, sf), None)
    shown = lambda df, side: df.select("export_name", F.col("num_dates").alias(f"{side}_dates"))
    out = both.join(shown(s, "source"), "export_name", "left").join(shown(t, "target"), "export_name", "left")
    return out.withColumn("compared_alone", F.lit(lone[2] is not None))


def message_truncation(spark, sf) -> DataFrame:
    """the first 200 characters of every document's text as a message."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    message = sizes.truncate("text", jobs.MESSAGE_CHARS)
    return docs.select("doc_id", message.alias("message"), F.char_length(message).cast("bigint").alias("chars"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # export and extract (live files)
    "lookback_extract": live.lookback_extract,
    "single_day_extract": live.single_day_extract,
    "column_subset_extract": live.column_subset_extract,
    "interval_extract": live.interval_extract,
    "full_export_roundtrip": live.full_export_roundtrip,
    "export_documents_roundtrip": live.export_documents_roundtrip,
    "export_json_roundtrip": live.export_json_roundtrip,
    "export_parquet_roundtrip": live.export_parquet_roundtrip,
    "export_shard_names": live.export_shard_names,
    "override_and_skip": live.override_and_skip,
    "multi_export": live.multi_export,
    "backfill_range": live.backfill_range,
    "backfill_queries": live.backfill_queries,
    "backfill_any_query": live.backfill_any_query,
    "export_failed_republish": live.export_failed_republish,
    # inventory
    "inventory_layout": inventory_layout,
    "shard_name_parse": shard_name_parse,
    "prefix_and_glob_filter": prefix_and_glob_filter,
    "uri_split": uri_split,
    "uri_split_strict": uri_split_strict,
    "listing_order": listing_order,
    "human_size": human_size,
    "retention_candidates": retention_candidates,
    # reconcile
    "missing_on_target": missing_on_target,
    "extra_on_target": extra_on_target,
    "relevant_target": relevant_target,
    "size_mismatch": size_mismatch,
    "name_set_ops": name_set_ops,
    "sync_verdict": sync_verdict,
    "sync_verdict_empty": sync_verdict_empty,
    "sync_verdict_global": sync_verdict_global,
    "sync_samples": sync_samples,
    "sync_verdict_large": sync_verdict_large,
    "sync_verdict_shared_names": sync_verdict_shared_names,
    "verify_names_full": verify_names_full,
    # summaries
    "storage_summary": storage_summary,
    "storage_summary_total": storage_summary_total,
    "target_summary": target_summary,
    "side_comparison": side_comparison,
    "transfer_totals": transfer_totals,
    "summary_json": summary_json_rows,
    "summary_document": summary_document,
    "report_sides": report_sides,
    "message_truncation": message_truncation,
    # delivery
    "deliver_and_verify": live.deliver_and_verify,
    "deliver_ordered": live.deliver_ordered,
    "deliver_partial_failure": live.deliver_partial_failure,
    "deliver_ordered_failure": live.deliver_ordered_failure,
    "deliver_resumed": live.deliver_resumed,
    "listed_names": live.listed_names,
    "missing_then_retry": live.missing_then_retry,
    "export_area_summary": live.export_area_summary,
    "deliver_uri_glob": live.deliver_uri_glob,
}
