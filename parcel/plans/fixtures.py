"""Inventories derived from the test tables, for reconciliation queries.

Every order becomes one exported object, so the inventories grow with the
``orders`` table. Rules (identical in the Spark builders and the DuckDB text
the driver's oracle runs):

source ``gs://parcel-src``, key ``<export>/<yyyymmdd>/<file>``:
  export  = priority without its "N-" prefix, spaces -> '_'
  file    = ``<export>_<yyyymmdd>-<orderkey:012d>.csv.gz``
  size    = (custkey*7919 + orderkey*104729) % 5000000 + 1024, NULL when orderkey % 71 = 0
  extra copies under ``<export>/latest/<file>`` (size + 13) when orderkey % 41 = 0
  folder markers ``<export>/<yyyymmdd>/`` when orderkey % 53 = 0
  shallow objects ``<export>/manifest-<orderkey>.json`` when orderkey % 59 = 0

target ``file:/landing`` (flat): one file per source name, except
  missing when orderkey % 97 = 0; size + 1 when % 89 = 0; NULL when % 83 = 0;
  500 when the source size is NULL; plus ``EXTRA_20000101-<custkey>.csv.gz``
  for customers with custkey % 61 = 0 and ``notes_<nation>.txt`` per nation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SRC_BUCKET = "gs://parcel-src"
TGT_BUCKET = "file:/landing"

_EXPORT = "replace(substr(o_orderpriority, 3), ' ', '_')"
_BASE = "(o_custkey * 7919 + o_orderkey * 104729) % 5000000 + 1024"

# Spark SQL text of both inventories (one parse on the JVM instead of many
# column-building calls from Python). ``{sf}`` is the table folder.
_SPARK_FIXTURES = f"""
o AS (
  SELECT {_EXPORT} AS export_name, date_format(o_orderdate, 'yyyyMMdd') AS folder_date,
         o_orderkey, o_orderdate, CAST({_BASE} AS BIGINT) AS base
  FROM (SELECT /*+ REPARTITION({{parts}}, o_orderkey) */ o_orderkey, o_custkey, o_orderdate, o_orderpriority
        FROM parquet.`{{sf}}/orders.parquet`) scanned),
f AS (
  SELECT *, concat(export_name, '_', folder_date, '-', lpad(CAST(o_orderkey AS STRING), 12, '0'), '.csv.gz') AS fname
  FROM o),
src_raw AS (
  SELECT '{SRC_BUCKET}' AS bucket, concat(export_name, '/', folder_date, '/', fname) AS key, fname AS filename,
         CAST(CASE WHEN o_orderkey % 71 = 0 THEN NULL ELSE base END AS BIGINT) AS size,
         CAST(o_orderdate + INTERVAL 6 HOURS AS TIMESTAMP_NTZ) AS mtime
  FROM f
  UNION ALL
  SELECT '{SRC_BUCKET}', concat(export_name, '/latest/', fname), fname, base + 13,
         CAST(o_orderdate + INTERVAL 30 DAYS AS TIMESTAMP_NTZ)
  FROM f WHERE o_orderkey % 41 = 0
  UNION ALL
  SELECT DISTINCT '{SRC_BUCKET}', concat(export_name, '/', folder_date, '/'), '', CAST(0 AS BIGINT),
         CAST(o_orderdate AS TIMESTAMP_NTZ)
  FROM f WHERE o_orderkey % 53 = 0
  UNION ALL
  SELECT '{SRC_BUCKET}', concat(export_name, '/manifest-', CAST(o_orderkey AS STRING), '.json'),
         concat('manifest-', CAST(o_orderkey AS STRING), '.json'), CAST(100 + o_orderkey % 7 AS BIGINT),
         CAST(o_orderdate AS TIMESTAMP_NTZ)
  FROM f WHERE o_orderkey % 59 = 0),
tgt AS (
  SELECT '{TGT_BUCKET}' AS bucket, fname AS key, fname AS filename,
         CAST(CASE WHEN o_orderkey % 89 = 0 THEN
                     (CASE WHEN o_orderkey % 41 = 0 THEN base + 13 WHEN o_orderkey % 71 = 0 THEN NULL ELSE base END) + 1
                   WHEN o_orderkey % 83 = 0 THEN NULL
                   WHEN o_orderkey % 71 = 0 THEN 500
                   WHEN o_orderkey % 41 = 0 THEN base + 13
                   ELSE base END AS BIGINT) AS size,
         CAST(o_orderdate + INTERVAL 1 DAYS AS TIMESTAMP_NTZ) AS mtime
  FROM f WHERE o_orderkey % 97 <> 0
  UNION ALL
  SELECT '{TGT_BUCKET}', concat('EXTRA_20000101-', lpad(CAST(c_custkey AS STRING), 12, '0'), '.csv.gz'),
         concat('EXTRA_20000101-', lpad(CAST(c_custkey AS STRING), 12, '0'), '.csv.gz'), CAST(7 AS BIGINT),
         TIMESTAMP_NTZ '2000-01-01 00:00:00'
  FROM parquet.`{{sf}}/customer.parquet` WHERE c_custkey % 61 = 0
  UNION ALL
  SELECT '{TGT_BUCKET}', concat('notes_', lower(n_name), '.txt'), concat('notes_', lower(n_name), '.txt'),
         CAST(42 AS BIGINT), TIMESTAMP_NTZ '2000-01-01 00:00:00'
  FROM parquet.`{{sf}}/nation.parquet`)
"""


def _parts(spark: SparkSession) -> int:
    # The test tables are single-row-group files, so their scans are one task;
    # hash-spreading the few raw columns lets the string building that derives
    # the inventory run on every core (a hash repartition needs no pre-sort).
    return spark.sparkContext.defaultParallelism * 2


def _fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if "`" in sf_dir:
        raise ValueError("table folder must not contain a backtick")
    text = _SPARK_FIXTURES.format(sf=sf_dir, parts=_parts(spark))
    return spark.sql(f"WITH {text} SELECT * FROM {name}")


def source_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw source listing (markers and shallow objects included)."""
    return _fixture(spark, sf_dir, "src_raw")


def target_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat landing-folder listing."""
    return _fixture(spark, sf_dir, "tgt")


# ---------------------------------------------------------------------------
# The same inventories as DuckDB CTEs (used by oracle_sql()).
# ---------------------------------------------------------------------------

DUCK_FIXTURES = f"""
o AS (
  SELECT replace(substr(o_orderpriority, 3), ' ', '_') AS export_name,
         strftime(o_orderdate, '%Y%m%d') AS folder_date,
         o_orderkey, o_orderdate,
         CAST({_BASE} AS BIGINT) AS base,
         replace(substr(o_orderpriority, 3), ' ', '_') || '_' || strftime(o_orderdate, '%Y%m%d') || '-'
           || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || '.csv.gz' AS fname
  FROM orders),
src_raw AS (
  SELECT '{SRC_BUCKET}' AS bucket, export_name || '/' || folder_date || '/' || fname AS key, fname AS filename,
         CAST(CASE WHEN o_orderkey % 71 = 0 THEN NULL ELSE base END AS BIGINT) AS size,
         o_orderdate + INTERVAL 6 HOUR AS mtime
  FROM o
  UNION ALL
  SELECT '{SRC_BUCKET}', export_name || '/latest/' || fname, fname, base + 13, o_orderdate + INTERVAL 30 DAY
  FROM o WHERE o_orderkey % 41 = 0
  UNION ALL
  SELECT DISTINCT '{SRC_BUCKET}', export_name || '/' || folder_date || '/', '', CAST(0 AS BIGINT), o_orderdate
  FROM o WHERE o_orderkey % 53 = 0
  UNION ALL
  SELECT '{SRC_BUCKET}', export_name || '/manifest-' || CAST(o_orderkey AS VARCHAR) || '.json',
         'manifest-' || CAST(o_orderkey AS VARCHAR) || '.json', CAST(100 + o_orderkey % 7 AS BIGINT), o_orderdate
  FROM o WHERE o_orderkey % 59 = 0),
src_files AS (SELECT * FROM src_raw WHERE NOT ends_with(key, '/')),
src AS (
  SELECT *, string_split(key, '/')[1] AS export_name, string_split(key, '/')[2] AS folder_date
  FROM src_files WHERE len(string_split(key, '/')) >= 3),
tgt AS (
  SELECT '{TGT_BUCKET}' AS bucket, fname AS key, fname AS filename,
         CAST(CASE WHEN o_orderkey % 89 = 0 THEN
                     (CASE WHEN o_orderkey % 41 = 0 THEN base + 13 WHEN o_orderkey % 71 = 0 THEN NULL ELSE base END) + 1
                   WHEN o_orderkey % 83 = 0 THEN NULL
                   WHEN o_orderkey % 71 = 0 THEN 500
                   WHEN o_orderkey % 41 = 0 THEN base + 13
                   ELSE base END AS BIGINT) AS size,
         o_orderdate + INTERVAL 1 DAY AS mtime
  FROM o WHERE o_orderkey % 97 <> 0
  UNION ALL
  SELECT '{TGT_BUCKET}', 'EXTRA_20000101-' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') || '.csv.gz',
         'EXTRA_20000101-' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') || '.csv.gz', CAST(7 AS BIGINT),
         TIMESTAMP '2000-01-01 00:00:00'
  FROM customer WHERE c_custkey % 61 = 0
  UNION ALL
  SELECT '{TGT_BUCKET}', 'notes_' || lower(n_name) || '.txt', 'notes_' || lower(n_name) || '.txt',
         CAST(42 AS BIGINT), TIMESTAMP '2000-01-01 00:00:00'
  FROM nation),
src_d AS (
  SELECT filename, arg_max_null(size, key) AS size, arg_max_null(export_name, key) AS export_name, max(key) AS key
  FROM src GROUP BY filename),
cls AS (
  SELECT s.filename, s.export_name, s.size AS source_size, t.size AS target_size,
         t.filename IS NOT NULL AS on_target,
         CASE WHEN t.filename IS NULL THEN 'missing'
              WHEN s.size IS NOT DISTINCT FROM t.size THEN 'ok' ELSE 'mismatch' END AS state
  FROM src_d s LEFT JOIN tgt t ON s.filename = t.filename)
"""


# One object per lineitem row, for timing reconciliation on large inventories
# (bench.py). A third of all objects belong to one export ("HOT") so the
# per-export aggregation and sampling run against a hot key.
_LARGE = f"""
l AS (
  SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'HOT' ELSE concat(l_returnflag, l_linestatus) END AS export_name,
         date_format(l_shipdate, 'yyyyMMdd') AS folder_date,
         l_orderkey * 8 + l_linenumber AS obj, l_shipdate,
         CAST(l_orderkey % 100000 AS BIGINT) * 16 + l_linenumber AS base
  FROM (SELECT /*+ REPARTITION({{parts}}, l_orderkey) */ l_orderkey, l_linenumber, l_returnflag, l_linestatus,
               l_shipdate
        FROM parquet.`{{sf}}/lineitem.parquet`) scanned),
f AS (
  SELECT *, concat(export_name, '_', folder_date, '-', lpad(CAST(obj AS STRING), 12, '0'), '.csv.gz') AS fname FROM l),
src AS (
  SELECT '{SRC_BUCKET}' AS bucket, concat(export_name, '/', folder_date, '/', fname) AS key, fname AS filename,
         base AS size, CAST(l_shipdate AS TIMESTAMP_NTZ) AS mtime
  FROM f),
tgt AS (
  SELECT '{TGT_BUCKET}' AS bucket, fname AS key, fname AS filename,
         CASE WHEN obj % 103 = 0 THEN base + 1 ELSE base END AS size, CAST(l_shipdate AS TIMESTAMP_NTZ) AS mtime
  FROM f WHERE obj % 101 <> 0)
"""


def large_inventories(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(source, target) inventories with one object per lineitem row."""
    text = _LARGE.format(sf=sf_dir, parts=_parts(spark))
    return (spark.sql(f"WITH {text} SELECT * FROM src"), spark.sql(f"WITH {text} SELECT * FROM tgt"))


DUCK_LARGE = f"""
l AS (
  SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'HOT' ELSE l_returnflag || l_linestatus END AS export_name,
         strftime(l_shipdate, '%Y%m%d') AS folder_date,
         l_orderkey * 8 + l_linenumber AS obj, l_shipdate,
         CAST(l_orderkey % 100000 AS BIGINT) * 16 + l_linenumber AS base
  FROM lineitem),
lf AS (
  SELECT *, export_name || '_' || folder_date || '-' || lpad(CAST(obj AS VARCHAR), 12, '0') || '.csv.gz' AS fname
  FROM l),
lsrc AS (
  SELECT '{SRC_BUCKET}' AS bucket, export_name || '/' || folder_date || '/' || fname AS key, fname AS filename,
         base AS size, export_name
  FROM lf),
ltgt AS (
  SELECT fname AS filename, max(CASE WHEN obj % 103 = 0 THEN base + 1 ELSE base END) AS size
  FROM lf WHERE obj % 101 <> 0 GROUP BY fname),
ld AS (
  SELECT filename, arg_max_null(size, key) AS size, arg_max_null(export_name, key) AS export_name
  FROM lsrc GROUP BY filename),
lc AS (
  SELECT s.filename, s.export_name, t.filename IS NOT NULL AS on_target,
         CASE WHEN t.filename IS NULL THEN 'missing'
              WHEN s.size IS NOT DISTINCT FROM t.size THEN 'ok' ELSE 'mismatch' END AS state
  FROM ld s LEFT JOIN ltgt t ON s.filename = t.filename)
"""
