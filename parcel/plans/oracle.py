"""DuckDB SQL equal (row for row) to each driver query in ``registry``."""

from __future__ import annotations

from parcel.functions.paths import SHARD_NAME_PATTERN
from parcel.plans.fixtures import DUCK_FIXTURES, DUCK_LARGE

_EXPORT = "replace(substr(o_orderpriority, 3), ' ', '_')"
_URI = r"(?s)^([A-Za-z][A-Za-z0-9+.-]*)://([^/]*)(/(.*))?$"
_P = SHARD_NAME_PATTERN


def _with(body: str, extra: str = "") -> str:
    return f"WITH {DUCK_FIXTURES}{(',' + extra) if extra else ''}\n{body}"


def _summary(rel: str) -> str:
    return f"""
      SELECT export_name, min(folder_date) AS oldest_date, max(folder_date) AS newest_date,
             count(*) AS num_dates, CAST(sum(files) AS BIGINT) AS total_files, CAST(sum(bytes) AS BIGINT) AS total_size,
             CAST(sum(files) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avg_files_per_date,
             CASE WHEN sum(files) > 0 THEN CAST(sum(bytes) AS DOUBLE) / CAST(sum(files) AS DOUBLE) ELSE 0.0 END
               AS avg_size_per_file
      FROM (SELECT export_name, folder_date, count(*) AS files, sum(coalesce(size, 0)) AS bytes
            FROM {rel} GROUP BY export_name, folder_date) pd
      GROUP BY export_name"""


_TSF = f"""tsf AS (
  SELECT *, regexp_extract(filename, '{_P}', 1) AS export_name, regexp_extract(filename, '{_P}', 2) AS folder_date
  FROM tgt WHERE regexp_matches(filename, '{_P}'))"""


def _verdict(exports: list[str], cls_rel: str = "cls") -> str:
    values = ", ".join(f"('{e}')" for e in exports)
    n, m, x = "coalesce(c.source_file_count, 0)", "coalesce(c.missing_count, 0)", "coalesce(c.mismatch_count, 0)"
    sync = f"({n} > 0 AND {m} = 0 AND {x} = 0)"
    return f"""
      SELECT ex.export_name, {sync} AS in_sync, {n} AS source_file_count,
             coalesce(c.target_file_count, 0) AS target_file_count, {m} AS missing_count, {x} AS mismatch_count,
             {n} = 0 AS no_files_found,
             CASE WHEN {n} = 0 THEN 'no_files' WHEN {sync} THEN 'ok' ELSE 'out_of_sync' END AS outcome
      FROM (VALUES {values}) ex(export_name)
      LEFT JOIN (SELECT export_name, count(*) AS source_file_count,
                        count(*) FILTER (WHERE on_target) AS target_file_count,
                        count(*) FILTER (WHERE state = 'missing') AS missing_count,
                        count(*) FILTER (WHERE state = 'mismatch') AS mismatch_count
                 FROM {cls_rel} GROUP BY export_name) c ON c.export_name = ex.export_name"""


def _human(v: str, compact: bool) -> str:
    units = ["B", "KB", "MB", "GB", "TB"]
    sep = "" if compact else " "
    test = v if compact else f"abs({v})"
    parts = []
    for k, unit in enumerate(units):
        bound = 1024 ** (k + 1)
        if compact and k == 0:
            text = f"CAST({v} AS VARCHAR) || 'B'"
        else:
            text = f"printf('%.1f{sep}{unit}', CAST({v} AS DOUBLE) / {float(1024 ** k)})"
        parts.append(f"WHEN {test} < {bound} THEN {text}")
    last = f"printf('%.1f{sep}PB', CAST({v} AS DOUBLE) / {float(1024 ** 5)})"
    return "CASE " + " ".join(parts) + f" ELSE {last} END"


_CONTENT = """CAST(sum(CAST('0x' || substr(md5(concat_ws('|', o_orderkey, o_custkey, o_orderstatus,
  CAST(round(o_totalprice * 100) AS BIGINT), strftime(o_orderdate, '%Y%m%d%H%M%S'), o_orderpriority)), 1, 8) AS BIGINT)) AS BIGINT) AS content"""
_PRIORITY_COUNTS = f"SELECT {_EXPORT} AS export_name, count(*) AS n, {_CONTENT} FROM orders GROUP BY 1"

ORACLE_SQL: dict[str, str] = {
    # ----------------------------------------------------------- extract --
    "lookback_extract": "SELECT * FROM orders WHERE CAST(o_orderdate AS DATE) "
                        "BETWEEN DATE '1998-06-01' AND DATE '1998-06-08'",
    "single_day_extract": "SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-02'",
    "column_subset_extract": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "interval_extract": "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-02 00:00:00' "
                        "AND ts < TIMESTAMP '2024-01-03 00:00:00'",
    "full_export_roundtrip": "SELECT * FROM lineitem",
    "export_documents_roundtrip": "SELECT * FROM documents",
    "export_json_roundtrip": "SELECT * FROM events",
    "export_parquet_roundtrip": "SELECT * FROM lineitem",
    "export_shard_names": """
      SELECT 'ORDERS_19980608-' || lpad(CAST(i AS VARCHAR), 12, '0') || '.csv.gz' AS filename,
             'ORDERS' AS export_name, '19980608' AS folder_date, CAST(i AS BIGINT) AS shard,
             (SELECT count(*) FROM orders) AS rows_exported
      FROM range(4) t(i)""",
    "override_and_skip": f"""
      SELECT 'URGENT' AS export_name, count(*) AS rows_exported, {_CONTENT} FROM orders WHERE o_orderpriority = '1-URGENT'
      UNION ALL
      SELECT 'LOW', count(*), {_CONTENT} FROM orders WHERE o_orderpriority = '5-LOW'
      UNION ALL
      SELECT 'HIGH', count(*), {_CONTENT} FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'F'""",
    "multi_export": f"SELECT {_EXPORT} AS export_name, count(*) AS rows_exported, {_CONTENT} FROM orders GROUP BY 1",
    "backfill_range": f"""
      SELECT strftime(d, '%Y%m%d') AS folder_date, count(*) AS rows_exported, {_CONTENT}
      FROM (SELECT CAST(r AS DATE) AS d FROM range(TIMESTAMP '1998-06-01', TIMESTAMP '1998-06-06', INTERVAL 1 DAY) t(r)) days
      JOIN orders ON CAST(o_orderdate AS DATE) BETWEEN d - 7 AND d
      GROUP BY 1""",
    "backfill_queries": f"""
      SELECT strftime(CAST(o_orderdate AS DATE) + 1, '%Y%m%d') AS folder_date, count(*) AS rows_exported, {_CONTENT}
      FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-06-01' AND DATE '1998-06-05'
      GROUP BY 1""",
    "backfill_any_query": f"""
      SELECT strftime(d, '%Y%m%d') AS folder_date, count(*) AS rows_exported, {_CONTENT}, count(*) AS rows_counted
      FROM (SELECT CAST(r AS DATE) AS d FROM range(TIMESTAMP '1998-05-01', TIMESTAMP '1998-06-30', INTERVAL 1 DAY) t(r)) days
      JOIN orders ON CAST(o_orderdate AS DATE) BETWEEN d - 7 AND d
      GROUP BY 1""",
    "export_failed_republish": f"""
      SELECT 'BLOCKED' AS export_name, CAST(2 AS BIGINT) AS shards, count(*) AS rows_held, {_CONTENT} FROM orders
      UNION ALL
      SELECT 'LOST', CAST(3 AS BIGINT), count(*), {_CONTENT} FROM orders WHERE o_orderstatus = 'F'
      UNION ALL
      SELECT 'LOST_UNDOING', CAST(2 AS BIGINT), count(*), {_CONTENT} FROM orders""",
    # --------------------------------------------------------- inventory --
    "inventory_layout": _with("SELECT key, export_name, folder_date, filename, size FROM src"),
    "shard_name_parse": _with(f"""
      SELECT filename, regexp_extract(filename, '{_P}', 1) AS export_name,
             regexp_extract(filename, '{_P}', 2) AS folder_date
      FROM tgt WHERE regexp_matches(filename, '{_P}')"""),
    "prefix_and_glob_filter": _with(r"""
      SELECT key, filename, size FROM src
      WHERE starts_with(key, 'MEDIUM/199') AND regexp_full_match(filename, 'MEDIUM_199.06..-.*[05]\.csv\.gz')
        AND export_name = 'MEDIUM'"""),
    "uri_split": f"""
      SELECT page_id, regexp_extract(url, '{_URI}', 1) AS scheme, regexp_extract(url, '{_URI}', 2) AS host,
             regexp_extract(url, '{_URI}', 4) AS path,
             'https://' || regexp_extract(url, '{_URI}', 2) || '/' || regexp_extract(url, '{_URI}', 4) AS https_uri
      FROM pages""",
    "uri_split_strict": _with("""
      SELECT 'gs://parcel-src/' || key AS uri, 'parcel-src' AS bucket, key,
             regexp_extract(key, '([^/]*)$', 1) AS filename
      FROM src"""),
    "listing_order": _with("""
      SELECT *, row_number() OVER (ORDER BY sort_key, name) AS ordinal FROM (
      SELECT name, is_dir, size, (CASE WHEN is_dir THEN '0' ELSE '1' END) || lower(name) AS sort_key
      FROM (SELECT rel AS name, false AS is_dir, size FROM scoped WHERE NOT contains(rel, '/') AND rel <> ''
            UNION ALL
            SELECT DISTINCT split_part(rel, '/', 1), true, CAST(NULL AS BIGINT) FROM scoped WHERE contains(rel, '/')) e) named""",
        "scoped AS (SELECT substr(key, 6) AS rel, size FROM src_files WHERE starts_with(key, 'HIGH/'))"),
    "human_size": _with(f"""
      SELECT size_bytes, {_human('size_bytes', False)} AS human, {_human('size_bytes', True)} AS compact
      FROM (SELECT unnest([size, size * 1024, size * 1048576, size * 1073741824]) AS size_bytes
            FROM src) s"""),
    "retention_candidates": _with("""
      SELECT key, CAST(date_diff('day', CAST(mtime AS DATE), DATE '1999-01-01') AS INTEGER) AS age_days
      FROM src_files WHERE mtime < TIMESTAMP '1998-12-02 00:00:00'"""),
    # --------------------------------------------------------- reconcile --
    "missing_on_target": _with("""
      SELECT s.filename, s.export_name, s.size FROM src_d s
      WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.filename = s.filename)"""),
    "extra_on_target": _with("""
      SELECT t.filename, t.size FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.filename = t.filename)"""),
    "verify_names_full": _with("""
      SELECT s.filename, s.export_name, s.size AS source_size, t.size AS target_size,
             CASE WHEN t.filename IS NULL THEN 'missing' WHEN s.size IS DISTINCT FROM t.size THEN 'mismatch' ELSE 'ok' END AS state
      FROM src_d s LEFT JOIN tgt t ON t.filename = s.filename
      UNION ALL
      SELECT t.filename, NULL, NULL, t.size, 'extra' FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.filename = t.filename)"""),
    "sync_verdict_shared_names": _with(_verdict(["URGENT", "HIGH", "MEDIUM", "NOT_SPECIFIED", "LOW"], "same"), r"""
      named AS (SELECT export_name, regexp_replace(filename, '^[A-Z_]+_([0-9]{8}-)', 'data_\1') AS filename, size,
                       row_number() OVER (PARTITION BY export_name, regexp_replace(filename, '^[A-Z_]+_([0-9]{8}-)', 'data_\1') ORDER BY key DESC) AS rn
                FROM src),
      landed AS (SELECT regexp_replace(filename, '^[A-Z_]+_([0-9]{8}-)', 'data_\1') AS filename, max(size) AS size FROM tgt GROUP BY 1),
      same AS (SELECT n.export_name, l.filename IS NOT NULL AS on_target,
                      CASE WHEN l.filename IS NULL THEN 'missing' WHEN n.size IS DISTINCT FROM l.size THEN 'mismatch' ELSE 'ok' END AS state
               FROM named n LEFT JOIN landed l ON l.filename = n.filename WHERE n.rn = 1)"""),
    "relevant_target": _with("""
      SELECT t.filename, t.size FROM tgt t WHERE EXISTS (SELECT 1 FROM src s WHERE s.filename = t.filename)"""),
    "size_mismatch": _with("SELECT filename, export_name, source_size, target_size FROM cls WHERE state = 'mismatch'"),
    "name_set_ops": _with("""
      SELECT set_op, count(*) AS names, min(filename) AS first_name, max(filename) AS last_name FROM (
        SELECT filename, 'missing' AS set_op FROM (SELECT filename FROM src EXCEPT SELECT filename FROM tgt)
        UNION ALL SELECT filename, 'extra' FROM (SELECT filename FROM tgt EXCEPT SELECT filename FROM src)
        UNION ALL SELECT filename, 'common' FROM (SELECT filename FROM src INTERSECT SELECT filename FROM tgt)
        UNION ALL SELECT filename, 'all' FROM (SELECT filename FROM src UNION SELECT filename FROM tgt)) ops
      GROUP BY set_op"""),
    "sync_verdict": _with(_verdict(["URGENT", "HIGH", "MEDIUM", "NOT_SPECIFIED", "LOW", "ARCHIVE"])),
    "sync_verdict_empty": _with(_verdict(["ARCHIVE"], "(SELECT * FROM cls WHERE export_name = 'ARCHIVE')")),
    "sync_verdict_global": _with(f"""
      SELECT v.*, (SELECT count(*) FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.filename = t.filename))
                    AS extra_count
      FROM ({_verdict(["ALL"], "(SELECT * EXCLUDE (export_name), 'ALL' AS export_name FROM cls)")}) v"""),
    "sync_samples": _with("""
      SELECT export_name,
        coalesce(string_agg(filename, '|' ORDER BY filename) FILTER (WHERE rn_src <= 3), '') AS source_sample,
        coalesce(string_agg(filename, '|' ORDER BY filename) FILTER (WHERE on_target AND rn_tgt <= 3), '')
          AS target_sample,
        coalesce(string_agg(filename, '|' ORDER BY filename) FILTER (WHERE state = 'missing' AND rn_state <= 10), '')
          AS missing_sample,
        coalesce(string_agg(filename || ':' || coalesce(CAST(source_size AS VARCHAR), 'null') || ':'
                            || coalesce(CAST(target_size AS VARCHAR), 'null'), '|' ORDER BY filename)
                 FILTER (WHERE state = 'mismatch' AND rn_state <= 5), '') AS mismatch_sample
      FROM ranked GROUP BY export_name""",
        """ranked AS (
      SELECT *, row_number() OVER (PARTITION BY export_name ORDER BY filename) AS rn_src,
                row_number() OVER (PARTITION BY export_name, on_target ORDER BY filename) AS rn_tgt,
                row_number() OVER (PARTITION BY export_name, state ORDER BY filename) AS rn_state
      FROM cls)"""),
    "sync_verdict_large": f"""
      WITH {DUCK_LARGE}
      SELECT export_name, (missing_count = 0 AND mismatch_count = 0) AS in_sync, source_file_count,
             target_file_count, missing_count, mismatch_count, false AS no_files_found,
             CASE WHEN missing_count = 0 AND mismatch_count = 0 THEN 'ok' ELSE 'out_of_sync' END AS outcome,
             missing_sample
      FROM (SELECT export_name, count(*) AS source_file_count,
                   count(*) FILTER (WHERE on_target) AS target_file_count,
                   count(*) FILTER (WHERE state = 'missing') AS missing_count,
                   count(*) FILTER (WHERE state = 'mismatch') AS mismatch_count,
                   coalesce(string_agg(filename, '|' ORDER BY filename) FILTER (WHERE state = 'missing' AND rn <= 10), '')
                     AS missing_sample
            FROM (SELECT *, row_number() OVER (PARTITION BY export_name, state ORDER BY filename) AS rn FROM lc) r
            GROUP BY export_name) g""",
    # ----------------------------------------------------------- summary --
    "storage_summary": _with(_summary("src")),
    "storage_summary_total": _with(f"""
      {_summary("src")}
      UNION ALL
      SELECT 'TOTAL', NULL, NULL, NULL, CAST(count(*) AS BIGINT), CAST(sum(coalesce(size, 0)) AS BIGINT), NULL, NULL
      FROM src"""),
    "target_summary": _with(_summary("tsf"), _TSF),
    "side_comparison": _with(f"""
      SELECT coalesce(s.export_name, t.export_name) AS export_name,
             coalesce(s.total_files, 0) AS source_files, coalesce(t.total_files, 0) AS target_files,
             coalesce(s.total_size, 0) AS source_size, coalesce(t.total_size, 0) AS target_size,
             CASE WHEN coalesce(s.total_files, 0) = coalesce(t.total_files, 0)
                       AND coalesce(s.total_size, 0) = coalesce(t.total_size, 0) THEN 'OK'
                  WHEN coalesce(s.total_files, 0) = 0 THEN 'source empty'
                  WHEN coalesce(t.total_files, 0) = 0 THEN 'target empty'
                  ELSE 'MISMATCH' END AS status
      FROM ({_summary("src")}) s FULL OUTER JOIN ({_summary("tsf")}) t ON s.export_name = t.export_name""", _TSF),
    "transfer_totals": _with("""
      SELECT export_name, count(*) AS files_transferred, CAST(coalesce(sum(coalesce(size, 0)), 0) AS BIGINT) AS total_bytes,
             round_even(CAST(coalesce(sum(coalesce(size, 0)), 0) AS DOUBLE) / 1048576.0, 2) AS total_mb,
             CASE WHEN count(*) = 1 THEN '/landing/' || max(filename) ELSE '/landing/' END AS destination
      FROM src GROUP BY export_name"""),
    "summary_json": _with(f"""
      SELECT side, export_name,
             to_json(struct_pack(oldest_date := oldest_date, newest_date := newest_date, num_dates := num_dates,
                                 total_files := total_files, total_size := total_size,
                                 avg_files_per_date := avg_files_per_date, avg_size_per_file := avg_size_per_file))::VARCHAR
               AS stats
      FROM (SELECT 'source' AS side, * FROM ({_summary("src")}) a
            UNION ALL SELECT 'target' AS side, * FROM ({_summary("tsf")}) b) u""", _TSF),
    "summary_document": _with(f"""
      SELECT 'source' AS side, * FROM ({_summary("src")}) a UNION ALL SELECT 'target' AS side, * FROM ({_summary("tsf")}) b""", _TSF),
    "report_sides": _with(f"""
      SELECT coalesce(s.export_name, t.export_name) AS export_name,
             coalesce(s.total_files, 0) AS source_files, coalesce(t.total_files, 0) AS target_files,
             coalesce(s.total_size, 0) AS source_size, coalesce(t.total_size, 0) AS target_size,
             CASE WHEN coalesce(s.total_files, 0) = coalesce(t.total_files, 0)
                       AND coalesce(s.total_size, 0) = coalesce(t.total_size, 0) THEN 'OK'
                  WHEN coalesce(s.total_files, 0) = 0 THEN 'source empty'
                  WHEN coalesce(t.total_files, 0) = 0 THEN 'target empty'
                  ELSE 'MISMATCH' END AS status,
             s.num_dates AS source_dates, t.num_dates AS target_dates, false AS compared_alone
      FROM ({_summary("src")}) s FULL OUTER JOIN ({_summary("tsf")}) t ON s.export_name = t.export_name""", _TSF),
    "message_truncation": "SELECT doc_id, substr(text, 1, 200) AS message, CAST(length(substr(text, 1, 200)) AS BIGINT) AS chars FROM documents",
    # ---------------------------------------------------------- delivery --
    "deliver_ordered_failure": f"""
      SELECT CAST(10 AS BIGINT) AS attempted, CAST(5 AS BIGINT) AS succeeded, CAST(1 AS BIGINT) AS failed, CAST(4 AS BIGINT) AS skipped,
             CAST(0 AS BIGINT) AS superseded, CAST(0 AS BIGINT) AS unchanged, CAST(8 AS BIGINT) AS attempts, export_name,
             CASE WHEN export_name IN ('HIGH', 'LOW') THEN 'ok,ok' WHEN export_name = 'MEDIUM' THEN 'failed,ok' ELSE 'skipped,skipped' END AS statuses
      FROM ({_PRIORITY_COUNTS}) c""",
    "deliver_resumed": f"""
      SELECT run, CAST(10 AS BIGINT) AS attempted, CAST(CASE run WHEN 1 THEN 8 WHEN 2 THEN 2 ELSE 0 END AS BIGINT) AS succeeded,
             CAST(CASE run WHEN 1 THEN 2 ELSE 0 END AS BIGINT) AS failed, CAST(CASE run WHEN 1 THEN 0 WHEN 2 THEN 8 ELSE 10 END AS BIGINT) AS unchanged,
             CAST(n AS BIGINT) AS rows_delivered, content
      FROM (SELECT CAST(unnest([1, 2, 3]) AS INTEGER) AS run) r, (SELECT sum(n) AS n, CAST(sum(content) AS BIGINT) AS content FROM ({_PRIORITY_COUNTS}) c) t""",
    "listed_names": f"""
      SELECT side, export_name || '_19980608-' || lpad(CAST(i AS VARCHAR), 12, '0') || '.csv.gz' AS filename,
             CASE WHEN side = 'target' THEN export_name END AS export_name, CASE WHEN side = 'target' THEN '19980608' END AS folder_date
      FROM ({_PRIORITY_COUNTS}) c, range(2) t(i), (SELECT unnest(['source', 'target']) AS side) s
      WHERE side = 'source' OR export_name = 'HIGH'""",
    "deliver_and_verify": f"""
      SELECT export_name, n AS rows_delivered, content, true AS in_sync, 'ok' AS outcome FROM ({_PRIORITY_COUNTS}) c""",
    "deliver_ordered": f"""
      SELECT export_name, n AS rows_delivered, content, true AS in_sync, 'ok' AS outcome FROM ({_PRIORITY_COUNTS}) c""",
    "deliver_partial_failure": f"""
      SELECT export_name,
             CAST(CASE WHEN export_name = 'LOW' THEN 0 ELSE 2 END AS BIGINT) AS files_ok,
             CAST(CASE WHEN export_name = 'LOW' THEN 2 ELSE 0 END AS BIGINT) AS files_failed,
             CAST(CASE WHEN export_name = 'LOW' THEN 6 ELSE 2 END AS BIGINT) AS attempts,
             CASE WHEN export_name = 'LOW' THEN CAST(0 AS BIGINT) ELSE n END AS rows_delivered,
             CASE WHEN export_name <> 'LOW' THEN content END AS content
      FROM ({_PRIORITY_COUNTS}) c""",
    "missing_then_retry": f"""
      SELECT export_name,
             CAST(CASE WHEN export_name IN ('URGENT', 'HIGH') THEN 1 ELSE 0 END AS BIGINT) AS missing_before,
             CAST(CASE WHEN export_name IN ('URGENT', 'HIGH') THEN 1 ELSE 0 END AS BIGINT) AS retried_ok,
             n AS rows_delivered, content, true AS in_sync
      FROM ({_PRIORITY_COUNTS}) c""",
    "export_area_summary": f"""
      SELECT export_name, '19980608' AS oldest_date, '19980608' AS newest_date, CAST(1 AS BIGINT) AS num_dates,
             CAST(2 AS BIGINT) AS total_files, true AS bytes_agree
      FROM ({_PRIORITY_COUNTS}) c""",
    "deliver_uri_glob": f"""
      SELECT CAST(3 AS BIGINT) AS files_transferred, true AS destination_is_dir, CAST(3 AS BIGINT) AS listed_files,
             count(*) AS rows_delivered, {_CONTENT}
      FROM orders""",
}
