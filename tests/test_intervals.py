"""Backfills of any query in one scan."""

import pytest
from table_paths import SF_SMALL

from parcel.functions.params import ExportSpec, Interval
from parcel.plans import jobs
from parcel.sinks.export import read_export
from parcel.sources.intervals import NotCorrelated, correlated, run_over
from parcel.sources.query import run_query


def _runs(n):
    return [Interval.ending(f"1998-06-{d:02d}") for d in range(1, n + 1)]


QUERIES = [
    "SELECT * FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN date_sub(DATE('{data_interval_end}'), 7) AND DATE('{data_interval_end}')",
    "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderdate >= :data_interval_start AND o_orderdate < :data_interval_end GROUP BY 1",
    "SELECT count(*) AS n FROM orders WHERE DATE(o_orderdate) = :ds",
    "WITH w AS (SELECT * FROM orders WHERE DATE(o_orderdate) <= :ds) SELECT o_custkey, max(o_orderdate) AS m FROM w GROUP BY 1 HAVING DATE(max(o_orderdate)) = :ds",
    "SELECT o_orderkey, concat('run {ds_nodash} of {date_dash}') AS told FROM orders WHERE o_orderdate < :data_interval_end ORDER BY o_orderkey DESC LIMIT 3 -- :ds",
    "SELECT o_orderkey, ':ds' AS folder_date FROM orders WHERE o_orderkey < 5",
]


@pytest.mark.parametrize("query", QUERIES)
def test_one_scan_equals_a_query_for_each_run(spark, query):
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").createOrReplaceTempView("orders")
    got = run_over(spark, query, _runs(9))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1, plan
    want = [(run.folder_date, *row) for run in _runs(9) for row in run_query(spark, query, run).drop("folder_date").collect()]
    columns = [c for c in got.columns if c != "folder_date"]
    assert sorted(map(repr, ((r["folder_date"], *(r[c] for c in columns)) for r in got.collect()))) == sorted(map(repr, want))


def test_texts_and_markers():
    assert correlated("a = '{ds}' AND b = 'x{ds}y''' AND c::ds = :ds") == "a = _run.t_ds AND b = concat('x', _run.t_ds, 'y''') AND c::ds = _run.p_ds"
    assert correlated("'it is {other} :ds' `:ds` -- {ds}\n:end_date") == "'it is {other} :ds' `:ds` -- {ds}\n_run.p_end_date"
    for query in ("SELECT * FROM orders_{ds_nodash}", "SELECT * FROM `orders_{date}`"):
        with pytest.raises(NotCorrelated):
            correlated(query)


def test_backfill_falls_back_to_a_query_a_day(spark, tmp_root):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    for run in _runs(3):
        orders.where(f"DATE(o_orderdate) = DATE'{run.ds}'").createOrReplaceTempView(f"orders_{run.ds_nodash}")
    orders.createOrReplaceTempView("orders")
    by_name = jobs.backfill(spark, ExportSpec("N", "SELECT * FROM orders_{ds_nodash}"), "1998-06-01", "1998-06-03", f"{tmp_root}/a")
    by_scan = jobs.backfill(spark, ExportSpec("N", "SELECT * FROM orders WHERE DATE(o_orderdate) = DATE'{ds}'"), "1998-06-01", "1998-06-03", f"{tmp_root}/b")
    joined = jobs.backfill(spark, ExportSpec("N", "SELECT * FROM orders WHERE DATE(o_orderdate) = :ds"), "1998-06-01", "1998-06-03", f"{tmp_root}/c")
    rows = lambda res: [(r.folder_date, r.rows, read_export(spark, r.path, orders.schema).count()) for r in res]
    assert rows(by_name) == rows(by_scan) == rows(joined) and sum(r.rows for r in joined) > 0
