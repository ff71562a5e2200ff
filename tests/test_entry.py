import __spark_entry__ as E

from table_paths import SF_SMALL


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 8  # 7-day inclusive look-back ending 1998-06-08 at sf0.001
    assert "o_orderkey" in df.columns


def test_every_query_has_a_name_and_most_have_sql():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert set(E.QUERIES) <= set(s)


def test_queries_run_at_small_scale(spark):
    # the cheap (non-file) queries, end to end at sf0.001
    for name in ("sync_verdict", "storage_summary_total", "side_comparison", "human_size", "listing_order"):
        assert E.queries()[name](spark, SF_SMALL).count() > 0


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    import types

    import pytest

    from parcel import session

    context = types.SimpleNamespace(getCheckpointDir=lambda: None, master="yarn", setCheckpointDir=None)
    asked = types.SimpleNamespace(sparkContext=context, conf=types.SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(asked)
