import importlib

from tests.conftest import SF


def test_entry_and_registry(spark):
    E = importlib.import_module("__spark_entry__")
    df = E.entry(spark)
    assert df.columns == ["window_start", "event_type", "n"]
    assert df.count() > 0
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    own = {n for n in q if not n.startswith("op") and n != "pipeline"}
    assert own <= set(sql)
    assert len(own) >= 99


def test_every_query_plans(spark):
    """Every registered query resolves on the smallest tables (plans only, no run)."""
    E = importlib.import_module("__spark_entry__")
    skip = {n for n in E.queries() if n.startswith(("stream_", "pagerank_", "graph_components", "graph_subgraph_comp",
                                                     "graph_bfs", "src_", "sink_", "graph_load", "graph_edges_distinct",
                                                     "sql_filter_range", "proj_concat", "src_delimited",
                                                     "op", "pipeline"))}  # the last two run in their own tests
    for name, fn in E.queries().items():
        if name in skip:
            continue
        assert fn(spark, SF).schema is not None, name
