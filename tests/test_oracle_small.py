"""A cross-section of queries against their SQL oracles on the sf0.001 tables."""

import duckdb
import pytest

import __spark_entry__ as E
from scripts.oracle_check import TABLES, digest
from tests.conftest import SF

NAMES = ["log_parse", "log_rejects", "status_share", "most_active_per_weekday", "wordcount_stripped",
         "topk_long_words", "topk_distinct_key", "kv_reduce_general", "cogroup_lists", "join_full",
         "group_count_null_key", "rides_both_endpoints", "rides_busiest_departures_hour", "graph_triangles",
         "graph_user_degrees", "pagerank_join_iterative"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)
