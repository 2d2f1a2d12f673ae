"""Plan shapes that matter at scale: pushdown, pruning, partial aggregation, no Python
evaluation in hot paths, bounded broadcasts, one parse per log line."""

import datetime as dt

from tests.conftest import SF
from tidewater.plans import catalog as C
from tidewater.sources.files import RIDE_SCHEMA, read_rides


def plan(capsys, df) -> str:
    df.explain()
    return capsys.readouterr().out


def test_filter_and_projection_reach_the_scan(spark, capsys):
    p = plan(capsys, C.kv_lookup(spark, SF))
    assert "EqualTo(o_custkey,10)" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in p
    p = plan(capsys, C.proj_select(spark, SF))
    assert "ReadSchema: struct<c_name:string,c_mktsegment:string>" in p


def test_word_count_is_partial_and_jvm_only(spark, capsys):
    p = plan(capsys, C.wordcount_regex(spark, SF))
    assert "partial_count" in p and "Generate explode" in p
    assert "EvalPython" not in p
    assert "ReadSchema: struct<text:string>" in p


def test_log_parse_runs_the_pattern_in_one_projection(spark, capsys):
    p = plan(capsys, C.log_parse(spark, SF))
    assert "Generate inline" in p
    assert not [ln for ln in p.splitlines() if "Filter" in ln and "regexp" in ln]


def test_bounded_broadcasts(spark, capsys):
    assert "BroadcastHashJoin" in plan(capsys, C.gold_access(spark, SF))
    assert "BroadcastHashJoin" in plan(capsys, C.most_active_per_weekday(spark, SF))
    assert plan(capsys, C.rides_terminal_hourly(spark, SF)).count("BroadcastHashJoin") == 2


def test_top_k_is_bounded_per_task(spark, capsys):
    assert "TakeOrderedAndProject" in plan(capsys, C.topk_users(spark, SF))
    assert "TakeOrderedAndProject" in plan(capsys, C.topk_distinct_key(spark, SF))


def test_ride_reader_gzip_csv(spark, tmp_path):
    t = dt.datetime(2024, 1, 1, 10, 0)
    df = spark.createDataFrame([(1, True, t, t, -73.78, 40.64, -73.98, 40.75)], RIDE_SCHEMA)
    path = str(tmp_path / "rides")
    df.write.option("compression", "gzip").csv(path)
    assert any(f.endswith(".gz") for f in __import__("os").listdir(path))
    back = read_rides(spark, path, fmt="csv")
    assert [tuple(r) for r in back.collect()] == [tuple(r) for r in df.collect()]


def test_bounded_broadcast_only_below_the_bound(spark, capsys):
    from tidewater.operators.relational import bounded_broadcast
    big = spark.range(1000).withColumnRenamed("id", "k")
    small = spark.range(5).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hinted = plan(capsys, big.join(bounded_broadcast(small, 5), "k"))
        plain = plan(capsys, big.join(bounded_broadcast(small, 10**6), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in hinted
    assert "BroadcastHashJoin" not in plain


def test_no_terminal_filter_under_the_watermark(spark, capsys):
    from tidewater.operators import rides as R
    from tidewater.plans import derive as D
    from tidewater.sources.tables import stream_table
    rides = R.with_terminals(D.rides_from_events(stream_table(spark, "/root/testdata/sf0.001", "events")), spark)
    for departures in (False, True):
        capsys.readouterr()
        R.terminal_hourly(rides, departures, watermark="60 seconds").explain(True)
        text = capsys.readouterr().out
        optimized = text[text.index("== Optimized"):text.index("== Physical")]
        below = optimized[optimized.index("EventTimeWatermark"):]
        assert "isnotnull(start_terminal" not in below and "isnotnull(end_terminal" not in below and "is_start" in below
        assert not any("Filter" in line and "terminal" in line for line in below.splitlines())


def test_round_does_not_sort_cached_edges(spark, capsys):
    from pyspark.sql import functions as F
    from tidewater.operators import graph as G
    e = spark.range(1000).select((F.col("id") % 100).alias("src"), F.col("id").alias("dst"))
    adjacency = G.Adjacency(e)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(capsys, adjacency.sent(spark.range(100).withColumnRenamed("id", "src")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = text.splitlines()
    at = next(i for i, line in enumerate(lines) if "InMemoryTableScan" in line)
    assert not any("Sort [" in line or "Exchange" in line for line in lines[at - 2:at])
    assert adjacency.blocks.count() == 100  # a row per source, not per edge
    adjacency.release()
