"""Streams over any file layout, chained windows, late rows, joins and running totals."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF, rows
from tidewater.operators import rides as R
from tidewater.plans import catalog as C
from tidewater.session import scratch_path
from tidewater.sources.tables import stream_table
from tidewater.streaming import joins as SJ
from tidewater.streaming import late as SL
from tidewater.streaming import runner as SR
from tidewater.streaming import totals as ST
from tidewater.streaming.replay import Replay

T0 = dt.datetime(2024, 1, 1, 12, 0)


def minutes(n):
    return T0 + dt.timedelta(minutes=n)


@pytest.fixture(scope="module")
def folder(spark):
    """The tables of ``SF`` as folders of part files."""
    path = scratch_path(spark, "folder-tables")
    for name in ("events", "documents"):
        spark.read.parquet(f"{SF}/{name}.parquet").repartition(3).write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.mark.parametrize("stream, batch", [
    ("stream_terminal_events", "rides_terminal_events"), ("stream_terminal_events_hourly", "rides_terminal_hourly"),
    ("stream_busiest_per_hour", "rides_busiest_hour"), ("stream_busiest_departures_hour", "rides_busiest_departures_hour"),
    ("stream_rides_hourly", "rides_both_endpoints"), ("stream_wordcount", "wordcount_regex"),
    ("stream_chained_busiest", "rides_busiest_hour"), ("stream_rides_gzip", "rides_both_endpoints")])
def test_streams_over_a_folder_equal_batch(spark, folder, stream, batch):
    got = rows(C.QUERIES[stream](spark, folder))
    assert got and got == rows(C.QUERIES[batch](spark, SF))


def test_missing_or_empty_tables_raise(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        stream_table(spark, str(tmp_path), "events")
    (tmp_path / "events.parquet").mkdir()
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA"):
        stream_table(spark, str(tmp_path), "events")


def test_closed_windows_equal_batch(spark):
    assert rows(C.stream_chained_busiest_departures(spark, SF)) == rows(C.rides_busiest_departures_hour(spark, SF))


def test_arrivals_follow_the_order(spark):
    df = spark.createDataFrame([(i, minutes(i * 7)) for i in range(50)] + [(99, None)], "id long, at timestamp").repartition(4)
    replay = Replay(df, "at", "order", 4, end_cols=("at",))
    seen: list[set] = []
    stream = replay.stream()
    SR.run_batches(stream, spark, "order", {}, lambda b, _: seen.append({r.id for r in b.collect()}) or {}, arrivals=replay.arrivals())
    assert len(seen) == 6 and seen[0] >= {99, 0} and seen[4:] == [{None}, {None}]
    assert set().union(*seen[:4]) == {*range(50), 99}
    slots = [s - {99} for s in seen[:4]]
    assert all(max(a) < min(b) for a, b in zip(slots, slots[1:]))


def test_three_tasks_read_one_source(spark):
    replay = C._arriving_rides(spark, SF, "tasks-plan")
    hourly = R.tagged_hourly(R.with_terminals(replay.stream(), spark), "60 seconds")
    plan = hourly._jdf.queryExecution().analyzed().toString()
    assert plan.count("StreamingRelation") == 1 and plan.count("Aggregate") == 1
    got = C.stream_three_tasks(spark, SF)
    for result, batch in (("terminal visits", "rides_terminal_hourly"), ("busiest", "rides_busiest_hour"),
                          ("busiest departures", "rides_busiest_departures_hour")):
        want = C.QUERIES[batch](spark, SF)
        assert rows(got.where(F.col("result") == result).select(*want.columns)) == rows(want), result


def test_late_rows_and_their_watermark(spark):
    """Three arrivals; a row is late once the maximum so far less ten minutes has passed its hour."""
    df = spark.createDataFrame([
        (1, minutes(0), 0), (2, minutes(69), 0), (3, None, 0),
        (4, minutes(50), 10), (5, minutes(130), 10),
        (6, minutes(59), 20), (7, minutes(60), 20), (8, minutes(125), 20)], "id long, at timestamp, came int")
    replay = Replay(df, "came", "late", 3)
    on_time, late = SL.run_with_late(replay.stream(), spark, "late", "at", "10 minutes", arrivals=replay.arrivals())
    assert rows(late, "id", "window_start", "watermark") == [(6, T0, minutes(120)), (7, minutes(60), minutes(120))]
    assert [r[0] for r in rows(on_time, "id")] == [1, 2, 4, 5, 8]
    counts = {r.window_start: (r.on_time, r.late) for r in SL.late_counts(on_time, late).collect()}
    assert counts == {T0: (2, 1), minutes(60): (1, 1), minutes(120): (2, 0)}


def test_late_side_output_agrees_with_the_aggregate(spark):
    """Rows that Spark's own windowed count drops are the ones of the side output."""
    df = spark.createDataFrame([(1, minutes(0), 0), (2, minutes(300), 0), (3, minutes(1), 10), (4, minutes(301), 10),
                                (5, minutes(2), 20), (6, minutes(900), 20), (7, minutes(1500), 30)], "id long, at timestamp, came int")
    a, b = (Replay(df, "came", n, 4) for n in ("agree-a", "agree-b"))
    on_time, late = SL.run_with_late(a.stream(), spark, "agree", "at", "1 minute", arrivals=a.arrivals())
    counted = SR.run_update_log(b.stream().withWatermark("at", "1 minute").groupBy(F.window("at", "1 hour")).count(), spark, "agree-count",
                                keys=["window"], arrivals=b.arrivals())
    assert {r.id for r in late.collect()} == {3, 5}
    assert counted.agg(F.sum("count")).first()[0] == on_time.count() == 5


def trips(spark):
    starts = [(i, minutes(i * 10), i % 3) for i in range(40)]
    ends = [(i, minutes(i * 10 + (i % 5) * 2), i % 4) for i in range(40) if i % 7]
    return (spark.createDataFrame(starts, "trip long, start_time timestamp, a int"),
            spark.createDataFrame(ends, "trip long, end_time timestamp, b int"), starts, ends)


@pytest.mark.parametrize("how", ["inner", "leftOuter"])
def test_interval_join_of_two_streams(spark, how):
    left, right, starts, ends = trips(spark)
    by = {t: (e, b) for t, e, b in ends}
    want = []
    for t, s, a in starts:
        e, b = by.get(t, (None, None))
        if e is None or e > s + dt.timedelta(minutes=5):
            e = b = None
        if e is not None or how == "leftOuter":
            want.append((t, s, a, e, b))
    far = [minutes(10_000), minutes(20_000)]
    lsrc, rsrc = scratch_path(spark, "left"), scratch_path(spark, "right")
    for d, p in ((left, lsrc), (right, rsrc)):
        d.limit(0).write.parquet(p)
    ls, rs = (spark.readStream.schema(d.schema).parquet(p) for d, p in ((left, lsrc), (right, rsrc)))

    def arrivals():
        for lo in (0, 100, 200, 300):
            here = lambda c: (F.col(c) >= F.lit(minutes(lo))) & (F.col(c) < F.lit(minutes(lo + 100)))
            left.where(here("start_time")).write.mode("append").parquet(lsrc)
            right.where(here("end_time")).write.mode("append").parquet(rsrc)
            yield
        for at in far:
            spark.createDataFrame([(-1, at, 0)], left.schema).write.mode("append").parquet(lsrc)
            spark.createDataFrame([(-1, at, 0)], right.schema).write.mode("append").parquet(rsrc)
            yield

    joined = SJ.interval_join(ls, rs, ["trip"], "start_time", "end_time", "5 minutes", how)
    plan = joined._jdf.queryExecution().analyzed().toString()
    assert plan.count("EventTimeWatermark") == 2
    got = SR.run_append(joined, spark, "trips", arrivals=arrivals())
    assert rows(got.where("trip >= 0")) == sorted(want, key=lambda t: t[0])


def test_join_state_is_dropped(spark):
    """Rows that can have no partner any more leave the state."""
    replay = C._arriving(spark, SF, "state")
    starts, ends = C.D.trip_ends(replay.stream())
    joined = SJ.interval_join(starts, ends, ["trip"], "start_time", "end_time", "4 minutes")
    out, ckpt = scratch_path(spark, "state-out"), scratch_path(spark, "state-ckpt")
    kept = []
    for _ in replay.arrivals():
        q = joined.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
        q.awaitTermination()
        kept.append(q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    assert kept[-1] <= 4 and max(kept) < 0.6 * spark.read.parquet(f"{SF}/events.parquet").count(), kept


def test_cogroup_of_two_streams(spark):
    left, right, starts, ends = trips(spark)
    a = left.select(F.col("start_time").alias("at"), F.col("a").alias("k"), "trip")
    b = right.select(F.col("end_time").alias("at"), F.col("b").alias("k"), "trip")
    ra, rb = (Replay(d, "at", n, 2, end_cols=("at",)) for d, n in ((a, "co-a"), (b, "co-b")))
    grouped = SJ.window_cogroup(ra.stream(), rb.stream(), "k", F.col("trip"), F.col("trip"), "at")
    got = SR.run_append(grouped, spark, "cogroup", arrivals=(None for _ in zip(ra.arrivals(), rb.arrivals())))
    want = {}
    for side, table in enumerate((starts, ends)):
        for t, at, k in table:
            hour = at.replace(minute=0)
            want.setdefault((hour, k), ([], []))[side].append(str(t))
    found = {(r.window.start, r.k): (r.left_values, r.right_values) for r in got.where("k IS NOT NULL").collect()}
    assert found == {k: (sorted(x), sorted(y)) for k, (x, y) in want.items()}


@pytest.mark.parametrize("range_rows", [7, 50_000])
def test_running_totals_per_record(spark, range_rows):
    """Half of the records on one key, null keys and null times, ties in the order column."""
    rng = random.Random(5)
    data = [(i, rng.choice(["hot", "hot", "hot", "a", "b", None]), None if i % 40 == 3 else rng.randrange(300), rng.randrange(5)) for i in range(400)]
    df = spark.createDataFrame(data, "id long, k string, at long, n long").repartition(5)
    replay = Replay(df, "at", "totals", 3)
    got = ST.run_running_total(replay.stream(), spark, "totals", "k", "n", ["at", "id"], "total", replay.arrivals(), range_rows=range_rows)
    totals, want = {}, []
    for i, k, at, n in sorted(data, key=lambda r: (r[2] is not None, r[2] or 0, r[0])):
        totals[k] = totals.get(k, 0) + n
        want.append((i, totals[k]))
    assert rows(got, "id", "total") == sorted(want)


def test_running_total_of_words_is_the_word_count_at_the_end(spark):
    last = C.stream_running_wordcount(spark, SF).groupBy("word").agg(F.max("count").alias("count"))
    assert rows(last) == rows(C.wordcount_regex(spark, SF))


def test_running_totals_find_ranges_by_binary_search(spark):
    """Work per record does not grow with the number of ranges, and the records are shuffled once; values
    that are null add nothing and null keys are a key."""
    df = spark.createDataFrame([(i, None if i % 3 else "k", i, None if i % 7 == 0 else 1) for i in range(2000)], "id long, k string, at long, n long")
    none = spark.createDataFrame([], "key string, total long")
    found, after = ST.running(df, "k", "n", ["at", "id"], none, "total", range_rows=20)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "filter(" not in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan and plan.count("Exchange hashpartitioning") == 1
    totals, want = {}, []
    for i in range(2000):
        k = None if i % 3 else "k"
        totals[k] = totals.get(k) if i % 7 == 0 else (totals.get(k) or 0) + 1
        want.append((i, totals[k]))
    key = lambda r: (r[0], r[1] or 0)
    assert sorted(rows(found, "id", "total"), key=key) == want
    assert {r.key: r.total for r in after.collect()} == totals
