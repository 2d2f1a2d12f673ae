import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF, rows
from tidewater.plans import catalog as C
from tidewater.session import scratch_path
from tidewater.streaming import runner as SR
from tidewater.streaming.windows import present_window, tumbling


def test_late_rows_dropped(spark, tmp_path):
    src = str(tmp_path / "in")
    schema = "ts timestamp, k string"
    t0 = dt.datetime(2024, 1, 1, 12, 0)
    spark.createDataFrame([(t0, "a"), (t0 + dt.timedelta(hours=3), "a")], schema).coalesce(1) \
        .write.mode("append").parquet(src + "/b1")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(src)
    agg = tumbling(stream.withWatermark("ts", "2 seconds"), "ts", ["k"])
    out, ck = scratch_path(spark, "late-out"), scratch_path(spark, "late-ck")
    q = agg.writeStream.format("parquet").outputMode("append").option("path", out) \
        .option("checkpointLocation", ck).trigger(availableNow=True).start()
    q.awaitTermination()
    # second batch: a row 2.5 hours behind the watermark
    spark.createDataFrame([(t0 + dt.timedelta(minutes=30), "a")], schema).coalesce(1).write.mode("append").parquet(src + "/b2")
    q = agg.writeStream.format("parquet").outputMode("append").option("path", out) \
        .option("checkpointLocation", ck).trigger(availableNow=True).start()
    q.awaitTermination()
    dropped = sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"])
    assert dropped == 1
    got = rows(present_window(spark.read.parquet(out)), "window_start", "n")
    assert got == [(t0, 1)]


def test_stream_multi_sink(spark):
    ev = C._t(spark, SF, "events")
    from tidewater.sources.tables import stream_table
    s = stream_table(spark, SF, "events")
    counts = SR.run_update_log(s.groupBy("event_type").count(), spark, "multi-a", keys=["event_type"])
    users = SR.run_update_log(s.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")), spark, "multi-b", keys=["user_id"])
    assert rows(counts) == rows(ev.groupBy("event_type").count())
    assert rows(users) == rows(ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")))


def test_streams_equal_batch_on_all_windows(spark):
    assert rows(C.stream_terminal_events_hourly(spark, SF)) == rows(C.rides_terminal_hourly(spark, SF))
    assert rows(C.stream_busiest_per_hour(spark, SF)) == rows(C.rides_busiest_hour(spark, SF))
    assert rows(C.stream_busiest_departures_hour(spark, SF)) == rows(C.rides_busiest_departures_hour(spark, SF))
    assert rows(C.stream_rides_hourly(spark, SF)) == rows(C.rides_both_endpoints(spark, SF))


@pytest.mark.parametrize("departures", [False, True])
def test_watermark_follows_every_ride(spark, tmp_path, departures):
    """A ride away from the terminals three hours later closes the terminal's window."""
    from tidewater.operators import rides as R
    t = dt.datetime(2024, 1, 1, 10, 30)
    late = t + dt.timedelta(hours=3)
    schema = ("ride_id long, is_start boolean, start_time timestamp, end_time timestamp, start_terminal string, "
              "end_terminal string")
    src = str(tmp_path / "rides")
    for part in ([(1, True, t, t, "TERMINAL_1", None), (2, True, t, t, "TERMINAL_2", None)], [(3, True, late, late, None, None)],
                 [(4, True, late, late, None, None)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    hourly = R.terminal_hourly(stream, departures, watermark="60 seconds")
    got = SR.run_append(hourly, spark, "probe")
    assert [(r.terminal, r.n) for r in got.orderBy("terminal").collect()] == [("TERMINAL_1", 1), ("TERMINAL_2", 1)]


def test_time_out_raises(spark):
    from tidewater.sources.tables import stream_table
    docs = stream_table(spark, SF, "documents").select("doc_id")
    with pytest.raises(TimeoutError):
        SR.run_append(docs, spark, "too-late", timeout_s=0.001)


def test_stream_wordcount_equals_batch(spark):
    assert rows(C.stream_wordcount(spark, SF)) == rows(C.wordcount_regex(spark, SF))


def test_stream_fanout_one_read(spark):
    from tidewater.operators import rides as R
    from tidewater.plans import derive as D
    from tidewater.sources.tables import stream_table
    s = R.with_terminals(D.rides_from_events(stream_table(spark, SF, "events")), spark)
    outs = SR.run_fanout(s, spark, "fanout", {
        "events": lambda b: R.terminal_events(b).select("ride_id", "terminal", "n", "hour"),
        "either": lambda b: R.either_endpoint(b),
        "starts": lambda b: R.start_at_terminal(b),
    })
    batch = C._rides_t(spark, SF)
    assert rows(outs["events"]) == rows(R.terminal_events(batch).select("ride_id", "terminal", "n", "hour"))
    assert rows(outs["either"]) == rows(R.either_endpoint(batch))
    assert rows(outs["starts"]) == rows(R.start_at_terminal(batch))


def test_update_mode_yields_all_windows(spark):
    from tidewater.operators import rides as R
    from tidewater.plans import derive as D
    from tidewater.sources.tables import stream_table
    s = R.with_terminals(D.rides_from_events(stream_table(spark, SF, "events")), spark)
    hourly = R.terminal_hourly(s, watermark="60 seconds")
    out = SR.run_update_log(hourly, spark, "hourly-update", keys=["window", "terminal"])
    got = rows(R.report(out, "terminal", "hour", "n"))
    assert got == rows(C.rides_terminal_hourly(spark, SF))


def test_text_stream_wordcount(spark, tmp_path):
    from tidewater.operators import text as T
    from tidewater.sources.files import read_text_stream
    src = tmp_path / "lines"
    src.mkdir()
    (src / "a.txt").write_text("To be, or not to be\nthat is the question\n")
    (src / "b.txt").write_text("Whether 'tis nobler in the mind to suffer\n")
    stream = read_text_stream(spark, str(src), "text", maxFilesPerTrigger=1)
    got = SR.run_update_log(T.word_count(stream, "words"), spark, "text-stream", keys=["word"])
    want = T.word_count(spark.read.text(str(src)), "words")
    assert rows(got) == rows(want)
    assert dict(rows(got))["to"] == 3
