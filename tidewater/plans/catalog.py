"""Named queries: ``(spark, sf_dir) -> DataFrame`` over the driver tables.

Each query is the operator applied to a whole table (or to data Spark derives from
one); ``oracle.py`` holds an independent SQL statement for each name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udtf, pandas_udf
from pyspark.sql.types import IntegerType

from tidewater.functions.clf import CLF_FIELDS
from tidewater.functions.tokens import NON_WORD, word_tokens
from tidewater.operators import graph as G
from tidewater.operators import keyed as K
from tidewater.operators import logs as L
from tidewater.operators import rides as R
from tidewater.operators import text as T
from tidewater.operators import topk as TK
from tidewater.plans import derive as D
from tidewater.session import ensure_utc, scratch_path
from tidewater.sources import files as SF
from tidewater.sources import sinks as SK
from tidewater.sources.tables import load_table, spread, stream_table
from tidewater.streaming import joins as SJ
from tidewater.streaming import late as SL
from tidewater.streaming import runner as SR
from tidewater.streaming import totals as ST
from tidewater.streaming.replay import Replay
from tidewater.streaming.windows import busiest_per_window, present_window, tumbling

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return load_table(spark, sf, name)


def _log_lines(spark: SparkSession, sf: str) -> DataFrame:
    return spread(D.log_lines(_t(spark, sf, "events")))


def _logs(spark: SparkSession, sf: str, *fields: str) -> DataFrame:
    return L.parse_clf(_log_lines(spark, sf), fields=list(fields or CLF_FIELDS))[0]


def _logs_day(spark: SparkSession, sf: str) -> DataFrame:
    return L.with_weekday(_logs(spark, sf, "ipAddress", "dateTime"))


def _rides_t(spark: SparkSession, sf: str) -> DataFrame:
    return R.with_terminals(D.rides_from_events(_t(spark, sf, "events")), spark)


def _rank_key(col: str = "rank") -> F.Column:
    # Sums of doubles differ in the last bits with the order of addition; compare
    # ranks at 1e-6 with an offset that keeps exact rational ranks off the boundary.
    return F.floor(F.col(col) * 1e6 + 0.137).cast("bigint").alias("rank_e6")


# ================================================================ sources and sinks

@query
def src_text(spark, sf):
    """Documents written as text files and read back: one row per line."""
    path = scratch_path(spark, "docs-text")
    SK.write_text(_t(spark, sf, "documents").select("text"), path)
    return SF.read_text(spark, path)


@query
def src_json(spark, sf):
    cust = _t(spark, sf, "customer")
    path = scratch_path(spark, "customer-json")
    cust.write.mode("overwrite").json(path)
    return SF.read_json(spark, path, schema=cust.schema)


@query
def src_json_inferred(spark, sf):
    path = scratch_path(spark, "orders-json")
    _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice").write.json(path)
    return SF.read_json(spark, path)


def _people(spark, sf) -> DataFrame:
    """``name, age`` lines with a blank after the comma, read as delimited text."""
    path = scratch_path(spark, "people")
    lines = _t(spark, sf, "customer").select(
        F.concat(F.col("c_name"), F.lit(", "), F.col("c_nationkey").cast("string")).alias("value"))
    SK.write_text(lines, path)
    return SF.read_delimited(spark, path, "name string, age int")


@query
def src_delimited(spark, sf):
    return _people(spark, sf)


@query
def src_vertices(spark, sf):
    """Vertices written as ``id,name`` lines and read back."""
    path = scratch_path(spark, "vertices")
    SK.write_text(_t(spark, sf, "part").select(F.concat_ws(",", F.col("p_partkey").cast("string"), "p_name").alias("value")), path)
    return SF.read_vertices(spark, path)


@query
def repartitioned(spark, sf):
    """Lines of orders dealt over seven partitions: how many there are, how many hold rows, and the rows."""
    dealt = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").repartition(7)
    return dealt.withColumn("p", F.spark_partition_id()).agg(
        F.lit(dealt.rdd.getNumPartitions()).alias("partitions"), F.count_distinct("p").alias("used"), F.count(F.lit(1)).alias("n"))


@query
def sink_text_roundtrip(spark, sf):
    path = scratch_path(spark, "sink-text")
    cust = _t(spark, sf, "customer")
    SK.write_text(cust.select(F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name").alias("value")), path)
    return SF.read_text(spark, path)


@query
def sink_tsv_roundtrip(spark, sf):
    path = scratch_path(spark, "sink-tsv")
    counts = _t(spark, sf, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.count(F.lit(1)).alias("value"))
    SK.write_tsv(counts, path)
    return SK.read_tsv(spark, path, "key bigint, value bigint")


# ================================================================ projections and filters

@query
def proj_select(spark, sf):
    return _t(spark, sf, "customer").select("c_name", "c_mktsegment")


@query
def proj_arith(spark, sf):
    return _t(spark, sf, "customer").select("c_name", (F.col("c_acctbal") + 1).alias("acctbal_plus_one"))


@query
def proj_concat(spark, sf):
    """SQL result used as a row source of labelled lines."""
    return sql_filter_range(spark, sf).select(F.concat(F.lit("customer/"), F.col("c_name")).alias("line"))


@query
def sql_filter_range(spark, sf):
    return spark.sql("SELECT c_name, c_acctbal FROM {customers} WHERE c_acctbal >= :low AND c_acctbal <= :high",
                     args={"low": 1500, "high": 4200}, customers=_t(spark, sf, "customer"))


@query
def sql_filter_eq(spark, sf):
    return L.requests_with_status(spark, _logs(spark, sf, "ipAddress", "method", "endpoint", "responseCode"), "requests", 403)


@query
def filter_predicate(spark, sf):
    return _t(spark, sf, "orders").filter(F.col("o_totalprice") > 250000).select("o_orderkey", "o_totalprice")


@query
def map_scalar(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.pow("l_quantity", 2).alias("sq"))


def _ranges(spark, sf) -> DataFrame:
    li = _t(spark, sf, "lineitem")
    x = F.col("l_linenumber").cast("bigint")
    arr = F.when(x > 0, F.sequence(F.lit(0).cast("bigint"), x - 1)).otherwise(F.array().cast("array<bigint>"))
    return li.select("l_orderkey", "l_linenumber", arr.alias("xs"))


@query
def map_to_array(spark, sf):
    return _ranges(spark, sf)


@query
def flatmap_range(spark, sf):
    return _ranges(spark, sf).select("l_orderkey", "l_linenumber", F.explode("xs").alias("x"))


# ================================================================ key-value

def _kv(spark, sf) -> DataFrame:
    return _t(spark, sf, "customer").select(F.col("c_name").alias("k"), F.col("c_nationkey").alias("v"))


@query
def kv_keys_values(spark, sf):
    return K.keys_values(_kv(spark, sf), "k", "v")


@query
def kv_map_both(spark, sf):
    kv = _kv(spark, sf)
    return kv.select(F.concat("k", F.lit("/next")).alias("k"), (F.col("v") + 1).alias("v"))


@query
def kv_map_values(spark, sf):
    return K.map_values(_kv(spark, sf), "v", lambda v: F.pow(v, 2))


@query
def kv_lookup(spark, sf):
    return K.lookup(_t(spark, sf, "orders"), "o_custkey", "o_orderkey", 10)


@query
def kv_group_list(spark, sf):
    return K.group_list(_t(spark, sf, "lineitem"), "l_orderkey", "l_partkey", out="parts")


@query
def kv_reduce_sum(spark, sf):
    return K.reduce_sum(_t(spark, sf, "lineitem"), "l_suppkey", "l_quantity", out="total")


@query
def kv_reduce_general(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_suppkey", F.col("l_quantity").cast("bigint").alias("q"))
    return K.reduce_by_key(li, "l_suppkey", "q", lambda a, b: a + b, out="total")


@query
def kv_reduce_builtin(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_suppkey", F.col("l_partkey").cast("bigint").alias("p"))
    return K.reduce_by_key(li, "l_suppkey", "p", "bit_xor", out="mixed")


@query
def kv_as_map(spark, sf):
    return K.as_map(_t(spark, sf, "lineitem"), "l_orderkey", "l_linenumber", "l_partkey", out="parts")


@query
def cogroup_lists(spark, sf):
    li = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("orderkey"), "l_linenumber")
    od = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_orderstatus")
    return K.cogroup_lists(li, od, "orderkey", "l_linenumber", "o_orderstatus")


@query
def sample_n(spark, sf):
    return K.sample_n(_t(spark, sf, "customer").select("c_custkey", "c_name"), 10, "c_custkey", seed=7)


# ================================================================ joins

# Joins pair an order with the customer this many keys before its own, so both tables keep
# rows without a partner.
SHIFT = 50


def _join(spark, sf, how: str) -> DataFrame:
    c = _t(spark, sf, "customer").select("c_custkey", "c_name")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return c.join(o, c["c_custkey"] + SHIFT == o["o_custkey"], how)


@query
def join_inner(spark, sf):
    return _join(spark, sf, "inner")


@query
def join_left(spark, sf):
    return _join(spark, sf, "left")


@query
def join_right(spark, sf):
    return _join(spark, sf, "right")


@query
def join_full(spark, sf):
    return _join(spark, sf, "full")


@query
def join_left_semi(spark, sf):
    return _join(spark, sf, "left_semi")


@query
def join_left_anti(spark, sf):
    return _join(spark, sf, "left_anti")


# ================================================================ aggregates

@query
def agg_count(spark, sf):
    return _t(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query
def group_count_null_key(spark, sf):
    """Orders counted by the nation of the customer ``SHIFT`` keys before theirs; orders
    without one form the null group."""
    o = _t(spark, sf, "orders")
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return o.join(c, o["o_custkey"] == c["c_custkey"] + SHIFT, "left").groupBy("c_nationkey").count()


# ================================================================ text

def _docs(spark, sf) -> DataFrame:
    return spread(_t(spark, sf, "documents").select(F.col("text").alias("value")))


@query
def wordcount_whitespace(spark, sf):
    return T.word_count(_docs(spark, sf), "whitespace")


@query
def wordcount_regex(spark, sf):
    return T.word_count(_docs(spark, sf), "words")


@query
def wordcount_stripped(spark, sf):
    return T.word_count(_docs(spark, sf), "stripped")


@query
def wordcount_vocab(spark, sf):
    return T.vocabulary_size(T.word_count(_docs(spark, sf), "stripped"))


@query
def topk_words(spark, sf):
    return T.top_words(T.word_count(_docs(spark, sf), "stripped"), 20)


@query
def topk_long_words(spark, sf):
    return T.top_long_words(T.word_count(_docs(spark, sf), "stripped"), 20, 5)


TOKEN_BYTES = 1 << 20


@arrow_udtf(returnType="word string")
class WordTokens:
    """Row-generating function form of the lower-case word tokenizer: a table in, Arrow batch by
    Arrow batch, any number of rows out, without a row of Python. A batch has a number of texts of any
    length, so its words come in tables of the texts that have about ``TOKEN_BYTES``."""

    def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
        text = batch.column("text")
        ends = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        lo = 0
        while lo < len(text):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + TOKEN_BYTES, "right")))
            words = pc.list_flatten(pc.split_pattern_regex(pc.utf8_lower(text.slice(lo, hi - lo)), NON_WORD))
            yield pa.table({"word": words.filter(pc.not_equal(words, ""))})
            lo = hi


@query
def udtf_tokenize(spark, sf):
    docs = spread(_t(spark, sf, "documents").select("text"))
    return WordTokens(docs.asTable()).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


# ================================================================ access log

@query
def log_parse(spark, sf):
    return _logs(spark, sf)


@query
def log_rejects(spark, sf):
    return L.parse_clf(_log_lines(spark, sf))[1]


@query
def agg_distinct_clients(spark, sf):
    return L.distinct_clients(_logs(spark, sf, "ipAddress"))


@query
def agg_min_avg_max(spark, sf):
    return L.content_size_stats(_logs(spark, sf, "contentSize"))


@query
def status_counts(spark, sf):
    return L.status_counts(_logs(spark, sf, "responseCode"))


@query
def status_share(spark, sf):
    return L.status_share(_logs(spark, sf, "responseCode"))


@query
def status_class_counts(spark, sf):
    return L.status_class_counts(_logs(spark, sf, "responseCode"))


@query
def topk_users(spark, sf):
    return L.top_clients(_logs(spark, sf, "ipAddress"), 10)


@query
def weekday_counts(spark, sf):
    return L.weekday_counts(_logs_day(spark, sf))


@query
def access_by_user_weekday(spark, sf):
    return L.access_by_user_weekday(_logs_day(spark, sf))


@query
def gold_access(spark, sf):
    return L.gold_access(_logs_day(spark, sf), 10)


@query
def group_max(spark, sf):
    return L.max_count_per_weekday(_logs_day(spark, sf))


@query
def most_active_per_weekday(spark, sf):
    return L.most_active_per_weekday(_logs_day(spark, sf))


@pandas_udf(IntegerType())
def weekday_udf(date_time: pd.Series) -> pd.Series:
    """Vectorised weekday of ``dd/Mon/yyyy:HH:MM:SS ±hhmm`` in the line's own offset."""
    return pd.to_datetime(date_time.str.slice(0, 11), format="%d/%b/%Y").dt.weekday.astype("int32")


@query
def udf_weekday(spark, sf):
    return _logs(spark, sf, "dateTime").select("dateTime", weekday_udf("dateTime").alias("dayOfWeek"))


# ================================================================ top-k over attribute lines

def _records(spark, sf) -> DataFrame:
    return TK.scored_records(D.attribute_lines(_t(spark, sf, "customer")))


@query
def xml_attributes(spark, sf):
    lines = D.attribute_lines(_t(spark, sf, "customer"))
    v = F.col("value")
    return lines.select(TK.attribute(v, "Id").alias("Id"), TK.attribute(v, "Reputation").alias("Reputation"),
                        TK.attribute(v, "DisplayName").alias("DisplayName"))


@query
def xml_attribute_map(spark, sf):
    """Lines that name ``DisplayName`` twice: the last value stays."""
    lines = D.attribute_lines(_t(spark, sf, "customer"))
    twice = lines.select(F.regexp_replace("value", " />$", ' DisplayName="renamed" />').alias("value"))
    m = F.col("m")
    return twice.select(TK.attribute_map(F.col("value")).alias("m")).select(
        m["Id"].alias("Id"), m["Reputation"].alias("Reputation"), m["DisplayName"].alias("DisplayName"), F.size("m").alias("n"))


@query
def topk_distinct_key(spark, sf):
    return TK.top_distinct_scores(_records(spark, sf), 10)


@query
def topk_records(spark, sf):
    return TK.top_records(_records(spark, sf), 10)


# ================================================================ rides (batch)

@query
def grid_cell(spark, sf):
    return _rides_t(spark, sf).select("ride_id", "start_cell", "end_cell")


@query
def hour_of_day_tz(spark, sf):
    from tidewater.functions.geo import local_hour
    r = D.rides_from_events(_t(spark, sf, "events"))
    return r.select("ride_id", local_hour(F.col("start_time")).alias("start_hour"),
                    local_hour(F.col("end_time")).alias("end_hour"))


@query
def rides_event_time(spark, sf):
    return R.event_time(_rides_t(spark, sf)).select("ride_id", F.col("event_time").cast("timestamp_ntz").alias("event_time"))


@query
def rides_terminal_events(spark, sf):
    return R.terminal_events(_rides_t(spark, sf)).select("ride_id", "terminal", "n", "hour")


@query
def rides_either_endpoint(spark, sf):
    return R.either_endpoint(_rides_t(spark, sf))


@query
def rides_start_at_terminal(spark, sf):
    return R.start_at_terminal(_rides_t(spark, sf))


@query
def rides_both_endpoints(spark, sf):
    return R.report(R.both_endpoints_hourly(_rides_t(spark, sf)), "terminal", "hour", "n")


@query
def rides_first_endpoint(spark, sf):
    return R.first_endpoint(_rides_t(spark, sf))


@query
def rides_terminal_hourly(spark, sf):
    return R.report(R.terminal_hourly(_rides_t(spark, sf)), "terminal", "hour", "n")


@query
def rides_busiest_hour(spark, sf):
    return R.report(R.busiest_terminal(R.terminal_hourly(_rides_t(spark, sf))), "terminal", "hour", "n")


@query
def rides_busiest_departures_hour(spark, sf):
    hourly = R.terminal_hourly(_rides_t(spark, sf), departures_only=True)
    return R.report(R.busiest_terminal(hourly), "terminal", "hour", "n")


@query
def tumbling_count(spark, sf):
    ev = _t(spark, sf, "events")
    return present_window(tumbling(ev, "ts", ["event_type"])).select("window_start", "event_type", "n")


@query
def busiest_per_hour(spark, sf):
    ev = _t(spark, sf, "events")
    out = busiest_per_window(tumbling(ev, "ts", ["event_type"]), key="event_type")
    return present_window(out).select("window_start", "event_type", "n")


# ================================================================ streaming

def _rides_stream(spark, sf) -> DataFrame:
    ensure_utc(spark)
    return R.with_terminals(D.rides_from_events(stream_table(spark, sf, "events")), spark)


def _stream_hourly(spark, sf, name: str, **kw) -> DataFrame:
    """All windows of the finite stream, the last one too: every micro-batch logs the windows
    it changed and the log is merged at the end of the input (append mode would hold back
    the windows the watermark has not passed)."""
    hourly = R.terminal_hourly(_rides_stream(spark, sf), watermark="60 seconds", **kw)
    return SR.run_update_log(hourly, spark, name, keys=["window", "terminal"])


@query
def stream_terminal_events(spark, sf):
    ev = R.terminal_events(_rides_stream(spark, sf)).select("ride_id", "terminal", "n", "hour")
    return SR.run_append(ev, spark, "stream_terminal_events")


@query
def stream_terminal_events_hourly(spark, sf):
    return R.report(_stream_hourly(spark, sf, "stream_terminal_events_hourly"), "terminal", "hour", "n")


@query
def stream_busiest_per_hour(spark, sf):
    hourly = _stream_hourly(spark, sf, "stream_busiest_per_hour")
    return R.report(R.busiest_terminal(hourly), "terminal", "hour", "n")


@query
def stream_busiest_departures_hour(spark, sf):
    hourly = _stream_hourly(spark, sf, "stream_busiest_departures_hour", departures_only=True)
    return R.report(R.busiest_terminal(hourly), "terminal", "hour", "n")


@query
def stream_rides_hourly(spark, sf):
    hourly = R.both_endpoints_hourly(_rides_stream(spark, sf), watermark="2 seconds")
    out = SR.run_update_log(hourly, spark, "stream_rides_hourly", keys=["window", "terminal", "hour"])
    return R.report(out, "terminal", "hour", "n")


@query
def stream_wordcount(spark, sf):
    ensure_utc(spark)
    docs = stream_table(spark, sf, "documents").select(F.col("text").alias("value"))
    counts = T.word_count(docs, "words")
    return SR.run_update_log(counts, spark, "stream_wordcount", keys=["word"])


# Streams that arrive slot by slot in event-time order, closed by end rows (append mode).

def _arriving(spark, sf, name: str, slots: int = 3) -> Replay:
    return Replay(_t(spark, sf, "events").select("event_id", "ts", "user_id"), "ts", name, slots, end_cols=("ts",))


def _arriving_rides(spark, sf, name: str, time=R.record_time, **options) -> Replay:
    """Ride records in the order of ``time``, which the stream's watermark then follows."""
    rides = D.rides_from_events(_t(spark, sf, "events"))
    timed = time(R.with_terminals(rides, spark))
    return Replay(timed, "event_time", name, 3, ("start_time", "end_time"), rides.columns, **options)


def _chained(spark, sf, name: str, **kw) -> DataFrame:
    """The busiest terminal per hour as two chained stateful windows: counts per terminal and
    hour, then the largest of each closed hour."""
    replay = _arriving_rides(spark, sf, name)
    rides = R.with_terminals(replay.stream(), spark)
    busiest = R.busiest_terminal(R.terminal_hourly(rides, watermark="60 seconds", **kw))
    return R.report(SR.run_append(busiest, spark, name, arrivals=replay.arrivals()), "terminal", "hour", "n")


@query
def stream_chained_busiest(spark, sf):
    return _chained(spark, sf, "stream_chained_busiest")


@query
def stream_chained_busiest_departures(spark, sf):
    return _chained(spark, sf, "stream_chained_busiest_departures", departures_only=True)


@query
def stream_rides_gzip(spark, sf):
    """Rides written as gzip csv, read back as a stream; endpoint counts of all closed windows."""
    name = "stream_rides_gzip"
    replay = _arriving_rides(spark, sf, name, R.event_time, fmt="csv", compression="gzip")
    rides = replay.stream(lambda folder: SF.read_rides(spark, folder, "csv", streaming=True))
    hourly = R.both_endpoints_hourly(R.with_terminals(rides, spark), watermark="2 seconds")
    return R.report(SR.run_append(hourly, spark, name, arrivals=replay.arrivals()), "terminal", "hour", "n")


@query
def stream_three_tasks(spark, sf):
    """Visits, busiest terminal and busiest departures from one source and one stateful
    aggregate. Append mode gives a window whole, in one micro-batch, once it is closed."""
    name = "stream_three_tasks"
    replay = _arriving_rides(spark, sf, name)
    hourly = R.tagged_hourly(R.with_terminals(replay.stream(), spark), "60 seconds")
    schema = "window_start timestamp_ntz, result string, terminal string, hour int, n long"
    found = SR.run_batches(hourly, spark, name, {"tasks": schema}, lambda b, _: {"tasks": R.task_results(b)}, arrivals=replay.arrivals())
    return found["tasks"].drop("batch")


def _joined_trips(spark, sf, name: str, how: str) -> DataFrame:
    replay = _arriving(spark, sf, name)
    starts, _ = D.trip_ends(replay.stream())
    _, ends = D.trip_ends(replay.stream())
    joined = SJ.interval_join(starts, ends, ["trip"], "start_time", "end_time", "4 minutes", how)
    found = SR.run_append(joined, spark, name, arrivals=replay.arrivals()).where("trip >= 0")  # not the end rows
    return found.select("trip", F.col("start_time").cast("timestamp_ntz").alias("start_time"), "start_user",
                        F.col("end_time").cast("timestamp_ntz").alias("end_time"), "end_user")


@query
def stream_join_rides(spark, sf):
    """Start records with the end record of their trip, if it comes within four minutes."""
    return _joined_trips(spark, sf, "stream_join_rides", "leftOuter")


@query
def stream_join_rides_inner(spark, sf):
    return _joined_trips(spark, sf, "stream_join_rides_inner", "inner")


@query
def stream_cogroup(spark, sf):
    """Per user and day, the start and the end records of two streams side by side."""
    name = "stream_cogroup"
    replay = _arriving(spark, sf, name)
    starts, _ = D.trip_ends(replay.stream())
    _, ends = D.trip_ends(replay.stream())
    starts = starts.select(F.col("start_time").alias("at"), F.col("start_user").alias("user_id"), "trip")
    ends = ends.select(F.col("end_time").alias("at"), F.col("end_user").alias("user_id"), "trip")
    groups = SJ.window_cogroup(starts, ends, "user_id", F.col("trip"), F.col("trip"), "at", "1 day")
    found = SR.run_append(groups, spark, name, arrivals=replay.arrivals()).where("user_id IS NOT NULL")  # not the end rows
    return present_window(found).select("window_start", "user_id", "left_values", "right_values")


LATE_SLOTS = 6


def _late_split(spark, sf, name: str) -> tuple[DataFrame, DataFrame]:
    events = D.delayed(_t(spark, sf, "events").select("event_id", "ts"))
    replay = Replay(events, "arrival", name, LATE_SLOTS)
    return SL.run_with_late(replay.stream(), spark, name, "ts", "60 seconds", arrivals=replay.arrivals())


@query
def stream_late_rows(spark, sf):
    """Side output: events whose hour the watermark had passed when they came, and that watermark."""
    _, late = _late_split(spark, sf, "stream_late_rows")
    return late.select("event_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("ts", "window_start", "watermark")])


@query
def stream_late_counts(spark, sf):
    counts = SL.late_counts(*_late_split(spark, sf, "stream_late_counts"))
    return counts.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query
def stream_running_total(spark, sf):
    """Every event with the number of events of its type so far (six hot keys)."""
    name = "stream_running_total"
    events = _t(spark, sf, "events").select("event_id", "event_type", F.unix_micros("ts").alias("at"))
    replay = Replay(events, "at", name, 3)
    stream = replay.stream().withColumn("one", F.lit(1).cast("long"))
    out = ST.run_running_total(stream, spark, name, "event_type", "one", ["at", "event_id"], "so_far", replay.arrivals())
    return out.select("event_id", "event_type", "so_far")


@query
def stream_running_wordcount(spark, sf):
    """Every word of every document with its count so far, documents arriving by id."""
    name = "stream_running_wordcount"
    replay = Replay(_t(spark, sf, "documents").select("doc_id", "text"), "doc_id", name, 3)
    words = replay.stream().select("doc_id", F.posexplode(word_tokens(F.col("text"))).alias("pos", "word"), F.lit(1).cast("long").alias("one"))
    out = ST.run_running_total(words, spark, name, "word", "one", ["doc_id", "pos"], "count", replay.arrivals())
    return out.select("doc_id", "pos", "word", "count")


# ================================================================ graphs

def _graph(spark, sf) -> tuple[DataFrame, DataFrame]:
    n = D.vertex_count(spark, sf)
    return D.part_vertices(_t(spark, sf, "part")), D.lineitem_edges(_t(spark, sf, "lineitem"), n)


def _rank_edges(spark, sf) -> DataFrame:
    return D.rank_edges(_t(spark, sf, "lineitem"), D.vertex_count(spark, sf))


def _edge_file(spark, sf) -> str:
    """The lineitem graph written as a ``src dst`` edge-list text file."""
    path = scratch_path(spark, "edge-list")
    _, e = _graph(spark, sf)
    SK.write_text(e.select(F.concat_ws(" ", F.col("src").cast("string"), F.col("dst").cast("string")).alias("value")), path)
    return path


@query
def graph_load(spark, sf):
    return SF.read_edge_list(spark, _edge_file(spark, sf))


@query
def graph_edges_distinct(spark, sf):
    return SF.read_edge_list(spark, _edge_file(spark, sf), ids="string").distinct()


@query
def graph_triplets(spark, sf):
    v, e = _graph(spark, sf)
    t = G.triplets(v, e, "name")
    return t.select("src", "dst", F.concat(F.col("src_name"), F.lit(" likes "), F.col("dst_name")).alias("line"))


@query
def graph_vertex_filter(spark, sf):
    v, _ = _graph(spark, sf)
    return v.filter(F.col("age") > 30)


@query
def graph_edge_filter(spark, sf):
    _, e = _graph(spark, sf)
    return e.filter(F.col("w") > 5)


@query
def graph_in_degrees(spark, sf):
    return G.in_degrees(_graph(spark, sf)[1])


@query
def graph_out_degrees(spark, sf):
    return G.out_degrees(_graph(spark, sf)[1])


@query
def graph_subgraph(spark, sf):
    v, e = _graph(spark, sf)
    return G.subgraph(v, e, F.col("age") > 30)[1]


@query
def graph_subgraph_by_edge(spark, sf):
    """Vertices by age, edges by weight and by both their ends."""
    v, e = _graph(spark, sf)
    return G.subgraph(v, e, F.col("age") > 30, F.col("w") > 5)[1]


@query
def graph_subgraph_components(spark, sf):
    v, e = _graph(spark, sf)
    sv, se = G.subgraph(v, e, F.col("age") > 30)
    cc = G.connected_components(se, sv)
    return sv.join(cc, "id", "left").select("id", "name", "component")


@query
def graph_components(spark, sf):
    return G.connected_components(_graph(spark, sf)[1])


@query
def graph_user_degrees(spark, sf):
    v, e = _graph(spark, sf)
    return G.with_degrees(v.select("id", "name"), e).filter(F.col("inDeg") > 0)


@query
def graph_edge_weights(spark, sf):
    return G.edge_weights(_rank_edges(spark, sf))


@query
def graph_neighbors(spark, sf):
    return G.neighbors(_graph(spark, sf)[1])


@query
def graph_triangles(spark, sf):
    return G.triangle_counts(_graph(spark, sf)[1])


@query
def graph_bfs_levels(spark, sf):
    _, e = _graph(spark, sf)
    source = e.agg(F.min("src")).first()[0]
    return G.bfs_levels(e, source)


@query
def pagerank_pregel(spark, sf):
    return G.pagerank_pregel(_rank_edges(spark, sf), 20).select("id", _rank_key())


@query
def pagerank_join_iterative(spark, sf):
    return G.pagerank_join(_rank_edges(spark, sf), 20).select("id", _rank_key())


@query
def pagerank_converged(spark, sf):
    return G.pagerank_converged(_rank_edges(spark, sf), 1e-4).select("id", _rank_key())


@query
def pagerank_residual(spark, sf):
    """Ranks by residual propagation with a reset of 0.5, left to move by at most 1e-9 a vertex, compared at 1e-3."""
    ranks, _ = G.pagerank_residual(_rank_edges(spark, sf), bound=1e-9, reset=0.5)
    return ranks.select("id", F.floor(F.col("rank") * 1000 + 0.137).cast("bigint").alias("rank_e3"))


@query
def pagerank_named(spark, sf):
    ranks = G.pagerank_converged(_rank_edges(spark, sf), 1e-4)
    names = _t(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    return ranks.join(names, "id").select("id", "name", _rank_key())


@query
def pagerank_top10(spark, sf):
    ranks = G.pagerank_join(_rank_edges(spark, sf), 20)
    return ranks.orderBy(F.desc("rank"), F.asc("id")).limit(10).select("id", _rank_key())


@query
def pagerank_contributions(spark, sf):
    e = _rank_edges(spark, sf).distinct()
    deg = e.groupBy("src").agg(F.count(F.lit(1)).alias("outDeg"))
    ranks = deg.select(F.col("src").alias("id"), F.lit(1.0).alias("rank"))
    return G.pagerank_contributions(ranks, G.with_out_degree(e))
