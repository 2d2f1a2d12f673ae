"""Ride events at airport terminals: filters, mappers and hourly counts.

Every function accepts a batch **or** a streaming DataFrame of ride records
(``RIDE_SCHEMA``); the terminal table is a broadcast of a fixed-size list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.geo import DEFAULT_GRID, TERMINALS, Grid, local_hour, terminals_frame
from tidewater.operators.relational import bounded_broadcast
from tidewater.streaming.windows import busiest_per_window, present_window, tumbling


def with_terminals(rides: DataFrame, spark: SparkSession, grid: Grid = DEFAULT_GRID,
                   terminals: list[tuple[str, int]] = TERMINALS) -> DataFrame:
    """Add ``start_cell, end_cell, start_terminal, end_terminal`` (null = not a terminal)
    by two broadcast left joins with the terminal table."""
    t = bounded_broadcast(terminals_frame(spark, terminals), proven_rows=len(terminals))
    cells = rides.withColumn("start_cell", grid.cell(F.col("start_lon"), F.col("start_lat"))) \
                 .withColumn("end_cell", grid.cell(F.col("end_lon"), F.col("end_lat")))
    st = t.select(F.col("grid").alias("start_cell"), F.col("terminal").alias("start_terminal"))
    et = t.select(F.col("grid").alias("end_cell"), F.col("terminal").alias("end_terminal"))
    return cells.join(st, "start_cell", "left").join(et, "end_cell", "left")


def event_time(rides_t: DataFrame) -> DataFrame:
    """Event time by kind: the start time if the start cell is a terminal, else the end time."""
    return rides_t.withColumn(
        "event_time", F.when(F.col("start_terminal").isNotNull(), F.col("start_time")).otherwise(F.col("end_time"))
    )


def record_time(rides_t: DataFrame) -> DataFrame:
    """The record's own time: start events at their start, end events at their end."""
    return rides_t.withColumn("event_time", F.when(F.col("is_start"), F.col("start_time")).otherwise(F.col("end_time")))


def terminal_events(rides_t: DataFrame, departures_only: bool = False) -> DataFrame:
    """Events at a terminal, the location taken by kind (start cell for start events,
    end cell for end events) → ``(ride_id, is_start, event_time, terminal, n, hour)``.

    Rows are chosen by a generator: a filter would be pushed below a watermark, which would
    then follow only the terminal rides."""
    if "event_time" not in rides_t.columns:
        rides_t = record_time(rides_t)
    is_start = F.col("is_start")
    terminal = F.when(is_start, F.col("start_terminal")).otherwise(F.col("end_terminal"))
    wanted = terminal.isNotNull() & (is_start if departures_only else F.lit(True))
    at = F.when(wanted, F.array(terminal)).otherwise(F.array().cast("array<string>"))
    return rides_t.select("ride_id", "is_start", "event_time", F.explode(at).alias("terminal")).select(
        "ride_id", "is_start", "event_time", "terminal",
        F.lit(1).cast("bigint").alias("n"), local_hour(F.col("event_time")).alias("hour"),
    )


def either_endpoint(rides_t: DataFrame) -> DataFrame:
    """Rides whose start or end cell is a terminal."""
    return rides_t.filter(F.col("start_terminal").isNotNull() | F.col("end_terminal").isNotNull()) \
                  .select("ride_id", "is_start", "start_terminal", "end_terminal")


def start_at_terminal(rides_t: DataFrame) -> DataFrame:
    """Rides starting at a terminal, whatever the event kind → ``(terminal, 1, start hour)``."""
    return rides_t.filter(F.col("start_terminal").isNotNull()).select(
        "ride_id", F.col("start_terminal").alias("terminal"),
        F.lit(1).cast("bigint").alias("n"), local_hour(F.col("start_time")).alias("hour"),
    )


def both_endpoints(rides_t: DataFrame) -> DataFrame:
    """0, 1 or 2 rows per ride, one per endpoint at a terminal, each with its own hour;
    ``event_time`` is the record's (E11) time."""
    ends = F.array(
        F.struct(F.col("start_terminal").alias("terminal"), local_hour(F.col("start_time")).alias("hour")),
        F.struct(F.col("end_terminal").alias("terminal"), local_hour(F.col("end_time")).alias("hour")),
    )
    if "event_time" not in rides_t.columns:
        rides_t = event_time(rides_t)
    return (
        rides_t
        .select("ride_id", "event_time", F.explode(F.filter(ends, lambda e: e["terminal"].isNotNull())).alias("e"))
        .select("ride_id", "event_time", F.col("e.terminal").alias("terminal"), F.col("e.hour").alias("hour"),
                F.lit(1).cast("bigint").alias("n"))
    )


def first_endpoint(rides_t: DataFrame) -> DataFrame:
    """One row per ride touching a terminal: the start terminal with the start hour if
    there is one, otherwise the end terminal with the end hour."""
    start = F.when(F.col("start_terminal").isNotNull(),
                   F.struct(F.col("start_terminal").alias("terminal"), local_hour(F.col("start_time")).alias("hour")))
    end = F.when(F.col("end_terminal").isNotNull(),
                 F.struct(F.col("end_terminal").alias("terminal"), local_hour(F.col("end_time")).alias("hour")))
    return rides_t.select("ride_id", F.coalesce(start, end).alias("e")).filter(F.col("e").isNotNull()) \
                  .select("ride_id", F.col("e.terminal").alias("terminal"), F.col("e.hour").alias("hour"))


def terminal_hourly(rides_t: DataFrame, departures_only: bool = False, watermark: str | None = None) -> DataFrame:
    """Visits per terminal per 1-hour event-time window (keyed by terminal; the hour
    label is the window start in New York time). Keeps the ``window`` column."""
    # The watermark follows every record (as a source-assigned one does), so it is set
    # before any filter.
    src = record_time(rides_t)
    if watermark:
        src = src.withWatermark("event_time", watermark)
    out = tumbling(terminal_events(src, departures_only), "event_time", ["terminal"], value="n")
    return out.withColumn("hour", local_hour(F.col("window.start")))


def tagged_hourly(rides_t: DataFrame, watermark: str) -> DataFrame:
    """Visits and departures per terminal and hour by one aggregate: every event counts
    under each ``task`` it belongs to."""
    ev = terminal_events(record_time(rides_t).withWatermark("event_time", watermark))
    tasks = F.array_compact(F.array(F.lit("visits"), F.when(F.col("is_start"), F.lit("departures"))))
    return tumbling(ev.withColumn("task", F.explode(tasks)), "event_time", ["task", "terminal"], value="n")


def task_results(hourly: DataFrame) -> DataFrame:
    """From the closed windows of ``tagged_hourly``: the visits of every terminal
    (``terminal visits``), the busiest terminal (``busiest``) and the busiest one for departures
    (``busiest departures``) of every hour, as ``result, window_start, terminal, hour, n``."""
    hour = local_hour(F.col("window.start"))
    visits = hourly.where("task = 'visits'").withColumn("hour", hour)
    departures = hourly.where("task = 'departures'")
    parts = {"terminal visits": visits, "busiest": busiest_terminal(visits), "busiest departures": busiest_terminal(departures)}
    out = [report(df.withColumn("result", F.lit(k)), "result", "terminal", "hour", "n") for k, df in parts.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


def busiest_terminal(hourly: DataFrame) -> DataFrame:
    """Per window, the terminal with most visits (ties → smallest name)."""
    out = busiest_per_window(hourly, key="terminal", n_col="n")
    return out.withColumn("hour", local_hour(F.col("window.start")))


def both_endpoints_hourly(rides_t: DataFrame, watermark: str | None = None) -> DataFrame:
    """Endpoint counts per (window on E11 time, terminal, endpoint hour)."""
    src = event_time(rides_t)
    if watermark:
        src = src.withWatermark("event_time", watermark)
    ev = both_endpoints(src)
    return tumbling(ev, "event_time", ["terminal", "hour"], value="n")


def report(windowed: DataFrame, *cols: str) -> DataFrame:
    """Replace the window struct by its start (wall clock, UTC)."""
    return present_window(windowed).select("window_start", *cols)
