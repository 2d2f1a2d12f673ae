"""Inputs that Spark derives from the driver tables for operators whose natural input
is not a table (access-log lines, ride records, attribute lines, graphs).

Every derivation is a projection of a whole table, so its size grows with the
table. The matching SQL renderings live in ``tidewater.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.geo import DEFAULT_GRID, TERMINALS, Grid
from tidewater.sources.tables import load_table

# Cells used for ride endpoints: the six terminal cells, then two ordinary cells.
RIDE_CELLS = [g for _, g in TERMINALS] + [70000, 70001]


def _pick(n: Column, k: int) -> Column:
    return F.pmod(n, F.lit(k))


# ---------------------------------------------------------------- access log

def log_lines(events: DataFrame) -> DataFrame:
    """Render one Common Log Format line per event (``value``).

    client = ``u<user_id>.example.net``; time = the event time truncated to seconds,
    labelled ``-0400``; request = method, ``/<type>/<user_id mod 10>`` and
    ``HTTP/1.0`` (left out for some events); status from the event type; size =
    ``floor(value*100)``, ``-`` for some events. A few events become lines that
    must be rejected: ``#junk <id>`` and lines whose size is ``n/a``.
    """
    eid, et = F.col("event_id"), F.col("event_type")
    method = F.when(et.isin("purchase", "signup"), F.lit("POST")).otherwise(F.lit("GET"))
    endpoint = F.concat(F.lit("/"), et, F.lit("/"), _pick(F.col("user_id"), 10).cast("string"))
    request = F.when(_pick(eid, 9) == 4, F.concat_ws(" ", method, endpoint)) \
               .otherwise(F.concat_ws(" ", method, endpoint, F.lit("HTTP/1.0")))
    code = (F.when(et == "error", F.when(_pick(eid, 2) == 0, F.lit(500)).otherwise(F.lit(404)))
            .when((et == "signup") & (_pick(eid, 5) == 0), F.lit(403))
            .when((et == "view") & (_pick(eid, 4) == 1), F.lit(304))
            .otherwise(F.lit(200)))
    size = (F.when(_pick(eid, 7) == 0, F.lit("-"))
            .when(_pick(eid, 61) == 7, F.lit("n/a"))
            .otherwise(F.floor(F.col("value") * 100).cast("string")))
    line = F.concat(
        F.lit("u"), F.col("user_id").cast("string"), F.lit(".example.net - - ["),
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" -0400] \""), request, F.lit("\" "),
        code.cast("string"), F.lit(" "), size,
    )
    return events.select(
        F.when(_pick(eid, 53) == 0, F.concat(F.lit("#junk "), eid.cast("string"))).otherwise(line).alias("value"))


# ---------------------------------------------------------------- rides

def rides_from_events(events: DataFrame, grid: Grid = DEFAULT_GRID) -> DataFrame:
    """One ride record per event (works on a stream too).

    start cell = cell ``user_id mod 8`` of ``RIDE_CELLS``, end cell = cell
    ``(7*user_id) mod 8``; coordinates at the cell centre; even event ids are start
    events; the ride starts at ``ts`` and ends 20 minutes later.
    """
    cells = F.array(*[F.lit(c) for c in RIDE_CELLS])
    sc = F.element_at(cells, (_pick(F.col("user_id"), 8) + 1).cast("int"))
    ec = F.element_at(cells, (_pick(F.col("user_id") * 7, 8) + 1).cast("int"))
    return events.select(
        F.col("event_id").alias("ride_id"),
        (_pick(F.col("event_id"), 2) == 0).alias("is_start"),
        F.col("ts").alias("start_time"),
        (F.col("ts") + F.expr("INTERVAL 20 MINUTES")).alias("end_time"),
        grid.centre_lon(sc).alias("start_lon"), grid.centre_lat(sc).alias("start_lat"),
        grid.centre_lon(ec).alias("end_lon"), grid.centre_lat(ec).alias("end_lat"),
    )


def trip_ends(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Start and end records of trips (works on a stream too): an even event starts trip
    ``event_id div 2``, the odd event after it ends it. A record without id is of trip -1 and
    on both sides: join plans drop null keys before they note the time."""
    trip = F.coalesce(F.floor(F.col("event_id") / 2), F.lit(-1))
    starts = events.where((_pick(F.col("event_id"), 2) == 0) | F.col("event_id").isNull()).select(
        trip.alias("trip"), F.col("ts").alias("start_time"), F.col("user_id").alias("start_user"))
    ends = events.where((_pick(F.col("event_id"), 2) == 1) | F.col("event_id").isNull()).select(
        trip.alias("trip"), F.col("ts").alias("end_time"), F.col("user_id").alias("end_user"))
    return starts, ends


def delayed(events: DataFrame) -> DataFrame:
    """``events`` with an ``arrival`` time: every 17th event comes three days late."""
    late = F.when(_pick(F.col("event_id"), 17) == 0, F.expr("INTERVAL 3 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS"))
    return events.withColumn("arrival", F.col("ts") + late)


# ---------------------------------------------------------------- attribute lines

def attribute_lines(customer: DataFrame) -> DataFrame:
    """One ``<row …/>`` line per customer; Id = custkey, Reputation = the integer part
    of the balance (left out when the balance is negative), DisplayName = name."""
    rep = F.when(F.col("c_acctbal") >= 0,
                 F.concat(F.lit(' Reputation="'), F.col("c_acctbal").cast("int").cast("string"), F.lit('"'))) \
           .otherwise(F.lit(""))
    return customer.select(F.concat(
        F.lit('  <row Id="'), F.col("c_custkey").cast("string"), F.lit('"'), rep,
        F.lit(' DisplayName="'), F.col("c_name"), F.lit('" />')).alias("value"))


# ---------------------------------------------------------------- graphs

def vertex_count(spark: SparkSession, sf_dir: str) -> int:
    """Number of vertices of the lineitem graphs (= rows of ``part``)."""
    return load_table(spark, sf_dir, "part").count()


def _mix(li: DataFrame) -> Column:
    return F.col("l_suppkey") * 31 + F.col("l_linenumber") * 17 + F.col("l_orderkey")


def lineitem_edges(lineitem: DataFrame, n: int) -> DataFrame:
    """``(src, dst, w)``: part → a vertex picked from supplier, line and order; weight
    = quantity. Parallel edges occur."""
    return lineitem.select(
        F.col("l_partkey").alias("src"),
        F.pmod(_mix(lineitem), F.lit(n)).alias("dst"),
        F.col("l_quantity").cast("int").alias("w"),
    )


def rank_edges(lineitem: DataFrame, n: int) -> DataFrame:
    """Same edges with every destination mapped to an even id, so odd vertices have no
    in-edges (the three PageRank forms then differ)."""
    return lineitem.select(
        F.col("l_partkey").alias("src"),
        (F.pmod(_mix(lineitem), F.lit(n // 2)) * 2).alias("dst"),
    )


def part_vertices(part: DataFrame) -> DataFrame:
    """``(id, name, age)`` with age = part size."""
    return part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("age"))
