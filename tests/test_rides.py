import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewater.functions.geo import DEFAULT_GRID, TERMINALS, local_hour
from tidewater.operators import rides as R
from tidewater.sources.files import RIDE_SCHEMA

G = DEFAULT_GRID
T1, T2 = TERMINALS[0][1], TERMINALS[1][1]
ELSEWHERE = 12345


def centre(cell):
    col, row = cell % G.ncols, cell // G.ncols
    return G.west + (col + 0.5) * G.dx, G.north - (row + 0.5) * G.dy


def ride(rid, is_start, start, end, scell, ecell):
    (slon, slat), (elon, elat) = centre(scell), centre(ecell)
    return (rid, is_start, start, end, slon, slat, elon, elat)


def utc(h, m=0, day=15, month=1):
    return dt.datetime(2024, month, day, h, m)


@pytest.fixture(scope="module")
def rides_t(spark):
    data = [
        ride(1, True, utc(10, 5), utc(10, 40), T1, ELSEWHERE),       # start at T1
        ride(2, False, utc(9, 0), utc(11, 10), ELSEWHERE, T1),       # end at T1
        ride(3, True, utc(10, 10), utc(10, 50), ELSEWHERE, ELSEWHERE),  # neither
        ride(4, True, utc(10, 20), utc(12, 30), T1, T2),             # both endpoints
        ride(5, False, utc(8, 0), utc(10, 15), ELSEWHERE, T2),       # end only
        ride(6, True, utc(10, 30), utc(10, 45), T2, ELSEWHERE),      # T2 start, ties T1 in 10:00
    ]
    return R.with_terminals(spark.createDataFrame(data, RIDE_SCHEMA), spark)


def test_cells_and_terminals(rides_t):
    got = {r.ride_id: (r.start_cell, r.end_cell, r.start_terminal, r.end_terminal) for r in rides_t.collect()}
    assert got[1] == (T1, ELSEWHERE, "TERMINAL_1", None)
    assert got[4] == (T1, T2, "TERMINAL_1", "TERMINAL_2")


def test_terminal_events_by_kind(rides_t):
    ev = rows(R.terminal_events(rides_t), "ride_id", "terminal", "hour")
    # UTC-5 in January
    assert ev == [(1, "TERMINAL_1", 5), (2, "TERMINAL_1", 6), (4, "TERMINAL_1", 5), (5, "TERMINAL_2", 5),
                  (6, "TERMINAL_2", 5)]


def test_either_both_first(rides_t):
    assert [r[0] for r in rows(R.either_endpoint(rides_t), "ride_id")] == [1, 2, 4, 5, 6]
    both = rows(R.both_endpoints(rides_t), "ride_id", "terminal", "hour")
    assert (4, "TERMINAL_1", 5) in both and (4, "TERMINAL_2", 7) in both
    assert len([b for b in both if b[0] == 4]) == 2
    first = dict((r[0], r[1:]) for r in rows(R.first_endpoint(rides_t)))
    assert first[4] == ("TERMINAL_1", 5) and first[5] == ("TERMINAL_2", 5)
    assert [r[0] for r in rows(R.start_at_terminal(rides_t), "ride_id")] == [1, 4, 6]


def test_busiest_tie_smallest_name(rides_t):
    hourly = R.terminal_hourly(rides_t)
    busy = R.report(R.busiest_terminal(hourly), "terminal", "hour", "n")
    got = {r.window_start: (r.terminal, r.n) for r in busy.collect()}
    assert got[dt.datetime(2024, 1, 15, 10)] == ("TERMINAL_1", 2)
    dep = R.report(R.busiest_terminal(R.terminal_hourly(rides_t, departures_only=True)), "terminal", "hour", "n")
    assert {r.window_start: r.terminal for r in dep.collect()}[dt.datetime(2024, 1, 15, 10)] == "TERMINAL_1"


def test_dst_hours(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 6, 30),), (dt.datetime(2024, 3, 10, 7, 30),)], "ts timestamp")
    assert [r[0] for r in df.select(local_hour(F.col("ts"))).orderBy(1).collect()] == [1, 3]
