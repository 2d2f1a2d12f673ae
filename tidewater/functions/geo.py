"""Grid cells, airport terminals and local hours for ride events."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values from the ride programs: terminal names and their grid cell codes.
TERMINALS = [
    ("TERMINAL_1", 71436),
    ("TERMINAL_2", 71688),
    ("TERMINAL_3", 71191),
    ("TERMINAL_4", 70945),
    ("TERMINAL_5", 70190),
    ("TERMINAL_6", 70686),
]
NY_ZONE = "America/New_York"


@dataclass(frozen=True)
class Grid:
    """A regular lon/lat grid numbered row-major from the north-west corner.
    The cell codes of ``TERMINALS`` only mean something under the grid they were
    made for, so both are parameters; this default is our own 250-column grid."""

    west: float = -74.25
    north: float = 41.0
    dx: float = 0.0025
    dy: float = 0.002
    ncols: int = 250

    def cell(self, lon: Column, lat: Column) -> Column:
        col = F.floor((lon - F.lit(self.west)) / F.lit(self.dx))
        row = F.floor((F.lit(self.north) - lat) / F.lit(self.dy))
        return (col + row * F.lit(self.ncols)).cast("int")

    def centre_lon(self, cell: Column) -> Column:
        return F.lit(self.west) + (F.pmod(cell, F.lit(self.ncols)) + F.lit(0.5)) * F.lit(self.dx)

    def centre_lat(self, cell: Column) -> Column:
        return F.lit(self.north) - (F.floor(cell / F.lit(self.ncols)) + F.lit(0.5)) * F.lit(self.dy)


DEFAULT_GRID = Grid()


def terminals_frame(spark: SparkSession, terminals: list[tuple[str, int]] = TERMINALS) -> DataFrame:
    """The terminal dimension ``(terminal string, grid int)``; its size is the list length."""
    return spark.createDataFrame(terminals, "terminal string, grid int")


def local_hour(ts: Column, zone: str = NY_ZONE) -> Column:
    """Hour of day of an instant in ``zone`` (daylight saving applied)."""
    return F.hour(F.from_utc_timestamp(ts, zone))
