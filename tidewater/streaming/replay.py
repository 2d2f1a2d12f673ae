"""A finite table that arrives slot by slot, in the order of one of its columns.

A file stream takes files in the order in which they were written, so a table written by parallel tasks
has no event-time order of its own. ``Replay`` writes the rows of one slot of the order
column after another to a folder that a stream watches; the runners start the stream once
per arrival with the same checkpoint, so state and watermark carry over and every arrival is
at least one micro-batch. The rows of a slot are selected by a range of the order column,
which reaches the scan where the column is one of the file's.

A watermark only moves with records. ``end`` rows arrive last, ``gap`` apart: records without
any value but their time, which close every window and interval of the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.session import scratch_path

DAY = 86_400_000_000


class Replay:
    """``df`` in ``slots`` equally wide slots of ``order`` (a column of longs or timestamps; null
    arrives first). ``columns`` are written (default: all); ``end_cols`` are the timestamp columns
    of the end rows."""

    def __init__(self, df: DataFrame, order: str, name: str, slots: int = 3, end_cols: tuple[str, ...] = (),
                 columns: list[str] | None = None, gap: int = 2 * DAY, fmt: str = "parquet", **options):
        self.columns = columns or df.columns
        self.schema = df.select(*self.columns).schema
        self.df, self.slots, self.end_cols, self.gap = df, slots, end_cols, gap
        self.fmt, self.options = fmt, options
        self.spark = df.sparkSession
        self.folder = scratch_path(self.spark, f"{name}-arrivals")
        self.order = F.col(order)
        self.timed = isinstance(df.schema[order].dataType, T.TimestampType)
        number = F.unix_micros(self.order) if self.timed else self.order.cast("long")
        ends = [F.max(F.unix_micros(c)) for c in end_cols] or [F.lit(0)]
        found = df.agg(F.min(number).alias("lo"), F.max(number).alias("hi"), F.greatest(*ends, *ends[:1]).alias("end")).first()
        self.lo, self.hi, self.end = found["lo"] or 0, found["hi"] or 0, found["end"] or 0

    def start_of(self, slot: int) -> int:
        """The first order value of a slot."""
        return self.lo + -(-slot * (self.hi - self.lo + 1) // self.slots)

    def _value(self, number: int) -> Column:
        return F.timestamp_micros(F.lit(number)) if self.timed else F.lit(number)

    def _feed(self, rows: DataFrame) -> None:
        writer = rows.select(*self.columns).write.format(self.fmt).mode("append")
        for k, v in self.options.items():
            writer = writer.option(k, v)
        writer.save(self.folder)

    def arrivals(self) -> Iterator[None]:
        """Each step lets the next slot arrive, then the end rows."""
        for slot in range(self.slots):
            here = (self.order >= self._value(self.start_of(slot))) & (self.order < self._value(self.start_of(slot + 1)))
            self._feed(self.df.where(here if slot else here | self.order.isNull()))
            yield
        for i in (1, 2) if self.end_cols else ():
            at = F.timestamp_micros(F.lit(self.end + i * self.gap))
            self._feed(self.spark.range(1).select(*[
                (at if f.name in self.end_cols else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema.fields]))
            yield

    def stream(self, read: Callable[[str], DataFrame] | None = None) -> DataFrame:
        """The arriving rows; ``read`` opens the folder as a stream (default: as it is written)."""
        self._feed(self.df.limit(0))  # the folder exists before its first slot
        if read is not None:
            return read(self.folder)
        return self.spark.readStream.schema(self.schema).format(self.fmt).load(self.folder)


def slot_sql(order: str, table: str, slots: int) -> str:
    """The slot of a row in SQL, for the integer ``order``."""
    lo, hi = f"(SELECT min({order}) FROM {table})", f"(SELECT max({order}) FROM {table})"
    return f"(({order} - {lo}) * {slots}) // ({hi} - {lo} + 1)"
