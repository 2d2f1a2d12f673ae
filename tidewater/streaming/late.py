"""Late rows as a side output.

Spark's windowed aggregates drop a row whose window the watermark has passed and only count
it. Here the rows of every micro-batch are split before they are aggregated, by the same rule: the
watermark of a batch is the largest event time of the batches before it less the allowed
delay, and a row is late if its window ends at or before it. The watermark is read from the written
maxima of earlier batches, so a batch that runs again splits the same way.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import scratch_path
from tidewater.streaming.runner import run_batches


def run_with_late(stream: DataFrame, spark: SparkSession, name: str, time_col: str, delay: str, length: str = "1 hour",
                  arrivals: Iterable[None] = (None,), timeout_s: float | None = None) -> tuple[DataFrame, DataFrame]:
    """``(on time, late)``: the rows of ``stream`` with their ``window_start``, late ones also with the
    ``watermark`` they missed. Rows without an event time belong to no window and to neither."""
    marks = scratch_path(spark, f"{name}-marks")
    seen: set[int] = set()

    def split(batch: DataFrame, batch_id: int) -> dict[str, DataFrame]:
        earlier = [f"{marks}/batch={b}" for b in seen if b < batch_id]
        top = spark.read.schema("top timestamp").parquet(*earlier).agg(F.max("top")).first()[0] if earlier else None
        batch.agg(F.max(time_col).alias("top")).write.mode("overwrite").parquet(f"{marks}/batch={batch_id}")
        seen.add(batch_id)
        mark = F.lit(top).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        w = F.window(time_col, length)
        rows = batch.where(F.col(time_col).isNotNull()).withColumn("window_start", w.start)
        late = F.coalesce(w.end <= mark, F.lit(False))
        return {"on_time": rows.where(~late), "late": rows.where(late).withColumn("watermark", mark)}

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema.fields) + ", window_start timestamp"
    found = run_batches(stream, spark, name, {"on_time": ddl, "late": f"{ddl}, watermark timestamp"}, split, timeout_s, arrivals)
    return found["on_time"].drop("batch"), found["late"].drop("batch")


def late_counts(on_time: DataFrame, late: DataFrame) -> DataFrame:
    """``window_start, on_time, late``: rows of every window on either side."""
    tagged = on_time.select("window_start", F.lit(1).alias("a"), F.lit(0).alias("b")).unionAll(
        late.select("window_start", F.lit(0), F.lit(1)))
    return tagged.groupBy("window_start").agg(F.sum("a").alias("on_time"), F.sum("b").alias("late"))
