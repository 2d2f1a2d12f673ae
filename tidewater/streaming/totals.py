"""Running totals per key, one result per input record, in arrival order.

Within a micro-batch the records of a key are cut into ranges of the order column, each a
group of bounded size on average, so a hot key is no single task. A first window over the totals
of ranges (one row per key and range) gives what lies before a range, the total that earlier
batches left for the key included; it goes as a row of its own in front of the records of its range, so one
shuffle and one window over the records gives their totals. Every batch writes its new totals per
key, so a batch that runs again starts from the same ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.session import scratch_path
from tidewater.streaming.runner import run_batches

RANGE_ROWS, MOST_RANGES = 50_000, 4096


def _ranged(rows: DataFrame, col: str, bounds: list[float]) -> DataFrame:
    """``rows`` with ``_part``: how many of the ascending ``bounds`` lie at or below the value of ``col``
    (null: 0), by binary search."""
    bounds = [b for b in bounds if math.isfinite(b)]
    if not bounds:
        return rows.withColumn("_part", F.lit(0))
    cut = Bucketizer(splits=[-math.inf, *bounds, math.inf], inputCol="_at", outputCol="_bucket", handleInvalid="keep")
    found = cut.transform(rows.withColumn("_at", F.col(col).cast("double")))
    return found.withColumn("_part", F.coalesce(F.col("_bucket").cast("int"), F.lit(0))).drop("_at", "_bucket")


def _plus(a: Column, b: Column) -> Column:
    return F.coalesce(a + b, a, b)


def running(rows: DataFrame, key: str, value: str, order: list[str], carried: DataFrame, out: str,
            range_rows: int = RANGE_ROWS) -> tuple[DataFrame, DataFrame]:
    """``rows`` with their running total ``out``, and the totals ``(key, total)`` after them.

    ``order`` must tell rows of a key apart; its first column is numeric. ``carried(key, total)``
    holds what came before."""
    ranges = min(MOST_RANGES, -(-rows.count() // range_rows))
    probs = [i / ranges for i in range(1, ranges)]
    bounds = sorted(set(rows.approxQuantile(order[0], probs, 0.5 / ranges))) if probs else []
    parted = _ranged(rows, order[0], bounds)
    sums = parted.groupBy(F.col(key).alias("_key"), "_part").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    have = carried.select(F.col("key").alias("_have"), F.col("total").alias("_total"))
    base = sums.join(have, F.col("_key").eqNullSafe(F.col("_have")), "left").select(
        "_key", "_part", "_sum", _plus(F.sum("_sum").over(before), F.col("_total")).alias("_base"))
    path = scratch_path(rows.sparkSession, "running-base")  # both results need it; it is taken from the rows once
    base.write.parquet(path)
    base = rows.sparkSession.read.schema(base.schema).parquet(path)
    totals = base.groupBy("_key").agg(F.max_by(_plus(F.col("_base"), F.col("_sum")), "_part").alias("_new"), F.lit(True).alias("_seen"))
    after = have.join(totals, F.col("_key").eqNullSafe(F.col("_have")), "full").select(
        F.when(F.col("_seen"), F.col("_key")).otherwise(F.col("_have")).alias("key"),
        F.when(F.col("_seen"), F.col("_new")).otherwise(F.col("_total")).alias("total"))
    own = base.select(*[F.col("_key").alias(f.name) if f.name == key else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields],
                      "_part", F.col("_base").alias("_n"), F.lit(0).alias("_later"))
    every = parted.withColumns({"_n": F.col(value), "_later": F.lit(1)}).unionByName(own)
    inside = Window.partitionBy(key, "_part").orderBy("_later", *order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return every.withColumn(out, F.sum("_n").over(inside)).where("_later = 1").select(*rows.columns, out), after


def run_running_total(stream: DataFrame, spark: SparkSession, name: str, key: str, value: str, order: list[str],
                      out: str = "total", arrivals: Iterable[None] = (None,), timeout_s: float | None = None,
                      range_rows: int = RANGE_ROWS) -> DataFrame:
    """Every record of ``stream`` with the total of its key so far, itself included. Records
    of a later micro-batch come after those of an earlier one, whatever their ``order``."""
    kind = stream.schema[key].dataType.simpleString()
    carry = scratch_path(spark, f"{name}-totals")
    state = f"key {kind}, total long"
    done: list[int] = []

    def step(batch: DataFrame, batch_id: int) -> dict[str, DataFrame]:
        last = max((b for b in done if b < batch_id), default=None)
        carried = spark.createDataFrame([], state) if last is None else spark.read.schema(state).parquet(f"{carry}/batch={last}")
        found, after = running(batch, key, value, order, carried, out, range_rows)
        after.write.mode("overwrite").parquet(f"{carry}/batch={batch_id}")
        done.append(batch_id)
        return {"rows": found}

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema.fields) + f", `{out}` long"
    return run_batches(stream, spark, name, {"rows": ddl}, step, timeout_s, arrivals)["rows"].drop("batch")
