"""Joins and co-groups of two streams with bounded state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def interval_join(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, within: str,
                  how: str = "inner", delay: str = "1 minute") -> DataFrame:
    """Rows with equal ``keys`` whose ``right_time`` is at ``left_time`` or at most ``within``
    later; ``how`` is ``inner`` or ``leftOuter``.

    Both sides carry a watermark of ``delay`` and the times are bounded by each other, so Spark
    drops a row from state once no partner can come: a left row when the right watermark is
    ``within`` past it (an outer join then gives it without partner), a right row when the left
    watermark is past it. Columns of the right side other than ``keys`` must have own names.
    """
    r = right.withWatermark(right_time, delay).select(
        *[F.col(k).alias(f"_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(k) == F.col(f"_{k}"))
    on = on & (F.col(right_time) >= F.col(left_time)) & (F.col(right_time) <= F.col(left_time) + F.expr(f"INTERVAL {within}"))
    return left.withWatermark(left_time, delay).join(r, on, how).drop(*[f"_{k}" for k in keys])


def window_cogroup(left: DataFrame, right: DataFrame, key: str, left_value: Column, right_value: Column, time_col: str,
                   length: str = "1 hour", delay: str = "1 minute") -> DataFrame:
    """``window, key, left_values, right_values``: the sorted values of both streams per key and
    tumbling window, an empty list where one side has none. Both streams go through one
    aggregate, whose state a window leaves when the watermark passes it."""
    none = F.lit(None).cast("string")
    a = left.select(time_col, key, left_value.cast("string").alias("_l"), none.alias("_r"))
    both = a.unionByName(right.select(time_col, key, none.alias("_l"), right_value.cast("string").alias("_r")))
    return both.withWatermark(time_col, delay).groupBy(F.window(time_col, length).alias("window"), key).agg(
        F.sort_array(F.collect_list("_l")).alias("left_values"), F.sort_array(F.collect_list("_r")).alias("right_values"))
