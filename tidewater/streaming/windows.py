"""Tumbling windows and per-window argmax, usable in batch and in streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling(df: DataFrame, time_col: str, keys: list[str], value: str | None = None,
             length: str = "1 hour", out: str = "n") -> DataFrame:
    """Sum of ``value`` (or a row count) per tumbling window and key; keeps ``window``."""
    agg = F.sum(value).cast("bigint") if value else F.count(F.lit(1))
    return df.groupBy(F.window(time_col, length).alias("window"), *keys).agg(agg.alias(out))


def busiest_per_window(windowed: DataFrame, key: str, n_col: str = "n", length: str = "1 hour") -> DataFrame:
    """Second window over all keys: the key with the largest ``n_col`` (ties → smallest
    key) and that maximum. Its input is already one row per (window, key), so a window
    group holds at most the number of keys; in streaming this is a chained stateful
    aggregation on ``window_time``."""
    return windowed.groupBy(F.window(F.window_time("window"), length).alias("window")).agg(
        F.min_by(F.col(key), F.struct((-F.col(n_col)).alias("neg"), F.col(key).alias("k"))).alias(key),
        F.max(n_col).alias(n_col),
    )


def present_window(df: DataFrame) -> DataFrame:
    return df.withColumn("window_start", F.col("window.start").cast("timestamp_ntz")).drop("window")
