"""Key-value operators on DataFrames with named key and value columns."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keys_values(df: DataFrame, k: str, v: str) -> DataFrame:
    """Keys and values as one column each side of a union (no de-duplication)."""
    return df.select(F.lit("key").alias("part"), F.col(k).cast("string").alias("item")).unionByName(
        df.select(F.lit("value").alias("part"), F.col(v).cast("string").alias("item"))
    )


def map_values(df: DataFrame, v: str, fn: Callable[[Column], Column]) -> DataFrame:
    """Transform the value, keep the key."""
    return df.withColumn(v, fn(F.col(v)))


def group_list(df: DataFrame, k: str, v: str, out: str = "values") -> DataFrame:
    """Values of each key as a sorted list (sorted for determinism)."""
    return df.groupBy(k).agg(F.sort_array(F.collect_list(v)).alias(out))


def reduce_sum(df: DataFrame, k: str, v: str, out: str = "total") -> DataFrame:
    """``reduceByKey(add)``: partial sums per task, final sum per key."""
    return df.groupBy(k).agg(F.sum(v).alias(out))


# Operations Spark combines in every task before the shuffle.
BUILT_IN = {"sum": F.sum, "min": F.min, "max": F.max, "product": F.product, "bit_and": F.bit_and, "bit_or": F.bit_or,
            "bit_xor": F.bit_xor, "and": F.bool_and, "or": F.bool_or}


# Rows that one fold of ``reduce_by_key`` takes at most.
RUN_ROWS = 65_536


def reduce_by_key(df: DataFrame, k: str, v: str, fn: str | Callable[[Column, Column], Column],
                  out: str = "reduced", run_rows: int = RUN_ROWS) -> DataFrame:
    """``reduceByKey(fn)`` for any associative, commutative ``fn``.

    A name of ``BUILT_IN`` is a partial aggregate: one value per key and task is shuffled.
    Any other ``fn`` on Columns has no partial form in Spark, so it is a tree of folds: the
    values of a key in a run of ``run_rows`` rows of a split, then the results of about as many runs
    (dealt by a hash of the run, so a hot key keeps many tasks busy), until one level can
    fold all results of a key. No array is longer than a run. Null values are left out; a key
    with none but nulls gives null.
    """
    if isinstance(fn, str):
        return df.groupBy(k).agg(BUILT_IN[fn](v).alias(out))

    def fold(values: str) -> Column:
        arr = F.collect_list(values)
        return F.aggregate(F.slice(arr, 2, F.greatest(F.size(arr), F.lit(1))), F.get(arr, F.lit(0)), fn)

    run = F.floor(F.monotonically_increasing_id() / run_rows)
    level = df.select(F.col(k), F.col(v).alias("_v"), run.alias("_run")).groupBy(k, "_run").agg(fold("_v").alias("_v"))
    groups = -(-df.count() // run_rows**2)
    while groups > 1:
        level = level.withColumn("_run", F.pmod(F.xxhash64("_run"), F.lit(groups))).groupBy(k, "_run").agg(fold("_v").alias("_v"))
        groups = -(-groups // run_rows)
    return level.groupBy(k).agg(fold("_v").alias(out))


def lookup(df: DataFrame, k: str, v: str, key) -> DataFrame:
    """All values stored under ``key`` (a filter that reaches the scan)."""
    return df.filter(F.col(k) == F.lit(key)).select(v)


def as_map(df: DataFrame, group: str, k: str, v: str, order: str | None = None, out: str = "entries") -> DataFrame:
    """``collectAsMap`` per ``group``: one entry per key, the last value by ``order``
    winning. Use it where the keys per group are bounded."""
    order = order or v
    last = df.groupBy(group, k).agg(F.max_by(v, order).alias("_v"))
    return last.groupBy(group).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(k), F.col("_v"))))).alias(out)
    )


def cogroup_lists(left: DataFrame, right: DataFrame, k: str, lv: str, rv: str) -> DataFrame:
    """``coGroup``: for every key on either side, the sorted values of both sides
    (empty list where a side has none). Partial aggregation happens before the join."""
    lg = left.groupBy(k).agg(F.sort_array(F.collect_list(lv)).alias("left_values"))
    rg = right.groupBy(k).agg(F.sort_array(F.collect_list(rv)).alias("right_values"))
    empty_l = F.array().cast(lg.schema["left_values"].dataType)
    empty_r = F.array().cast(rg.schema["right_values"].dataType)
    return lg.join(rg, on=k, how="full").select(
        k,
        F.coalesce("left_values", empty_l).alias("left_values"),
        F.coalesce("right_values", empty_r).alias("right_values"),
    )


def cogroup_apply(left: DataFrame, right: DataFrame, k: str, fn: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
                  schema: str) -> DataFrame:
    """General ``coGroup`` with a pandas function per key (Arrow batches).

    Each key's two groups are materialised together in one task; use it where the
    groups per key are bounded, and ``cogroup_lists`` or a built-in aggregate otherwise.
    """
    return left.groupBy(k).cogroup(right.groupBy(k)).applyInPandas(fn, schema=schema)


def sample_n(df: DataFrame, n: int, key: str, seed: int = 7) -> DataFrame:
    """Exactly ``n`` rows (or all, if fewer) without replacement: those with the smallest
    seeded hash of ``key`` and the other columns, so the sample does not depend on the partitions, and rows
    that share a key, or have none, are drawn one by one (only rows equal in all columns share a
    hash). Each task keeps only its ``n`` smallest hashes."""
    cols = [key, *[c for c in df.columns if c != key]]
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in cols])
    return df.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), text), 256), key).limit(n)
