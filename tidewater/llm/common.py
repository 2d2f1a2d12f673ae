"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: cuts lineage, is computed once and
    survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, row: str) -> DataFrame:
    """``df`` with a number per row in the column ``row``. Numbers follow partitions, so they
    are written down once: a second read or a retried task sees the same ones."""
    return written(df.withColumn(row, F.monotonically_increasing_id()), "rows")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names close to ``names`` that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def heavy_keys(keys: DataFrame, key: str, rows: int, partitions: int, least: int = 256) -> tuple[DataFrame, int]:
    """Keys with more than ``cap`` rows, as ``(key, n)``, and ``cap``.

    ``cap`` is a quarter of the mean partition, so at most ``4 * partitions`` keys can be
    heavy: the table has a bound that does not depend on the number of rows.
    """
    cap = max(least, rows // (4 * partitions))
    return keys.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > cap), cap


def ascii_lower(col: Column) -> Column:
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sorted_groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Consecutive rows with equal integers in their first ``n_keys`` columns, from batches of
    a partition sorted by those columns. Only the open group is held."""
    key, parts = None, []
    for b in batches:
        if not b.num_rows:
            continue
        cols = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(n_keys)])
        cuts = [0, *(np.flatnonzero((cols[:, 1:] != cols[:, :-1]).any(axis=0)) + 1).tolist(), b.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            k = tuple(cols[:, lo].tolist())
            if k != key and parts:
                yield key, pa.Table.from_batches(parts)
                parts = []
            key = k
            parts.append(b.slice(lo, hi - lo))
    if parts:
        yield key, pa.Table.from_batches(parts)
