"""Readers for the parquet tables the queries run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _zoned(df: DataFrame) -> DataFrame:
    # Event-time operators (watermarks, windows) need TIMESTAMP, not TIMESTAMP_NTZ.
    # The wall clock of the files is read as UTC (session zone UTC).
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampNTZType):
            cols.append(F.col(f.name).cast("timestamp").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Batch scan of ``{sf_dir}/{name}.parquet``; column pruning and filters reach the scan."""
    return _zoned(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def stream_table(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of the same table, be it one file or a folder of part files.

    The batch reader gives the schema and raises where the table is missing or holds no
    data file. The path is a pattern that only the table itself matches: the file source
    refuses a plain file, but not a pattern that leads to one."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return _zoned(reader.parquet(f"{path[:-1]}[{path[-1]}]"))


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a narrow input before CPU-heavy per-row work (regex, tokenizing).

    Only when the scan has fewer partitions than the cluster's parallelism (a few
    large row groups); a wide input is returned as is, so at scale this adds no
    shuffle. Spark sorts before a round-robin repartition, so a retried task gets the
    same rows.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df
