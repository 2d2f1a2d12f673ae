"""Sinks: plain text (one file per partition) and ``key TAB value`` job output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_text(df: DataFrame, path: str) -> str:
    """Write a single string column, one line per row, one file per partition."""
    if len(df.columns) != 1:
        df = df.select(F.concat_ws(",", *[F.col(c).cast("string") for c in df.columns]).alias("value"))
    df.write.mode("overwrite").text(path)
    return path


def write_tsv(df: DataFrame, path: str) -> str:
    """Write ``key<TAB>value`` lines (the MapReduce output layout)."""
    df.write.mode("overwrite").option("sep", "\t").option("header", "false").csv(path)
    return path


def read_tsv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("sep", "\t").csv(path)
