"""File sources: text lines, delimited lines, JSON lines, edge lists, ride records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns a ride record must carry (the seven the ride programs read, plus an id).
RIDE_SCHEMA = T.StructType([
    T.StructField("ride_id", T.LongType()),
    T.StructField("is_start", T.BooleanType()),
    T.StructField("start_time", T.TimestampType()),
    T.StructField("end_time", T.TimestampType()),
    T.StructField("start_lon", T.DoubleType()),
    T.StructField("start_lat", T.DoubleType()),
    T.StructField("end_lon", T.DoubleType()),
    T.StructField("end_lat", T.DoubleType()),
])


def read_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line, column ``value``; a path may be a file or a directory."""
    return spark.read.text(path)


def read_text_stream(spark: SparkSession, path: str, fmt: str = "text", **options) -> DataFrame:
    """Unbounded line source. ``fmt='text'`` watches a folder; other formats
    (e.g. ``socket`` with host/port options) are passed through to ``readStream``."""
    reader = spark.readStream.format(fmt)
    for k, v in options.items():
        reader = reader.option(k, str(v))
    return reader.load(path) if fmt != "socket" else reader.load()


def read_delimited(spark: SparkSession, path: str, schema: str | T.StructType, sep: str = ",") -> DataFrame:
    """Delimited lines with a declared schema; blanks after the separator are ignored
    and a field that does not parse as its type becomes null (no job for inference)."""
    return (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("ignoreLeadingWhiteSpace", "true")
        .option("ignoreTrailingWhiteSpace", "true")
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def read_json(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """JSON lines. Pass ``schema`` in production: inference reads every line once more (a
    sample could miss a column)."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_edge_list(spark: SparkSession, path: str, skip_comments: bool = True, ids: str = "bigint") -> DataFrame:
    """Whitespace-separated ``src dst`` lines → ``edges(src, dst)`` of type ``ids``.
    Lines starting with ``#`` and lines of fewer than two fields are skipped, extra fields
    are ignored. ``ids="string"`` keeps the tokens as they are; with ``bigint`` a token
    that is no number stops the job."""
    lines = spark.read.text(path)
    if skip_comments:
        lines = lines.filter(~F.col("value").startswith("#"))
    parts = F.split(F.trim(F.col("value")), r"\s+")
    return (
        lines.filter(F.trim(F.col("value")) != "")
        .select(F.get(parts, 0).alias("src"), F.get(parts, 1).alias("dst"))
        .filter(F.col("dst").isNotNull())
        .select(F.col("src").cast(ids).alias("src"), F.col("dst").cast(ids).alias("dst"))
    )


def read_vertices(spark: SparkSession, path: str) -> DataFrame:
    """``id,name`` lines → ``vertices(id bigint, name string)``."""
    return read_delimited(spark, path, "id bigint, name string")


def read_rides(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType = RIDE_SCHEMA,
               streaming: bool = False, **options) -> DataFrame:
    """Ride records in any file format Spark reads (``.gz`` csv included), batch or stream."""
    reader = (spark.readStream if streaming else spark.read).format(fmt).schema(schema)
    for k, v in options.items():
        reader = reader.option(k, str(v))
    return reader.load(path)
