"""Run a streaming query to the end of its available input and read the result back.

With ``arrivals`` (a ``Replay``'s steps) the query runs once per arrival on one checkpoint;
without, once. Results go to a fresh folder under the shared checkpoint root (never to the driver):
append mode uses the exactly-once parquet file sink; update mode writes one
partition per micro-batch and the latest row per key is chosen by Spark on read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import scratch_path


def _finish(q, timeout_s: float | None) -> None:
    """Wait for the end of the input; a time-out or a failed query raises, never a part of
    the result."""
    try:
        q.awaitTermination(timeout_s)
        late = q.isActive
    finally:
        if q.isActive:
            q.stop()
    if q.exception() is not None:
        raise q.exception()
    if late:
        raise TimeoutError(f"the stream was still running after {timeout_s} s")


def run_append(stream: DataFrame, spark: SparkSession, name: str, timeout_s: float | None = None,
               arrivals: Iterable[None] = (None,)) -> DataFrame:
    out = scratch_path(spark, f"{name}-out")
    ckpt = scratch_path(spark, f"{name}-ckpt")
    for _ in arrivals:
        q = (stream.writeStream.format("parquet").outputMode("append")
             .option("path", out).option("checkpointLocation", ckpt)
             .trigger(availableNow=True).queryName(f"{name}_{abs(hash(out)) % 10**8}").start())
        _finish(q, timeout_s)
    return spark.read.schema(stream.schema).parquet(out)


def run_batches(stream: DataFrame, spark: SparkSession, name: str, outputs: dict[str, str],
                process: Callable[[DataFrame, int], dict[str, DataFrame]], timeout_s: float | None = None,
                arrivals: Iterable[None] = (None,), output_mode: str = "append") -> dict[str, DataFrame]:
    """Every micro-batch becomes the frames ``process(batch, batch_id)`` names, written to
    ``<output>/batch=<id>`` (overwritten on a replay). ``outputs`` maps a name to its schema;
    returns a frame per output with all batches, ``batch`` included."""
    root = scratch_path(spark, f"{name}-batches")
    ckpt = scratch_path(spark, f"{name}-ckpt")
    batches: set[int] = set()

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for key, df in process(batch, batch_id).items():
                df.write.mode("overwrite").parquet(f"{root}/{key}/batch={batch_id}")
            batches.add(batch_id)
        finally:
            batch.unpersist()

    for _ in arrivals:
        q = (stream.writeStream.outputMode(output_mode).foreachBatch(write_batch)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        _finish(q, timeout_s)
    with_batch = {key: f"{schema}, batch int" for key, schema in outputs.items()}
    if not batches:  # the input was empty
        return {key: spark.createDataFrame([], schema) for key, schema in with_batch.items()}
    return {key: spark.read.schema(schema).parquet(f"{root}/{key}") for key, schema in with_batch.items()}


def run_update_log(stream: DataFrame, spark: SparkSession, name: str, keys: list[str],
                   output_mode: str = "update", timeout_s: float | None = None,
                   arrivals: Iterable[None] = (None,)) -> DataFrame:
    """Every micro-batch's changed rows go to ``batch=<id>`` (overwritten on retry, so a
    replayed batch is idempotent); the result is the last version of each key."""
    out = scratch_path(spark, f"{name}-log")
    ckpt = scratch_path(spark, f"{name}-ckpt")
    schema = stream.schema

    batches: set[int] = set()

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        batches.add(batch_id)

    for _ in arrivals:
        q = (stream.writeStream.outputMode(output_mode).foreachBatch(write_batch)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        _finish(q, timeout_s)
    if not batches:  # the input was empty
        return spark.createDataFrame([], schema)
    log = spark.read.parquet(out)
    values = [c for c in schema.names if c not in keys]
    latest = log.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_v"))
    return latest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])


def run_fanout(stream: DataFrame, spark: SparkSession, name: str,
               outputs: dict[str, Callable[[DataFrame], DataFrame]],
               timeout_s: float | None = None) -> dict[str, DataFrame]:
    """Several results from one stream with one source read per micro-batch.

    Each micro-batch is persisted once and every stateless output function is
    applied to it; output ``k`` of batch ``b`` goes to ``<k>/batch=<b>`` (overwritten
    on a replay). Returns one DataFrame per output (all batches).
    """
    root = scratch_path(spark, f"{name}-fanout")
    ckpt = scratch_path(spark, f"{name}-ckpt")

    batches: set[int] = set()

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for key, fn in outputs.items():
                fn(batch).write.mode("overwrite").parquet(f"{root}/{key}/batch={batch_id}")
            batches.add(batch_id)
        finally:
            batch.unpersist()

    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    _finish(q, timeout_s)
    if not batches:  # the input was empty
        empty = spark.createDataFrame([], stream.schema)
        return {key: fn(empty) for key, fn in outputs.items()}
    return {key: spark.read.parquet(f"{root}/{key}").drop("batch") for key in outputs}
