"""Micro-batch upserts into a keyed table (the batched insert/upsert, re-aimed).

Each micro-batch of a Structured Streaming source is merged into the table
with last-write-wins per key; the merged table is written as a new version
folder (``version=<epoch>``) so a batch never overwrites the files it reads,
and readers take the highest version. The stream's checkpoint location makes
a restarted or retried batch idempotent (same epoch, same folder).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triad.operators.sinks import upsert_by_key


def read_latest(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The highest version of the table (below ``before``, if given), or None when there is none."""
    try:
        versions = spark.read.option("basePath", path).parquet(f"{path}/version=*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None  # no version written yet
    if before is not None:
        versions = versions.where(F.col("version") < before)
    latest = versions.agg(F.max("version")).collect()[0][0]
    return None if latest is None else versions.where(F.col("version") == latest).drop("version")


def apply_batch(batch: DataFrame, epoch_id: int, path: str, keys: list[str], payload: list[str],
                order: list[str] | None = None) -> None:
    spark = batch.sparkSession
    base = read_latest(spark, path, before=epoch_id)  # a retried batch never reads its own folder
    stored = payload + [c for c in (order or []) if c not in payload]
    merged = upsert_by_key(batch.limit(0) if base is None else base, batch, keys, stored, order)
    merged.write.mode("overwrite").parquet(f"{path}/version={epoch_id:012d}")


def upsert_stream(stream: DataFrame, path: str, keys: list[str], payload: list[str],
                  checkpoint_location: str, order: list[str] | None = None, available_now: bool = True):
    """Start a query that upserts every micro-batch of ``stream`` into ``path``."""
    w = stream.writeStream.foreachBatch(
        lambda b, e: apply_batch(b, e, path, keys, payload, order)).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()
