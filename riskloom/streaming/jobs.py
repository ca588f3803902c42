"""Streaming versions of batch scoring and drift monitoring.

Both are stateless per row or per micro-batch, so they need neither watermarks nor state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riskloom.operators.drift import monitor, reference_counts
from riskloom.runtime import materialize


def read_stream(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files arriving in a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def score_stream(
    requests: DataFrame, score: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, once: bool = True
):
    """Score arriving requests and append the results; the checkpoint makes the sink exactly-once."""
    writer = score(requests).writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")
    return writer.start(out)


def drift_stream(
    rows: DataFrame, reference: DataFrame, log_path: str, checkpoint: str, target: str | None = None, once: bool = True
):
    """Compare every micro-batch with the reference table and write one row of the drift log, in the folder ``batch=<number>``.

    The reference is counted once per start. A batch that runs again overwrites its own row.
    """
    counted = reference_counts(reference, target)

    def one(batch: DataFrame, number: int) -> None:
        stored = materialize(batch, "batch")
        if stored.take(1):
            monitor(reference, stored, f"{log_path}/batch={number}", f"batch-{number}", target, counted=counted, mode="overwrite")

    writer = rows.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="5 minutes")
    return writer.start()
