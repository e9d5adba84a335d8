"""Run a batch operator on every micro-batch of a file stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def stream_table(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream with a fixed schema (streams never infer)."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def run_per_batch(stream: DataFrame, op: Callable[[DataFrame], DataFrame], sink_path: str,
                  checkpoint_location: str, available_now: bool = True) -> StreamingQuery:
    """Apply ``op`` to each micro-batch and write the result to a folder of
    its own, ``batch_id=N`` under ``sink_path`` (a partition column to its
    readers).  A batch that is replayed after a failure has the same id and
    overwrites its folder, so its rows are there once."""
    def each(batch: DataFrame, batch_id: int) -> None:
        op(batch).write.mode("overwrite").parquet(f"{sink_path.rstrip('/')}/batch_id={batch_id}")

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
