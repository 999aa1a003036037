"""Incremental pickup of new files, and an idempotent sink per batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stream_table(spark: SparkSession, folder: str, glob: str, schema: str,
                 files_per_batch: int | None = None) -> DataFrame:
    """Stream of the files in ``folder`` that match ``glob``, oldest first."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def event_time(sdf: DataFrame, col: str) -> DataFrame:
    """Watermarks need a TIMESTAMP; the session time zone is UTC."""
    return sdf.withColumn(col, F.col(col).cast("timestamp"))


def run_batches(sdf: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str,
                mode: str = "append") -> StreamingQuery:
    """Process all files there are now, batch by batch, and stop.

    The checkpoint remembers the finished files; the next run takes up the newer ones.
    """
    started = (sdf.writeStream.foreachBatch(work).outputMode(mode)
               .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    started.awaitTermination()
    return started


def write_batch(batch: DataFrame, batch_id: int, path: str, by: Sequence[str] = ()) -> None:
    """Write a batch to its own partition; a repeated batch replaces itself."""
    (batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id", *by).parquet(path))


def sink_batches(sdf: DataFrame, path: str, checkpoint: str, mode: str = "append"
                 ) -> StreamingQuery:
    return run_batches(sdf, lambda batch, i: write_batch(batch, i, path), checkpoint, mode)


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What ``sink_batches`` has written; no rows when it has written none."""
    return (spark.read.option("ignoreMissingFiles", "true")
            .schema(f"{schema}, batch_id bigint").parquet(path))
