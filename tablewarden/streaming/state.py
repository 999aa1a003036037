"""Streams that keep tables: late rows set aside, and upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tablewarden.operators.cleaning import dedupe_keep
from tablewarden.operators.monitoring import interval
from tablewarden.sources.sinks import current_version, publish, read_published
from tablewarden.sources.streams import run_batches, write_batch


def stream_late(sdf: DataFrame, path: str, checkpoint: str, late_seconds: float, ts: str = "ts"
                ) -> StreamingQuery:
    """Store arrivals partitioned by whether they are ``late``.

    A row is late when it is more than ``late_seconds`` behind the newest time of all
    earlier batches. That time is stored per batch, so a repeated batch decides as before and
    each batch reads one mark, however many came before it.
    """
    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = (spark.read.schema("mark timestamp_ntz").parquet(f"{path}/marks/batch_id={batch_id - 1}")
                .first()["mark"] if batch_id else None)
        known = F.lit(mark).cast("timestamp_ntz")
        time = F.col(ts).cast("timestamp_ntz")
        late = time < known - interval(late_seconds) if mark is not None else F.lit(False)
        write_batch(batch.withColumn("late", late), batch_id, f"{path}/rows", ["late"])
        newest = batch.agg(F.greatest(F.max(time), known).alias("mark"))
        write_batch(newest, batch_id, f"{path}/marks")
    return run_batches(sdf, work, checkpoint)


def stream_upsert(sdf: DataFrame, path: str, keys: Sequence[str], order: Sequence[str],
                  checkpoint: str, fold_every: int = 50) -> StreamingQuery:
    """Keep the newest row per key of a stream, whatever order rows arrive in.

    The row with the highest ``order`` is the newest; of equal ones the later batch counts.
    Each batch stores its own newest rows, so its cost follows the batch and not the
    table. Every ``fold_every`` batches the stored rows are folded into a new base; a
    repeated batch reads only older bases and leaves a base that is there as it is.
    """
    def work(batch: DataFrame, batch_id: int) -> None:
        write_batch(dedupe_keep(batch, keys, _newest(order)), batch_id, f"{path}/changes")
        if batch_id and batch_id % fold_every == 0:
            publish(_upserted(batch.sparkSession, path, keys, order, batch_id), f"{path}/base", batch_id)
    return run_batches(sdf, work, checkpoint)


def _newest(order: Sequence[str]) -> list[str]:
    return [o[1:] if o.startswith("-") else f"-{o}" for o in order]


def _upserted(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str],
              upto: int | None) -> DataFrame:
    """Base and later changes, with the batch each row came in."""
    base_path = f"{path}/base"
    version = current_version(spark, base_path, upto)
    changes = spark.read.parquet(f"{path}/changes").where(F.col("batch_id") > (-1 if version is None else version))
    if upto is not None:
        changes = changes.where(F.col("batch_id") <= upto)
    rank = [*_newest(order), "-batch_id"]
    if version is None:
        return dedupe_keep(changes, keys, rank)
    base = read_published(spark, base_path, version)
    touched = changes.select(*keys).distinct()
    rivals = base.join(touched, list(keys), "left_semi").unionByName(changes)
    # Rows of the base without a change pass through.
    return base.join(touched, list(keys), "left_anti").unionByName(dedupe_keep(rivals, keys, rank))


def read_upserted(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]
                  ) -> DataFrame:
    """The table that ``stream_upsert`` keeps: the base with later changes on top."""
    return _upserted(spark, path, keys, order, None).drop("batch_id")
