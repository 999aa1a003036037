"""Physical layout: summary tables, file reports, compaction."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.operators.lookup import table_bytes

# name of a partial -> how partials of it are put together again
_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def build_summary(df: DataFrame, by: Sequence[str], measures: Mapping[str, str]) -> DataFrame:
    """Additive partials per group: rows, and sum, count, min and max of each measure.

    ``measures`` maps a name to a column; a mean is asked for later as sum / count.
    """
    parts = [F.count(F.lit(1)).alias("rows")]
    for name, col in measures.items():
        parts += [F.sum(col).alias(f"{name}_sum"), F.count(col).alias(f"{name}_count"),
                  F.min(col).alias(f"{name}_min"), F.max(col).alias(f"{name}_max")]
    return df.groupBy(*by).agg(*parts)


def requery(summary: DataFrame, by: Sequence[str]) -> DataFrame:
    """Answer a coarser question from a summary table."""
    parts = [F.sum("rows").alias("rows")]
    for c in summary.columns:
        kind = c.rsplit("_", 1)[-1]
        if "_" in c and kind in _MERGE and f"{c.rsplit('_', 1)[0]}_count" in summary.columns:
            parts.append(_MERGE[kind](c).alias(c))
    return summary.groupBy(*by).agg(*parts)


def layout_report(df: DataFrame) -> DataFrame:
    """Rows and bytes per file of a table read from files."""
    return (df.select(F.col("_metadata.file_path").alias("file_path"),
                      F.col("_metadata.file_size").alias("file_size"))
            .groupBy("file_path", "file_size").agg(F.count(F.lit(1)).alias("rows")))


def layout_summary(report: DataFrame, small_bytes: int = 32 * 1024 * 1024) -> DataFrame:
    """Files, rows, bytes, the share of small files, and the largest file against the mean."""
    return report.agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"),
        F.sum("file_size").alias("bytes"),
        F.count_if(F.col("file_size") < small_bytes).alias("small_files"),
        (F.max("rows") / F.avg("rows")).alias("largest_to_mean"))


FILE_BYTES = 128 * 1024 * 1024


def compact(df: DataFrame, path: str, keys: Sequence[str], spread: Sequence[str] = (),
            n: int | None = None, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Rewrite as files sorted within key ranges, and read the result.

    Without ``n`` the number of files follows from the bytes of the rows, which one aggregate
    measures, so that a file holds about ``file_bytes`` of them at any size.

    Ranges follow ``keys`` and then ``spread``, so that a heavy key is cut into several
    files when the ``spread`` columns tell its rows apart.
    """
    if n is None:
        n = max(1, -(-table_bytes(df) // file_bytes))
    ranges = [*keys, *spread]
    (df.repartitionByRange(n, *ranges).sortWithinPartitions(*ranges)
     .write.parquet(path))
    return df.sparkSession.read.schema(df.schema).parquet(path)
