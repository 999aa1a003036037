"""Exact quantiles without holding a group in memory.

Equal values are counted first (with map-side partial sums), then the running count over
the distinct values locates the wanted ranks. A group of any size works, because the
running count splits large groups (see ``ordered``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.operators.ordered import MAX_GROUP_ROWS, limit_if_exceeded, running
from tablewarden.storage import materialize


def exact_quantiles(df: DataFrame, by: Sequence[str], col: str, wanted: Mapping[str, float],
                    max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """One row per group with the interpolated quantiles named in ``wanted``."""
    present = df.where(F.col(col).isNotNull()).select(*by, F.col(col).alias("_v"))
    counts = present.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_n"))
    limit = limit_if_exceeded(present, by, max_rows)
    if limit is not None:
        counts = materialize(counts, "value_counts")
    ranked = running(counts, by, ["_v"],
                     {"_upto": ("sum", "_n"), "_total": ("total", "_n")}, limit)

    def at(rank):
        inside = (F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto"))
        return F.max(F.when(inside, F.col("_v").cast("double")))

    outputs = []
    for name, p in wanted.items():
        place = F.lit(float(p)) * (F.col("_total") - 1)
        low, high = at(F.floor(place)), at(F.ceil(place))
        share = F.max(place - F.floor(place))
        outputs.append((low + share * (high - low)).alias(name))
    return ranked.groupBy(*by).agg(*outputs)


def approximate_quantiles(df: DataFrame, by: Sequence[str], col: str,
                          wanted: Mapping[str, float], accuracy: int = 10_000) -> DataFrame:
    """Same shape from a mergeable sketch: one partial aggregate, rank error 1/accuracy."""
    return df.groupBy(*by).agg(*[F.percentile_approx(col, float(p), accuracy).alias(n)
                                 for n, p in wanted.items()])
