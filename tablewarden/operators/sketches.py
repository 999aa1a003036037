"""Summary tables with mergeable sketches: distinct counts and quantiles at any coarser level.

Sums and counts of ``layout.build_summary`` add up; distinct counts and quantiles do not. Here a
group keeps a sketch of bounded size for each, so a new load is one more set of rows, and any coarser
question is answered by merging sketches instead of reading the table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_REGISTERS = 14  # 16,384 registers: relative error 0.8 % (one standard deviation)
QUANTILE_K = 400  # error of a rank about 0.9 % of the rows, at 99 % confidence

_DISTINCT, _QUANTILE = "_distinct_sketch", "_quantile_sketch"


def _named(df: DataFrame, ending: str) -> list[str]:
    return [c.removesuffix(ending) for c in df.columns if c.endswith(ending)]


def build_sketches(df: DataFrame, by: Sequence[str], distinct: Mapping[str, str] = {},
                   quantiles: Mapping[str, str] = {}, lg_registers: int = LG_REGISTERS,
                   k: int = QUANTILE_K) -> DataFrame:
    """Per group: ``rows``, and a sketch per name of the mappings from names to columns.

    ``distinct`` takes integers, texts and binary values; ``quantiles`` takes numbers, as doubles.
    NULLs are in no sketch, NaN in no quantile. A hot group is sketched map-side, so what meets in
    one task is a sketch per task.
    """
    parts = [F.count(F.lit(1)).alias("rows")]
    parts += [F.hll_sketch_agg(c, F.lit(lg_registers)).alias(f"{name}{_DISTINCT}")
              for name, c in distinct.items()]
    parts += [F.kll_sketch_agg_double(
        F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")), F.lit(k))
        .alias(f"{name}{_QUANTILE}") for name, c in quantiles.items()]
    return df.groupBy(*by).agg(*parts)


def merge_sketches(sketched: DataFrame, by: Sequence[str]) -> DataFrame:
    """The same table at a coarser level, or of several loads put together."""
    return sketched.groupBy(*by).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        *[F.hll_union_agg(f"{n}{_DISTINCT}").alias(f"{n}{_DISTINCT}")
          for n in _named(sketched, _DISTINCT)],
        *[F.kll_merge_agg_double(f"{n}{_QUANTILE}").alias(f"{n}{_QUANTILE}")
          for n in _named(sketched, _QUANTILE)])


def estimates(sketched: DataFrame, at: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Sketches as numbers: ``<name>_distinct``, and ``<name>_quantiles``, an array in the order of ``at``.

    A group without values has 0 distinct ones and NULL for quantiles.
    """
    def quantile(name: str):
        sketch = F.col(f"{name}{_QUANTILE}")
        wanted = F.array(*[F.lit(float(q)) for q in at])
        return F.when(F.kll_sketch_get_n_double(sketch) > 0,
                      F.kll_sketch_get_quantile_double(sketch, wanted)).alias(f"{name}_quantiles")
    plain = [c for c in sketched.columns if not c.endswith((_DISTINCT, _QUANTILE))]
    return sketched.select(
        *plain,
        *[F.hll_sketch_estimate(f"{n}{_DISTINCT}").alias(f"{n}_distinct")
          for n in _named(sketched, _DISTINCT)],
        *[quantile(n) for n in _named(sketched, _QUANTILE)])
