"""Cleaning: text, missing values, casts, repeats, outliers, masking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.functions.columns import NULL_TOKENS, null_if_token, parse_any_date, tidy_text
from tablewarden.operators.lookup import broadcast_if_small, lookup_join
from tablewarden.operators.ordered import (
    MAX_GROUP_ROWS, last_known, number_rows, sort_columns)
from tablewarden.operators.quantiles import exact_quantiles
from tablewarden.storage import materialize


def _replace(df: DataFrame, new: Mapping[str, Column]) -> DataFrame:
    return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


def normalize_text(df: DataFrame, cols: Sequence[str], case: str | None = None) -> DataFrame:
    return _replace(df, {c: tidy_text(F.col(c), case) for c in cols})


def nullify(df: DataFrame, cols: Sequence[str], tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    return _replace(df, {c: null_if_token(F.col(c), tokens) for c in cols})


def cast_or_reject(df: DataFrame, schema: T.StructType, reasons: str = "reject_reasons"
                   ) -> DataFrame:
    """Cast the columns of ``schema``; what does not fit becomes NULL with a reason."""
    casts = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema}
    failed = F.array_compact(F.array(*[
        F.when(F.col(n).isNotNull() & c.isNull(), F.lit(f"{n}: not {schema[n].dataType.simpleString()}"))
        for n, c in casts.items()]))
    return df.select(*[casts[c].alias(c) if c in casts else F.col(c) for c in df.columns],
                     failed.alias(reasons))


def parse_date(df: DataFrame, col: str, formats: Sequence[str]) -> DataFrame:
    return _replace(df, {col: parse_any_date(F.col(col), formats)})


def map_codes(df: DataFrame, lookup: DataFrame, key: str, value: str, default: str) -> DataFrame:
    """Replace a code by its entry in ``lookup``, or by ``default`` when there is none."""
    return lookup_join(df, lookup.select(key, value), [key], measure=True).fillna({value: default})


def fill_const(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(values))


def fill_group(df: DataFrame, col: str, by: Sequence[str], how: str = "mean",
               max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Fill NULLs with the mean, median or mode of the group.

    The statistic comes from an aggregate that is joined back, so no task holds a group.
    The mode is the most frequent value; the smallest of several. Decimals stay decimals, with
    the mean or median rounded to their scale; other numbers become doubles.
    """
    present = df.where(F.col(col).isNotNull())
    if how == "mean":
        stats = present.groupBy(*by).agg(
            (F.sum(col).cast("double") / F.count(F.lit(1))).alias("_fill"))
    elif how == "median":
        stats = exact_quantiles(df, by, col, {"_fill": 0.5}, max_rows)
    elif how == "mode":
        counts = present.groupBy(*by, col).agg(F.count(F.lit(1)).alias("_n"))
        stats = counts.groupBy(*by).agg(
            F.min_by(col, F.struct(-F.col("_n"), F.col(col))).alias("_fill"))
    else:
        raise ValueError(how)
    own = df.schema[col].dataType
    kind = own if how == "mode" or isinstance(own, T.DecimalType) else "double"
    filled = F.coalesce(F.col(col).cast(kind), F.col("_fill").cast(kind))
    return (_replace(join_group_stats(df, stats, by).withColumn("_filled", filled),
                     {col: F.col("_filled")}).select(*df.columns))


def join_group_stats(df: DataFrame, stats: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bring one row per group back to its members; NULL groups match too.

    The statistics are stored, so that measuring them for a broadcast does not compute them
    twice; the table itself is shuffled only when they are large.
    """
    stats = broadcast_if_small(materialize(stats, "group_stats"))
    named = stats.select(*[F.col(b).alias(f"_g_{b}") for b in by],
                         *[c for c in stats.columns if c not in by])
    on = [F.col(b).eqNullSafe(F.col(f"_g_{b}")) for b in by]
    return df.join(named, on, "left").drop(*[f"_g_{b}" for b in by])


def fill_forward(df: DataFrame, col: str, by: Sequence[str], order: Sequence[str],
                 max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    return last_known(df, by, order, [col], max_rows)


def dedupe_exact(df: DataFrame) -> DataFrame:
    return df.distinct()


def dedupe_keep(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key. Spark keeps one row per key and task before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*sort_columns(order))
    return (df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn"))


def outliers_z(df: DataFrame, col: str, by: Sequence[str], k: float = 3.0) -> DataFrame:
    """Rows more than ``k`` standard deviations from the mean of their group, with ``z``.

    A group with no spread has no outliers (its z is NULL).
    """
    stats = df.groupBy(*by).agg(F.avg(col).alias("_mean"), F.stddev_samp(col).alias("_sd"))
    z = (F.col(col) - F.col("_mean")) / F.nullif(F.col("_sd"), F.lit(0.0))
    return (join_group_stats(df, stats, by).withColumn("z", z)
            .where(F.abs("z") > k).drop("_mean", "_sd"))


def outliers_iqr(df: DataFrame, col: str, by: Sequence[str], k: float = 1.5,
                 max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Rows outside the quartiles by more than ``k`` interquartile ranges."""
    stats = exact_quantiles(df, by, col, {"q1": 0.25, "q3": 0.75}, max_rows)
    spread = k * (F.col("q3") - F.col("q1"))
    return join_group_stats(df, stats, by).where(
        (F.col(col) < F.col("q1") - spread) | (F.col(col) > F.col("q3") + spread))


def winsorize(df: DataFrame, col: str, by: Sequence[str], low: float = 0.05, high: float = 0.95,
              max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Cap ``col`` to two quantiles of its group."""
    stats = exact_quantiles(df, by, col, {"_low": low, "_high": high}, max_rows)
    capped = F.when(F.col(col).isNotNull(),
                    F.least(F.greatest(F.col(col), F.col("_low")), F.col("_high")))
    return (join_group_stats(df, stats, by).withColumn("_capped", capped)
            .select(*[F.col("_capped").alias(c) if c == col else F.col(c) for c in df.columns]))


def bucketize(df: DataFrame, col: str, n: int, how: str = "width", order: Sequence[str] = (),
              name: str = "bucket", max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Bucket number from 1: equal-width over the range, or equal-count by rank."""
    if how == "width":
        edges = df.agg(F.struct(F.min(col).cast("double").alias("low"),
                                F.max(col).cast("double").alias("high"))).scalar()
        low, high = edges["low"], edges["high"]
        value = F.col(col).cast("double")
        place = F.floor((value - low) / F.nullif(high - low, F.lit(0.0)) * n) + 1
        return df.withColumn(name, F.when(value.isNotNull(),
                                          F.least(F.coalesce(place, F.lit(1)), F.lit(n).cast("bigint"))))
    ranked = number_rows(df, [], [col, *order], "_rank", max_rows)
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return ranked.withColumn(name, ntile_of(F.col("_rank"), rows, n)).drop("_rank")


def ntile_of(rank: Column, rows: Column, n: int) -> Column:
    """The bucket that ``ntile(n)`` gives to a rank among ``rows`` rows.

    The first ``rows % n`` buckets hold one row more than the others.
    """
    size = F.floor(rows / n)
    bigger = rows % n
    edge = bigger * (size + 1)
    return F.when(rank <= edge, F.floor((rank - 1) / (size + 1)) + 1).otherwise(
        bigger + F.floor((rank - 1 - edge) / F.nullif(size, F.lit(0))) + 1)


def mask(df: DataFrame, col: str, pattern: str, replacement: str = "***",
         contains: str | None = None) -> DataFrame:
    """Replace every match of ``pattern``.

    ``contains`` names a text that every match holds; values without it skip the pattern.
    """
    masked = F.regexp_replace(F.col(col), pattern, replacement)
    if contains is not None:
        masked = F.when(F.contains(F.col(col), F.lit(contains)), masked).otherwise(F.col(col))
    return _replace(df, {col: masked})
