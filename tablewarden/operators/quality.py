"""Data-quality rules: row rules, keys, references, dependencies, reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


Rules = Mapping[str, str]


def failed_rules(rules: Rules) -> Column:
    """Names of the rules whose SQL condition is not true (a NULL result fails)."""
    return F.array_compact(F.array(*[
        F.when(~F.coalesce(F.expr(cond), F.lit(False)), F.lit(name))
        for name, cond in rules.items()]))


def check_rows(df: DataFrame, rules: Rules, name: str = "failed_rules") -> DataFrame:
    """Rows that break at least one rule, with the names of the broken rules."""
    return df.withColumn(name, failed_rules(rules)).where(F.size(name) > 0)


def split(df: DataFrame, rules: Rules, name: str = "failed_rules") -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected rows with the names of the broken rules."""
    tagged = df.withColumn(name, failed_rules(rules))
    return (tagged.where(F.size(name) == 0).drop(name), tagged.where(F.size(name) > 0))


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
            .where(F.col("rows") > 1))


def check_fk(df: DataFrame, parent: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows whose reference (child column -> parent column) is set but has no parent.

    Only the key columns of the parent are read.
    """
    keys = parent.select(*[F.col(p).alias(c) for c, p in on.items()]).distinct()
    present = df.where(F.concat(*[F.col(c).cast("string") for c in on]).isNotNull())
    return present.join(keys, list(on), "left_anti")


def check_fd(df: DataFrame, lhs: Sequence[str], rhs: str) -> DataFrame:
    """Values of ``lhs`` that go with more than one ``rhs``; NULL counts as a value."""
    return (df.groupBy(*lhs).agg((F.count_distinct(rhs) + F.max(F.col(rhs).isNull().cast("int")))
                                 .alias("value_count"))
            .where(F.col("value_count") > 1))


def quality_report(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule: rows checked, rows failed, failure rate. One pass over ``df``."""
    names = list(rules)
    counts = df.agg(F.count(F.lit(1)).alias("checked"), *[
        F.count_if(~F.coalesce(F.expr(rules[n]), F.lit(False))).alias(f"r{i}")
        for i, n in enumerate(names)])
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"r{i}").alias("failed"))
                     for i, n in enumerate(names)])
    return (counts.select("checked", F.inline(rows))
            .select("rule", "checked", "failed",
                    (F.col("failed") / F.nullif(F.col("checked"), F.lit(0))).alias("rate")))


def reconcile(source: DataFrame, target: DataFrame, keys: Sequence[str],
              measures: Sequence[str], tolerance: float = 0) -> DataFrame:
    """Keys whose row count or measure sums differ between two tables.

    Both sides are aggregated before the join, so at most one row per key is compared.
    """
    def totals(df: DataFrame, side: str) -> DataFrame:
        return df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias(f"{side}_rows"),
            *[F.sum(m).alias(f"{side}_{m}") for m in measures])
    both = totals(source, "source").join(totals(target, "target"), list(keys), "full_outer")
    differs = ~F.col("source_rows").eqNullSafe(F.col("target_rows"))
    for m in measures:
        s, t = F.col(f"source_{m}"), F.col(f"target_{m}")
        gap = F.abs(s - t) > tolerance
        differs = differs | F.coalesce(gap, s.isNull() != t.isNull())
    return both.where(differs)
