"""Questions to a backup catalog: chains, recovery-point gaps, retention, health.

The catalog has one row per run: database_id, backup_id, kind (FULL, DIFF, INCR),
finished_at, size_mb, status (OK, FAILED). A database may hold most of the runs, so the
answers come from aggregates, and from ordered steps that split large databases.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.operators.ordered import MAX_GROUP_ROWS, running, windowed

BY = ["database_id"]
ORDER = ["finished_at", "backup_id"]


def _ok(catalog: DataFrame) -> DataFrame:
    return catalog.where(F.col("status") == "OK")


def mark_broken(catalog: DataFrame, max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Add ``broken``: a successful increment that no restore can use.

    A failed increment breaks the chain: the increments after it are broken until the next
    successful full or differential run.
    """
    good = F.col("status") == "OK"
    increment = F.col("kind") == "INCR"
    place = F.struct("finished_at", "backup_id")
    seen = running(catalog, BY, ORDER, {
        "_base": ("last", F.when(good & ~increment, place)),
        "_failed": ("last", F.when(~good & increment, place))}, max_rows)
    cut = F.col("_failed").isNotNull() & (F.col("_base").isNull() | (F.col("_failed") > F.col("_base")))
    return seen.withColumn("broken", good & increment & cut).drop("_base", "_failed")


def restore_chain(catalog: DataFrame, at: str | Column, max_rows: int | None = MAX_GROUP_ROWS
                  ) -> DataFrame:
    """Runs that rebuild each database at a time, with their step.

    The newest full run, the newest differential after it, and the increments after that
    which are not broken. A database with no full run before the time has no chain.
    """
    moment = (F.lit(at) if isinstance(at, str) else at).cast("timestamp_ntz")
    place = F.struct("finished_at", "backup_id")
    runs = mark_broken(catalog.where(F.col("finished_at") <= moment), max_rows)
    runs = runs.where((F.col("status") == "OK") & ~F.col("broken")).withColumn("_place", place)
    bases = runs.groupBy(*BY).agg(F.max(F.when(F.col("kind") == "FULL", F.col("_place"))).alias("_full"),
                                  F.max(F.when(F.col("kind") == "DIFF", F.col("_place"))).alias("_diff"))
    # A differential before the newest full run has no part in the chain.
    bases = bases.withColumn("_diff", F.when(F.col("_diff") > F.col("_full"), F.col("_diff")))
    base = F.coalesce("_diff", "_full")
    step = (F.when(F.col("_place") == F.col("_full"), 1)
            .when(F.col("_place") == F.col("_diff"), 2)
            .when((F.col("kind") == "INCR") & (F.col("_place") > base), 3))
    return (runs.join(bases.where(F.col("_full").isNotNull()), BY).withColumn("step", step)
            .where(F.col("step").isNotNull()).drop("_place", "_full", "_diff", "broken"))


def rpo_report(catalog: DataFrame, target_seconds: float,
               max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Gaps between usable runs that miss the recovery-point target; broken ones do not count."""
    usable = mark_broken(catalog, max_rows).where((F.col("status") == "OK") & ~F.col("broken"))
    gaps = windowed(usable, BY, ORDER,
                    {"previous_at": lambda w: F.lag("finished_at").over(w)}, 1, 0, max_rows)
    micros = F.timestamp_diff("MICROSECOND", F.col("previous_at"), F.col("finished_at"))
    return (gaps.withColumn("gap_seconds", micros / 1e6)
            .where(F.col("gap_seconds") > target_seconds)
            .select(*BY, "backup_id", "previous_at", "finished_at", "gap_seconds"))


def retention(catalog: DataFrame, policy: Mapping[str, int]) -> DataFrame:
    """Runs to keep: the newest of each of the last n days, weeks and months.

    ``policy`` maps day, week and month to n, counted back from the newest run of the
    database. One aggregate keeps one run per database, tier and period.
    """
    first_day = {
        "day": lambda d, n: F.date_sub(d, n - 1),
        "week": lambda d, n: F.date_sub(F.trunc(d, "week"), 7 * (n - 1)),
        "month": lambda d, n: F.add_months(F.trunc(d, "month"), 1 - n),
    }
    start = {"day": lambda d: d, "week": lambda d: F.trunc(d, "week"),
             "month": lambda d: F.trunc(d, "month")}
    runs = _ok(catalog).withColumn("_day", F.col("finished_at").cast("date"))
    tiers = F.array(*[F.struct(F.lit(tier).alias("tier"), start[tier](F.col("_day")).alias("period"))
                      for tier in policy])
    newest = runs.groupBy(*BY).agg(F.max("_day").alias("_newest"))
    kept = (runs.select(*BY, "backup_id", "finished_at", F.inline(tiers))
            .groupBy(*BY, "tier", "period")
            .agg(F.max(F.struct("finished_at", "backup_id")).alias("_run"))
            .join(newest, BY))
    oldest = F.coalesce(*[F.when(F.col("tier") == tier, first_day[tier](F.col("_newest"), n))
                          for tier, n in policy.items()])
    return (kept.where(F.col("period") >= oldest)
            .groupBy(*BY, F.col("_run.backup_id").alias("backup_id"),
                     F.col("_run.finished_at").alias("finished_at"))
            .agg(F.array_sort(F.collect_set("tier")).alias("tiers")))


def backup_health(catalog: DataFrame, trend: int = 5,
                  max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Per database: runs, success rate, broken increments, newest size against its trend.

    Increments are broken as in ``mark_broken``. The trend is the mean size of the ``trend``
    runs before the newest one.
    """
    runs = windowed(mark_broken(catalog, max_rows), BY, ORDER, {
        "_trend": lambda w: F.avg("size_mb").over(w.rowsBetween(-trend, -1)),
    }, trend, 0, max_rows)
    newest = F.max(F.struct("finished_at", "backup_id", "size_mb", "_trend"))
    return (runs.groupBy(*BY).agg(
        F.count(F.lit(1)).alias("runs"), F.count_if(F.col("status") == "OK").alias("ok_runs"),
        F.count_if("broken").alias("broken_increments"), newest.alias("_newest"))
        .select(*BY, "runs", "ok_runs", (F.col("ok_runs") / F.col("runs")).alias("success_rate"),
                "broken_increments", F.col("_newest.size_mb").alias("newest_size"),
                F.col("_newest._trend").alias("trend_size")))
