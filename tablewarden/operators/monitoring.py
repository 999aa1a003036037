"""Monitoring over log tables: profiles, latency, throughput, sessions, alerts.

A log has query_id, started_at, session_id, query_class, duration_ms, object_id, failed.
Metrics per time bucket are aggregated first, so the windows over them are small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.operators.lookup import lookup_join
from tablewarden.operators.ordered import (
    MAX_GROUP_ROWS, arrange, limit_if_exceeded, number_rows, running, windowed)
from tablewarden.operators.quantiles import approximate_quantiles, exact_quantiles
from tablewarden.operators.reshape import rank_in, top_k

PERCENTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def interval(seconds: float | Column) -> Column:
    value = seconds if isinstance(seconds, Column) else F.lit(seconds)
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), value.cast("decimal(18,6)"))


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / 1e6


def profile(df: DataFrame, exact: bool | Sequence[str] = False) -> DataFrame:
    """One row per column: rows, NULLs, distinct values, minimum and maximum as text.

    One pass, with distinct counts from sketches. Columns named in ``exact`` (or all of them) are
    counted exactly, each by a scan of that column alone. Arrays, maps and structs are told
    apart by a hash of their JSON form, and their minimum and maximum are of the size (fields
    of a struct).
    """
    counted = set(df.columns if exact is True else exact or ())
    aggregates = [F.count(F.lit(1)).alias("rows")]
    distinct = []
    for i, field in enumerate(df.schema):
        value = measured = F.col(field.name)
        if isinstance(field.dataType, (T.ArrayType, T.MapType)):
            value, measured = F.xxhash64(F.to_json(value)), F.size(value)
        elif isinstance(field.dataType, T.StructType):
            value, measured = F.xxhash64(F.to_json(value)), F.lit(len(field.dataType))
        present = F.col(field.name).isNotNull()
        value, measured = F.when(present, value), F.when(present, measured)
        aggregates += [F.count_if(~present).alias(f"nulls{i}"),
                       F.min(measured).cast("string").alias(f"min{i}"),
                       F.max(measured).cast("string").alias(f"max{i}")]
        if field.name in counted:
            distinct.append(df.select(value.alias("v")).agg(F.count_distinct("v").alias("n")).scalar())
        else:
            aggregates.append(F.approx_count_distinct(value).alias(f"values{i}"))
            distinct.append(F.col(f"values{i}"))
    entries = F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(f"nulls{i}").alias("nulls"),
        distinct[i].alias("distinct_values"), F.col(f"min{i}").alias("min_value"),
        F.col(f"max{i}").alias("max_value")) for i, c in enumerate(df.columns)])
    return df.agg(*aggregates).select("rows", F.inline(entries))


def histogram(df: DataFrame, col: str, n: int) -> DataFrame:
    """Rows per equal-width bucket (from 1), with the bucket's lower edge."""
    edges = df.agg(F.struct(F.min(col).alias("low"), F.max(col).alias("high"))).scalar()
    low, high = edges["low"], edges["high"]
    place = F.floor((F.col(col) - low) / F.nullif(high - low, F.lit(0.0)) * n) + 1
    bucket = F.least(F.coalesce(place, F.lit(1)), F.lit(n).cast("bigint"))
    counted = (df.where(F.col(col).isNotNull()).groupBy(bucket.alias("bucket"))
               .agg(F.count(F.lit(1)).alias("rows")))
    return counted.withColumn("lower_edge", low + (F.col("bucket") - 1) * (high - low) / n)


def quantiles(df: DataFrame, col: str, wanted: Mapping[str, float] = PERCENTILES,
              max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    return exact_quantiles(df, [], col, wanted, max_rows)


def key_skew(df: DataFrame, key: str, k: int) -> DataFrame:
    """The ``k`` heaviest keys with their share of the rows and ratio to the mean."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    whole = counts.agg(F.struct(F.sum("rows").alias("all"), F.avg("rows").alias("mean"))).scalar()
    top = counts.orderBy(F.col("rows").desc(), F.col(key).asc_nulls_first()).limit(k)
    return top.select(key, "rows",
                      (F.col("rows") / whole["all"]).alias("share"),
                      (F.col("rows") / whole["mean"]).alias("ratio_to_mean"))


def key_skew_approximate(df: DataFrame, key: str, k: int, tracked: int = 10_000) -> DataFrame:
    """Heaviest keys from a bounded sketch: no shuffle of the keys."""
    top = df.agg(F.expr(f"approx_top_k({key}, {k}, {tracked})").alias("top"))
    return top.select(F.inline("top")).toDF(key, "rows")


def slowest(log: DataFrame, k: int, by: Sequence[str]) -> DataFrame:
    return top_k(log, k, ["-duration_ms", "query_id"], by)


def latency(log: DataFrame, by: Sequence[str], exact: bool = True,
            max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    if exact:
        return exact_quantiles(log, by, "duration_ms", PERCENTILES, max_rows)
    return approximate_quantiles(log, by, "duration_ms", PERCENTILES)


def throughput(log: DataFrame, width: str, slide: str | None = None, by: Sequence[str] = (),
               ts: str = "started_at") -> DataFrame:
    """Queries, failures, error rate and time spent per time bucket."""
    bucket = F.window(ts, width, slide) if slide else F.window(ts, width)
    return (log.groupBy(bucket.alias("w"), *by)
            .agg(F.count(F.lit(1)).alias("queries"), F.count_if("failed").alias("failures"),
                 F.sum(F.col("duration_ms").cast("decimal(18,4)")).alias("busy_ms"))
            .select(F.col("w.start").alias("bucket_start"), *by, "queries", "failures",
                    (F.col("failures") / F.col("queries")).alias("error_rate"), "busy_ms"))


def sessions(log: DataFrame, gap_seconds: float, by: str = "session_id", ts: str = "started_at",
             tie: str = "query_id", max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Runs of queries with no pause of ``gap_seconds`` or more."""
    starts = F.col("_before").isNull() | (F.col(ts) >= F.col("_before") + interval(gap_seconds))
    numbered = (arrange(log.select(by, ts, tie), [by], [ts, tie], max_rows)
                .windowed({"_before": lambda w: F.lag(ts).over(w)}, 1, 0)
                .map(lambda df: df.withColumn("_starts", starts.cast("int")))
                .running({"session_number": ("sum", "_starts")}).rows())
    return numbered.groupBy(by, "session_number").agg(
        F.min(ts).alias("first_at"), F.max(ts).alias("last_at"),
        F.count(F.lit(1)).alias("queries"))


def concurrency(log: DataFrame, by: Sequence[str] = (), ts: str = "started_at",
                max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Running work after each start or end. Work that ends at an instant ends first."""
    max_rows = limit_if_exceeded(log, by, max_rows, times=2)
    micros = F.round(F.col("duration_ms") * 1000).cast("bigint")
    ends = F.timestamp_add("MICROSECOND", micros, F.col(ts))
    work = log.select(*by, F.col(ts).alias("_start"), ends.alias("_end"))
    if max_rows is None and by:
        # One shuffle then serves both the grouping by time and the window.
        work = work.repartition(*by)
    moves = work.select(*by, F.inline(F.array(
        F.struct(F.col("_start").alias("at"), F.lit(1).alias("change")),
        F.struct(F.col("_end").alias("at"), F.lit(-1).alias("change")))))
    net = moves.groupBy(*by, "at").agg(F.sum("change").alias("change"))
    return running(net, by, ["at"], {"active": ("sum", "change")}, max_rows)


def peak_concurrency(log: DataFrame, by: Sequence[str] = (), ts: str = "started_at",
                     max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """The highest number of queries at work, and when it was first reached."""
    best = F.max_by(F.struct("active", "at"), F.struct(F.col("active"), -F.unix_micros(
        F.col("at").cast("timestamp"))))
    return (concurrency(log, by, ts, max_rows).groupBy(*by).agg(best.alias("_best"))
            .select(*by, F.col("_best.active").alias("peak"), F.col("_best.at").alias("peak_at")))


def anomalies(metric: DataFrame, value: str, span: int, k: float, by: Sequence[str] = (),
              order: str = "bucket_start", max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Buckets more than ``k`` deviations off the mean of the ``span`` buckets before them."""
    frame = {"baseline": lambda w: F.avg(value).over(w.rowsBetween(-span, -1)),
             "deviation": lambda w: F.stddev_samp(value).over(w.rowsBetween(-span, -1))}
    scored = windowed(metric, by, [order], frame, span, 0, max_rows)
    score = (F.col(value) - F.col("baseline")) / F.nullif(F.col("deviation"), F.lit(0.0))
    return scored.withColumn("score", score).where(F.abs("score") > k)


def gaps(log: DataFrame, max_gap_seconds: float, by: Sequence[str] = (), ts: str = "started_at",
         tie: str = "query_id", max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Stretches longer than ``max_gap_seconds`` without any entry."""
    following = windowed(log.select(*by, ts, tie), by, [ts, tie],
                         {"next_at": lambda w: F.lead(ts).over(w)}, 0, 1, max_rows)
    length = seconds_between(F.col(ts), F.col("next_at"))
    return (following.withColumn("gap_seconds", length)
            .where(F.col("gap_seconds") > max_gap_seconds)
            .select(*by, F.col(ts).alias("quiet_from"), F.col("next_at").alias("quiet_to"),
                    "gap_seconds"))


def compare_periods(log: DataFrame, split: str | Column, by: Sequence[str], ts: str = "started_at",
                    max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Median and p95 latency before and after a change, with the ratio of the medians."""
    moment = (F.lit(split) if isinstance(split, str) else split).cast("timestamp_ntz")
    marked = log.withColumn("_after", F.col(ts) >= moment)
    stats = exact_quantiles(marked, [*by, "_after"], "duration_ms", {"p50": 0.5, "p95": 0.95},
                            max_rows)
    def of(name, after):
        return F.max(F.when(F.col("_after") == after, F.col(name)))
    both = stats.groupBy(*by).agg(
        of("p50", False).alias("before_p50"), of("p50", True).alias("after_p50"),
        of("p95", False).alias("before_p95"), of("p95", True).alias("after_p95"))
    return both.withColumn("change", F.col("after_p50") / F.nullif(F.col("before_p50"), F.lit(0.0)))


def object_usage(log: DataFrame, objects: DataFrame, key: str = "object_id",
                 max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Uses of every object in ``objects`` (none counts as 0), ranked from the most used."""
    used = log.groupBy(key).agg(F.count(F.lit(1)).alias("uses"),
                                F.max("started_at").alias("last_used"))
    counted = lookup_join(objects, used, [key]).withColumn("uses", F.coalesce("uses", F.lit(0)))
    return rank_in(counted, [], ["-uses"], "rank", "usage_rank", max_rows=max_rows)


def alerts(metric: DataFrame, rules: Mapping[str, str], n: int, by: Sequence[str] = (),
           order: str = "bucket_start", max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Runs of at least ``n`` buckets in a row that break a rule (a SQL condition).

    Breaches are numbered within their group and rule and against all buckets; the
    difference is constant in an unbroken run.
    """
    max_rows = limit_if_exceeded(metric, by, max_rows)
    numbered = number_rows(metric, by, [order], "_place", max_rows)
    breach = F.array_compact(F.array(*[F.when(F.expr(cond), F.lit(name))
                                       for name, cond in rules.items()]))
    breaches = numbered.select(*by, order, "_place", F.explode(breach).alias("rule"))
    within = number_rows(breaches, [*by, "rule"], [order], "_nth", max_rows)
    return (within.groupBy(*by, "rule", (F.col("_place") - F.col("_nth")).alias("_run"))
            .agg(F.min(order).alias("first_breach"), F.max(order).alias("last_breach"),
                 F.count(F.lit(1)).alias("breaches"))
            .where(F.col("breaches") >= n).drop("_run"))
