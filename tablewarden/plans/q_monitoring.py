"""Monitoring and layout queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.functions.columns import money
from tablewarden.operators import layout as Y
from tablewarden.operators import sketches as S
from tablewarden.operators import monitoring as M
from tablewarden.operators.lookup import salted_join
from tablewarden.plans.registry import query
from tablewarden.plans.values import number, small_limit
from tablewarden.sources.tables import SCHEMAS
from tablewarden.storage import materialize, new_path

LOG = ["query_log"]


_DIRTY = ["src_id", "name_raw", "segment_raw", "acctbal_raw", "nation_raw", "signup_raw", "rep"]
_PROFILED = {name: [part.split()[0] for part in schema.split(", ")] for name, schema in SCHEMAS.items()} \
    | {"dirty_customer": _DIRTY}


def _profile_sql(table, columns, distinct):
    def text(c: str, fn: str) -> str:
        return f"CAST({fn}({f'len({c})' if c == 'embedding' else c}) AS VARCHAR) AS {fn}_value"
    return "\nUNION ALL ".join(
        f"""SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS rows,
  count(*) - count({c}) AS nulls, {distinct(c)}, {text(c, 'min')}, {text(c, 'max')} FROM {table}"""
        for c in columns)


@query("\nUNION ALL ".join(_profile_sql(t, c, lambda x: f"count(DISTINCT {x}) AS distinct_values")
                           for t, c in _PROFILED.items()), ["dirty_customer"])
def m1_profile(t):
    parts = [M.profile(getattr(t, name), exact=True).withColumn("table_name", F.lit(name))
             for name in _PROFILED]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query(_profile_sql("lineitem", _PROFILED["lineitem"],
                    lambda x: f"count(DISTINCT {x}) AS distinct_values, TRUE AS close"))
def m1_profile_sketched(t):
    """The form for very large tables, next to exact counts: within five standard errors (5 %)."""
    sketch = M.profile(t.lineitem).withColumnRenamed("distinct_values", "estimate")
    exact = M.profile(t.lineitem, exact=True).select("column_name", "distinct_values")
    gap = F.abs(F.col("estimate") - F.col("distinct_values"))
    return sketch.join(exact, "column_name").select(
        F.lit("lineitem").alias("table_name"), "column_name", "rows", "nulls", "distinct_values",
        "min_value", "max_value", (gap <= 0.25 * F.col("distinct_values")).alias("close"))


@query("""WITH e AS (SELECT min(duration_ms) AS lo, max(duration_ms) AS hi FROM query_log),
b AS (SELECT CAST(least(floor((duration_ms - lo) / (hi - lo) * 20) + 1, 20) AS BIGINT) AS bucket,
  lo, hi FROM query_log, e)
SELECT bucket, count(*) AS rows,
  CAST(CAST(lo + (bucket - 1) * (hi - lo) / 20 AS DECIMAL(18,6)) AS DOUBLE) AS lower_edge
FROM b GROUP BY bucket, lo, hi""", LOG)
def m2_histogram(t):
    return M.histogram(t.query_log, "duration_ms", 20).select(
        "bucket", "rows", number("lower_edge", 6))


def _quantile(p: float, name: str, column: str = "duration_ms") -> str:
    return f"CAST(CAST(quantile_cont({column}, {p}) AS DECIMAL(18,6)) AS DOUBLE) AS {name}"


_QUANTILES = ", ".join(_quantile(p, n) for n, p in M.PERCENTILES.items())


@query(f"SELECT {_QUANTILES} FROM query_log", LOG)
def m2_quantiles(t):
    return M.quantiles(t.query_log, "duration_ms").select(*[number(p, 6) for p in M.PERCENTILES])


@query("""WITH c AS (SELECT l_partkey, count(*) AS rows FROM lineitem GROUP BY 1)
SELECT l_partkey, rows, CAST(CAST(rows / (SELECT sum(rows) FROM c) AS DECIMAL(18,8)) AS DOUBLE) AS share,
  CAST(CAST(rows / (SELECT avg(rows) FROM c) AS DECIMAL(18,6)) AS DOUBLE) AS ratio_to_mean
FROM c ORDER BY rows DESC, l_partkey LIMIT 20""")
def m3_key_skew(t):
    return M.key_skew(t.lineitem, "l_partkey", 20).select(
        "l_partkey", "rows", number("share", 8), number("ratio_to_mean", 6))


@query("""SELECT object_id, count(*) AS rows, TRUE AS close FROM query_log GROUP BY 1
ORDER BY rows DESC, object_id LIMIT 20""", LOG)
def m3_key_skew_approximate(t):
    """The heaviest objects, with whether the sketch's count is within its bound of the exact one.

    A sketch of n tracked keys is off by at most 3.5 / n of all rows (a key that it lost counts
    as none).
    """
    tracked = 10_000
    exact = t.query_log.groupBy("object_id").agg(F.count(F.lit(1)).alias("rows"))
    whole = exact.agg(F.sum("rows").alias("n")).scalar()
    sketch = M.key_skew_approximate(t.query_log, "object_id", 1000, tracked) \
        .select("object_id", F.col("rows").alias("estimate"))
    top = exact.orderBy(F.desc("rows"), "object_id").limit(20).join(sketch, "object_id", "left")
    gap = F.abs(F.coalesce("estimate", F.lit(0)) - F.col("rows"))
    return top.select("object_id", "rows", (gap <= 3.5 * whole / tracked).alias("close"))


@query("""SELECT query_id, query_class, duration_ms FROM query_log
QUALIFY row_number() OVER (PARTITION BY query_class ORDER BY duration_ms DESC, query_id) <= 10""", LOG)
def m4_slowest(t):
    return M.slowest(t.query_log, 10, ["query_class"]).select(
        "query_id", "query_class", "duration_ms")


@query(f"SELECT query_class, {_QUANTILES} FROM query_log GROUP BY 1", LOG)
def m5_latency(t):
    return M.latency(t.query_log, ["query_class"]).select(
        "query_class", *[number(p, 6) for p in M.PERCENTILES])


@query(f"""SELECT query_class, {_QUANTILES}, TRUE AS p50_close, TRUE AS p95_close, TRUE AS p99_close
FROM query_log GROUP BY 1""", LOG)
def m5_latency_approximate(t):
    """Exact quantiles, with whether the sketch's value is within its rank error (1 / accuracy)."""
    by, accuracy = ["query_class"], 10_000
    sketch = M.latency(t.query_log, by, exact=False).select(
        *by, *[F.col(p).alias(f"_{p}") for p in M.PERCENTILES])
    ranked = t.query_log.where("duration_ms IS NOT NULL").join(sketch, by)
    room = F.count(F.lit(1)) / accuracy + 1

    def close(name: str, share: float):
        place = share * F.count(F.lit(1))
        below, upto = F.count_if(F.col("duration_ms") < F.col(f"_{name}")), F.count_if(
            F.col("duration_ms") <= F.col(f"_{name}"))
        return ((below <= place + room) & (upto >= place - room)).alias(f"{name}_close")
    marks = ranked.groupBy(*by).agg(*[close(n, p) for n, p in M.PERCENTILES.items()])
    return (M.latency(t.query_log, by).select(*by, *[number(p, 6) for p in M.PERCENTILES])
            .join(marks, by))


def _throughput_sql(bucket: str, source: str, by: str = "") -> str:
    return f"""SELECT {bucket} AS bucket_start, {by} count(*) AS queries,
  count(*) FILTER (WHERE failed) AS failures,
  CAST(CAST(count(*) FILTER (WHERE failed) / count(*) AS DECIMAL(18,6)) AS DOUBLE) AS error_rate,
  CAST(sum(CAST(duration_ms AS DECIMAL(18,4))) AS DOUBLE) AS busy_ms FROM {source} GROUP BY ALL"""


def _metrics(df, *by):
    return df.select("bucket_start", *by, "queries", "failures", number("error_rate", 6),
                     F.col("busy_ms").cast("double").alias("busy_ms"))


@query(_throughput_sql("time_bucket(INTERVAL '1 hour', started_at)", "query_log",
                       "query_class,"), LOG)
def m6_throughput(t):
    return _metrics(M.throughput(t.query_log, "1 hour", by=["query_class"]), "query_class")


@query(_throughput_sql("time_bucket(INTERVAL '15 minutes', started_at) - i * INTERVAL '15 minutes'",
                       "query_log, range(4) r(i)"), LOG)
def m6_throughput_sliding(t):
    return _metrics(M.throughput(t.query_log, "1 hour", "15 minutes"))


@query("""WITH p AS (SELECT *, lag(started_at) OVER w AS b FROM query_log
  WINDOW w AS (PARTITION BY session_id ORDER BY started_at, query_id)),
n AS (SELECT *, sum(CASE WHEN b IS NULL OR started_at >= b + INTERVAL 4 HOUR THEN 1 ELSE 0 END)
  OVER (PARTITION BY session_id ORDER BY started_at, query_id) AS s FROM p)
SELECT session_id, CAST(s AS BIGINT) AS session_number, min(started_at) AS first_at,
  max(started_at) AS last_at, count(*) AS queries FROM n GROUP BY session_id, s""", LOG)
def m7_sessions(t):
    return M.sessions(t.query_log, 4 * 3600)


_ACTIVE = """WITH e AS (
  SELECT query_class, started_at AS moment, 1 AS c FROM query_log UNION ALL
  SELECT query_class, started_at + to_microseconds(CAST(round(duration_ms * 60 * 1000000) AS BIGINT)), -1
  FROM query_log),
n AS (SELECT query_class, moment, sum(c) AS c FROM e GROUP BY ALL),
a AS (SELECT query_class, moment, CAST(sum(c) OVER (PARTITION BY query_class ORDER BY moment) AS BIGINT)
  AS active FROM n)"""


def _long_running(t):
    """The log with durations read as minutes, so that queries overlap."""
    return t.query_log.withColumn("duration_ms", F.round(F.col("duration_ms") * 60_000_000) / 1000)


@query(_ACTIVE + " SELECT query_class, moment, active FROM a", LOG)
def m8_concurrency(t):
    return M.concurrency(_long_running(t), ["query_class"]).select(
        "query_class", F.col("at").alias("moment"), "active")


@query(_ACTIVE + """ SELECT query_class, active AS peak, moment AS peak_at FROM a
QUALIFY row_number() OVER (PARTITION BY query_class ORDER BY active DESC, moment) = 1""", LOG)
def m8_peak_concurrency(t):
    return M.peak_concurrency(_long_running(t), ["query_class"])


def _hourly_sql(by: str = "") -> str:
    return (f"(SELECT time_bucket(INTERVAL '1 hour', started_at) AS bucket_start, {by} "
            "count(*) AS queries, count(*) FILTER (WHERE failed) AS failures FROM query_log GROUP BY ALL)")


@query(f"""SELECT bucket_start, query_class, queries,
  CAST(CAST(m AS DECIMAL(18,6)) AS DOUBLE) AS baseline,
  CAST(CAST((queries - m) / nullif(s, 0) AS DECIMAL(18,6)) AS DOUBLE) AS score
FROM (SELECT *, avg(queries) OVER w AS m, stddev_samp(queries) OVER w AS s
      FROM {_hourly_sql('query_class,')} WINDOW w AS (PARTITION BY query_class ORDER BY bucket_start
        ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))
WHERE abs((queries - m) / nullif(s, 0)) > 2""", LOG)
def m9_anomalies(t):
    hourly = materialize(M.throughput(t.query_log, "1 hour", by=["query_class"]), "hourly")
    return M.anomalies(hourly, "queries", 24, 2.0, ["query_class"]).select(
        "bucket_start", "query_class", "queries", number("baseline", 6), number("score", 6))


@query("""SELECT query_class, started_at AS quiet_from, n AS quiet_to,
  CAST(epoch_us(n) - epoch_us(started_at) AS DOUBLE) / 1e6 AS gap_seconds
FROM (SELECT *, lead(started_at) OVER (PARTITION BY query_class ORDER BY started_at, query_id) AS n
      FROM query_log)
WHERE (epoch_us(n) - epoch_us(started_at)) / 1e6 > 3600""", LOG)
def m10_gaps(t):
    return M.gaps(t.query_log, 3600, ["query_class"])


_SPLIT = "started_at >= TIMESTAMP '2024-01-16'"


@query(f"SELECT query_class, {_QUANTILES} FROM query_log GROUP BY 1", LOG)
def m5_latency_split(t):
    """Every class is above the group limit here and is worked on in slices."""
    return M.latency(t.query_log, ["query_class"], max_rows=small_limit(t.events)).select(
        "query_class", *[number(p, 6) for p in M.PERCENTILES])


@query("""WITH p AS (SELECT *, lag(started_at) OVER w AS b FROM query_log
  WINDOW w AS (PARTITION BY query_class ORDER BY started_at, query_id)),
n AS (SELECT *, sum(CASE WHEN b IS NULL OR started_at >= b + INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
  OVER (PARTITION BY query_class ORDER BY started_at, query_id) AS s FROM p)
SELECT query_class, CAST(s AS BIGINT) AS session_number, min(started_at) AS first_at,
  max(started_at) AS last_at, count(*) AS queries FROM n GROUP BY query_class, s""", LOG)
def m7_sessions_split(t):
    """Runs per query class, each class above the group limit."""
    return M.sessions(t.query_log, 1800, by="query_class", max_rows=small_limit(t.events))


@query(f"""WITH s AS (SELECT query_class,
  quantile_cont(duration_ms, 0.5) FILTER (WHERE NOT {_SPLIT}) AS b5,
  quantile_cont(duration_ms, 0.5) FILTER (WHERE {_SPLIT}) AS a5,
  quantile_cont(duration_ms, 0.95) FILTER (WHERE NOT {_SPLIT}) AS b9,
  quantile_cont(duration_ms, 0.95) FILTER (WHERE {_SPLIT}) AS a9 FROM query_log GROUP BY 1)
SELECT query_class, CAST(CAST(b5 AS DECIMAL(18,6)) AS DOUBLE) AS before_p50,
  CAST(CAST(a5 AS DECIMAL(18,6)) AS DOUBLE) AS after_p50,
  CAST(CAST(b9 AS DECIMAL(18,6)) AS DOUBLE) AS before_p95,
  CAST(CAST(a9 AS DECIMAL(18,6)) AS DOUBLE) AS after_p95,
  CAST(CAST(a5 / nullif(b5, 0) AS DECIMAL(18,6)) AS DOUBLE) AS change FROM s""", LOG)
def m11_compare_periods(t):
    return M.compare_periods(t.query_log, "2024-01-16", ["query_class"]).select(
        "query_class", *[number(c, 6) for c in ("before_p50", "after_p50", "before_p95",
                                                "after_p95", "change")])


@query("""WITH u AS (SELECT object_id, count(*) AS uses, max(started_at) AS last_used
  FROM query_log GROUP BY 1),
o AS (SELECT CAST(s_suppkey AS INTEGER) AS object_id, s_name FROM supplier)
SELECT object_id, s_name, coalesce(uses, 0) AS uses, last_used,
  rank() OVER (ORDER BY coalesce(uses, 0) DESC) AS usage_rank
FROM o LEFT JOIN u USING (object_id)""", LOG)
def m12_object_usage(t):
    objects = t.supplier.select(F.col("s_suppkey").cast("int").alias("object_id"), "s_name")
    return M.object_usage(t.query_log, objects).select(
        "object_id", "s_name", "uses", "last_used", "usage_rank")


@query(f"""WITH m AS (SELECT *, row_number() OVER (PARTITION BY query_class ORDER BY bucket_start) AS p
  FROM {_hourly_sql('query_class,')}),
b AS (SELECT *, 'quiet' AS rule FROM m WHERE queries <= 2 UNION ALL
      SELECT *, 'busy' AS rule FROM m WHERE queries >= 4),
r AS (SELECT *, p - row_number() OVER (PARTITION BY query_class, rule ORDER BY bucket_start) AS g FROM b)
SELECT query_class, rule, min(bucket_start) AS first_breach, max(bucket_start) AS last_breach,
  count(*) AS breaches FROM r GROUP BY query_class, rule, g HAVING count(*) >= 3""", LOG)
def m13_alerts(t):
    hourly = materialize(M.throughput(t.query_log, "1 hour", by=["query_class"]), "hourly")
    return M.alerts(hourly, {"quiet": "queries <= 2", "busy": "queries >= 4"}, 3,
                    ["query_class"])


@query("""SELECT l_returnflag, count(*) AS rows,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS price_sum, count(*) AS price_count,
  CAST(min(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS price_min,
  CAST(max(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS price_max
FROM lineitem GROUP BY 1""")
def m14_summary_requery(t):
    """A daily summary table answers the question per return flag."""
    daily = Y.build_summary(
        t.lineitem.withColumn("price", money("l_extendedprice")),
        ["l_returnflag", "l_linestatus", "l_shipdate"], {"price": "price"})
    path = new_path(t.spark, "summary")
    daily.write.parquet(path)
    return Y.requery(t.spark.read.parquet(path), ["l_returnflag"]).select(
        "l_returnflag", "rows", "price_count",
        *[F.col(f"price_{k}").cast("double").alias(f"price_{k}") for k in ("sum", "min", "max")])


@query("""SELECT 'lineitem' AS table_name, count(*) AS rows FROM lineitem UNION ALL
SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'events', count(*) FROM events""")
def m15_layout_rows(t):
    """The report's rows per table add up to the table."""
    parts = [Y.layout_summary(Y.layout_report(getattr(t, name))).select(
        F.lit(name).alias("table_name"), "rows") for name in ("lineitem", "orders", "events")]
    return parts[0].union(parts[1]).union(parts[2])


@query("""SELECT count(*) AS rows, TRUE AS has_bytes, TRUE AS all_files, TRUE AS small_within,
  TRUE AS largest_above_mean FROM lineitem""")
def m15_layout_report(t):
    """The report of the table: its rows, and what has to hold for its files."""
    report = Y.layout_summary(Y.layout_report(t.lineitem))
    return report.select(
        "rows", (F.col("bytes") > 0).alias("has_bytes"),
        (F.col("files") == len(t.lineitem.inputFiles())).alias("all_files"),
        F.col("small_files").between(0, F.col("files")).alias("small_within"),
        (F.col("largest_to_mean") >= 1).alias("largest_above_mean"))


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_extendedprice
FROM lineitem""")
def m16_compact(t):
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                              "l_shipdate", "l_extendedprice")
    return Y.compact(lines, new_path(t.spark, "compact"), ["l_shipdate"], ["l_orderkey"])


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, s_name
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""")
def m17_salted_join(t):
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                              "l_shipdate")
    names = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return salted_join(lines, names, ["l_suppkey"], salts=8)


_LEVELS = {"flag": ["l_returnflag"], "status": ["l_linestatus"], "all": []}


def _level_sql(level: str, by: list[str]) -> str:
    group = f"coalesce({by[0]}, '')" if by else "''"
    return f"""SELECT '{level}' AS level, {group} AS grp, count(*) AS rows,
  count(DISTINCT l_partkey) AS parts, TRUE AS parts_within, TRUE AS median_within, TRUE AS p95_within
FROM lineitem GROUP BY {group}"""


@query(" UNION ALL ".join(_level_sql(level, by) for level, by in _LEVELS.items()))
def m18_sketch_requery(t):
    """Distinct parts and price quantiles of three levels, from daily sketches stored in two loads.

    Next to the exact counts stands whether the sketch is within three standard deviations, and
    whether the rows below an estimated quantile are its share of all to within 0.02.
    """
    lines = t.lineitem.select("l_returnflag", "l_linestatus", "l_shipdate", "l_partkey", "l_extendedprice")
    path, odd = new_path(t.spark, "sketches"), F.pmod(F.col("l_orderkey"), F.lit(2)) == 1
    for load in (t.lineitem.where(odd), t.lineitem.where(~odd)):
        S.build_sketches(load, ["l_returnflag", "l_linestatus", "l_shipdate"], {"part": "l_partkey"},
                         {"price": "l_extendedprice"}).write.mode("append").parquet(path)
    daily, out = t.spark.read.parquet(path), None
    for level, by in _LEVELS.items():
        grp = F.coalesce(F.col(by[0]), F.lit("")) if by else F.lit("")
        merged = S.merge_sketches(daily.withColumn("grp", grp), ["grp"])
        # One row per group of a level.
        found = F.broadcast(S.estimates(merged, (0.5, 0.95)).drop("rows"))
        counted = (lines.withColumn("grp", grp).join(found, "grp").groupBy("grp").agg(
            F.count(F.lit(1)).alias("rows"), F.count_distinct("l_partkey").alias("parts"),
            F.first("part_distinct").alias("estimate"),
            *[F.count_if(F.col("l_extendedprice") < F.col("price_quantiles")[i]).alias(f"below_{i}")
              for i in (0, 1)],
            *[F.count_if(F.col("l_extendedprice") <= F.col("price_quantiles")[i]).alias(f"upto_{i}")
              for i in (0, 1)]))

        def within(i: int, q: float):
            return ((F.col(f"below_{i}") <= (q + 0.02) * F.col("rows"))
                    & (F.col(f"upto_{i}") >= (q - 0.02) * F.col("rows")))
        answer = counted.select(
            F.lit(level).alias("level"), "grp", "rows", "parts",
            (F.abs(F.col("estimate") - F.col("parts")) <= 0.025 * F.col("parts")).alias("parts_within"),
            within(0, 0.5).alias("median_within"), within(1, 0.95).alias("p95_within"))
        out = answer if out is None else out.unionByName(answer)
    return out
