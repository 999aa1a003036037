"""Queries over intervals and periods."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.operators import layout as Y
from tablewarden.operators.intervals import overlap_join
from tablewarden.operators.periods import periods, state_at
from tablewarden.plans.registry import query
from tablewarden.storage import new_path


def _minutes(column: str, minutes: int):
    return F.col(column) + F.make_dt_interval(mins=F.lit(minutes))


def _failures(t):
    failed = t.query_log.where("failed")
    return failed.select(F.col("query_id").alias("failed_id"), F.col("session_id").alias("failed_session"),
                         _minutes("started_at", -1).alias("around_from"), _minutes("started_at", 1).alias("around_to"))


@query("""WITH q AS (SELECT query_id, started_at AS a, started_at + INTERVAL 5 MINUTE AS b FROM query_log),
f AS (SELECT query_id AS failed_id, started_at - INTERVAL 1 MINUTE AS a, started_at + INTERVAL 1 MINUTE AS b
      FROM query_log WHERE failed)
SELECT query_id, failed_id FROM q JOIN f ON q.a < f.b AND f.a < q.b""", ["query_log"])
def t16_overlap_join(t):
    """What ran, within five minutes of its start, around each failure."""
    runs = t.query_log.select("query_id", F.col("started_at").alias("run_from"), _minutes("started_at", 5).alias("run_to"))
    return overlap_join(runs, _failures(t), ("run_from", "run_to"), ("around_from", "around_to")) \
        .select("query_id", "failed_id")


@query("""WITH s AS (SELECT session_id, date_trunc('day', started_at) AS day, min(started_at) AS a,
             max(started_at) + INTERVAL 60 MINUTE AS b FROM query_log GROUP BY ALL),
o AS (SELECT o_custkey AS k, o_orderkey, o_orderdate AS a, max(l_shipdate) AS b
      FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)
SELECT 'order' AS kind, x.o_orderkey AS one, y.o_orderkey AS other, greatest(x.a, y.a) AS shared_from
FROM o x JOIN o y ON x.k = y.k AND x.o_orderkey < y.o_orderkey AND x.a < y.b AND y.a < x.b AND x.a < x.b AND y.a < y.b
UNION ALL
SELECT 'session', s.session_id, f.query_id, greatest(s.a, f.started_at - INTERVAL 1 MINUTE) FROM s JOIN query_log f
ON f.failed AND f.session_id = s.session_id AND s.a < f.started_at + INTERVAL 1 MINUTE
   AND f.started_at - INTERVAL 1 MINUTE < s.b""", ["query_log"])
def t16_overlap_keyed(t):
    """Orders of a customer that were under way together, and failures within a day's session of their own."""
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("shipped"))
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate").join(lines, "o_orderkey")
    one = orders.toDF("one", "k", "a", "b")
    both = overlap_join(one, orders.toDF("other", "k2", "a2", "b2"), ("a", "b"), ("a2", "b2"), ["k"], ["k2"]) \
        .where("one < other")
    days = t.query_log.groupBy("session_id", F.date_trunc("day", "started_at")).agg(
        F.min("started_at").alias("a"), F.max("started_at").alias("last"))
    days = days.select(F.col("session_id").alias("one"), "a", _minutes("last", 60).alias("b"))
    found = overlap_join(days, _failures(t), ("a", "b"), ("around_from", "around_to"), ["one"], ["failed_session"])
    return both.select(F.lit("order").alias("kind"), "one", "other", F.greatest("a", "a2").alias("shared_from")).unionAll(
        found.select(F.lit("session"), "one", "failed_id", F.greatest("a", "around_from")))


_PERIODS = """WITH f AS (SELECT o_custkey AS k, o_orderpriority AS v, o_orderstatus = 'P' AS gone, o_orderkey AS n,
    CAST(o_orderdate AS DATE) AS a, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE)
      + CAST(200 * (o_orderkey % 5 + 1) AS INTEGER) END AS b,
    DATE '2001-01-01' + CAST(31 * (o_orderkey % 3) AS INTEGER) AS known FROM orders),
p AS (SELECT k, p, lead(p) OVER (PARTITION BY k ORDER BY p) AS q
      FROM (SELECT k, a AS p FROM f UNION SELECT k, b FROM f WHERE b IS NOT NULL)),
s AS (SELECT p.k, p, q, known, v, gone FROM p JOIN f ON f.k = p.k AND f.a <= p.p AND (f.b IS NULL OR p.p < f.b)
      QUALIFY row_number() OVER (PARTITION BY p.k, p, known ORDER BY n DESC) = 1),
c AS (SELECT *, lag(known) OVER w IS NULL OR lag(v) OVER w <> v OR lag(gone) OVER w <> gone AS changed
      FROM s WINDOW w AS (PARTITION BY k, p ORDER BY known)),
u AS (SELECT k, p, q, known, v, gone, lead(known) OVER (PARTITION BY k, p ORDER BY known) AS until FROM c WHERE changed),
i AS (SELECT *, sum(fresh) OVER (PARTITION BY k, known, until, v ORDER BY p) AS island FROM (
      SELECT *, CASE WHEN lag(q) OVER (PARTITION BY k, known, until, v ORDER BY p) = p THEN 0 ELSE 1 END AS fresh
      FROM u WHERE NOT gone)),
r AS (SELECT k AS o_custkey, v AS priority, min(p) AS valid_from, CASE WHEN count(q) = count(*) THEN max(q) END AS valid_to,
             known AS known_from, until AS known_to FROM i GROUP BY k, v, known, until, island)
"""


def _loads(t):
    """Three loads, a month apart; each overrules what earlier ones said of the same customer and time."""
    key = F.col("o_orderkey")
    day = F.to_date("o_orderdate")
    return t.orders.select(
        "o_custkey", F.col("o_orderpriority").alias("priority"), (F.col("o_orderstatus") == "P").alias("gone"),
        key.alias("n"), day.alias("valid_from"),
        F.when(key % 7 != 0, F.date_add(day, (200 * (key % 5 + 1)).cast("int"))).alias("valid_to"),
        F.date_add(F.lit("2001-01-01").cast("date"), (31 * (key % 3)).cast("int")).alias("known_at"))


@query(_PERIODS + "SELECT * FROM r")
def t17_periods(t):
    return periods(_loads(t), ["o_custkey"], ["priority"], tie=["n"], ended="gone")


@query(_PERIODS + """, asked AS (SELECT unnest([DATE '2001-01-15', DATE '2001-02-15', DATE '2001-03-15']) AS known)
SELECT asked.known AS known, o_custkey, priority FROM r, asked WHERE valid_from <= DATE '1998-06-01'
AND (valid_to IS NULL OR DATE '1998-06-01' < valid_to) AND known_from <= asked.known
AND (known_to IS NULL OR asked.known < known_to)""")
def t17_state_at(t):
    """What held on one day, as it was believed after each load."""
    table = periods(_loads(t), ["o_custkey"], ["priority"], tie=["n"], ended="gone")

    days = [F.lit(day).cast("date") for day in ("2001-01-15", "2001-02-15", "2001-03-15")]
    asked = table.withColumn("known", F.explode(F.array(*days)))
    return state_at(asked, F.lit("1998-06-01").cast("date"), F.col("known")).select("known", "o_custkey", "priority")


@query("""SELECT count(*) AS files, CAST(sum(n) AS BIGINT) AS rows, max(n) / avg(n) AS largest_to_mean,
  count(*) AS small_files, min(n) AS fewest, max(n) AS most
FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderpriority)""")
def m15_layout_known(t):
    """The report of a table whose files are known: one for each priority."""
    path = new_path(t.spark, "layout")
    t.orders.repartition("o_orderpriority").write.partitionBy("o_orderpriority").parquet(path)
    report = Y.layout_report(t.spark.read.parquet(path))
    summary = Y.layout_summary(report).select("files", "rows", "largest_to_mean", "small_files")
    return summary.crossJoin(report.agg(F.min("rows").alias("fewest"), F.max("rows").alias("most")))
