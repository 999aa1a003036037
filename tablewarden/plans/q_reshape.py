"""Transform queries."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tablewarden.functions.columns import money, null_if_token
from tablewarden.operators import cleaning as C
from tablewarden.operators import loading as L
from tablewarden.operators import quality as Q
from tablewarden.operators import reshape as R
from tablewarden.operators.ordered import arrange, running
from tablewarden.plans.registry import query
from tablewarden.plans.values import number, small_limit
from tablewarden.storage import materialize


@query("""SELECT segment, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE)
       AS revenue
FROM (SELECT src_id, segment FROM (
        SELECT src_id, rep, lower(trim(regexp_replace(name_raw, '\\s+', ' ', 'g'))) AS name,
               CASE WHEN segment_raw NOT IN ('', 'N/A') THEN segment_raw END AS segment,
               TRY_CAST(acctbal_raw AS DECIMAL(12,2)) AS acctbal FROM dirty_customer)
      WHERE segment IS NOT NULL AND acctbal IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY src_id ORDER BY rep) = 1)
JOIN orders ON o_custkey = src_id GROUP BY segment""", ["dirty_customer"])
def etl_customer_mart(t):
    """Clean, split, deduplicate, look up and sum: revenue per cleaned segment."""
    cleaned = t.dirty_customer.select(
        "src_id", "rep", "name_raw", null_if_token(F.col("segment_raw")).alias("segment"),
        F.col("acctbal_raw").try_cast("decimal(12,2)").alias("acctbal"))
    cleaned = C.normalize_text(cleaned, ["name_raw"], "lower")
    accepted, _ = Q.split(cleaned, {"segment_set": "segment IS NOT NULL",
                                    "balance_set": "acctbal IS NOT NULL"})
    customers = C.dedupe_keep(accepted, ["src_id"], ["rep"]).select("src_id", "segment")
    orders = t.orders.select(F.col("o_custkey").alias("src_id"), money("o_totalprice").alias("price"))
    return R.summarize(R.enrich(orders, customers, ["src_id"]), ["segment"], {
        "orders": F.count(F.lit(1)), "revenue": F.sum("price").cast("double")})


@query("""SELECT o_orderkey, o_custkey, c_name, c_mktsegment FROM orders
LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal >= 0""")
def t1_enrich(t):
    solvent = t.customer.where("c_acctbal >= 0").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return R.enrich(t.orders.select("o_orderkey", "o_custkey"), solvent, ["o_custkey"], "left")


@query("""SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 45)""")
def t2_keep_matching(t):
    big = t.lineitem.where("l_quantity >= 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return R.keep_matching(t.orders.select("o_orderkey", "o_custkey"), big, ["o_orderkey"])


@query("""SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def t2_drop_matching(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return R.drop_matching(t.orders.select("o_orderkey", "o_custkey"), lines, ["o_orderkey"])


@query("""WITH e AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate,
    l_extendedprice FROM lineitem),
v AS (SELECT o_orderkey, o_orderstatus, TIMESTAMP '1990-01-01' AS f, 0 AS n FROM orders_v0
  UNION ALL SELECT o_orderkey, o_orderstatus, TIMESTAMP '2000-07-01', 1 FROM orders_v1
  UNION ALL SELECT o_orderkey, o_orderstatus, TIMESTAMP '2001-08-01', 2 FROM orders_v2)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_extendedprice, o_orderstatus
FROM e LEFT JOIN v ON v.o_orderkey = e.l_orderkey
 AND n = CASE WHEN l_shipdate < TIMESTAMP '2000-07-01' THEN 0
              WHEN l_shipdate < TIMESTAMP '2001-08-01' THEN 1 ELSE 2 END""",
       ["orders_v0", "orders_v1", "orders_v2"])
def t3_join_valid(t):
    """Lines with the order status that was on record on the day they shipped."""
    past = L.history_of([(t.orders_v0, "1990-01-01"), (t.orders_v1, "2000-07-01"),
                         (t.orders_v2, "2001-08-01")], ["o_orderkey"])
    past = materialize(past, "history")
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                              "l_shipdate", "l_extendedprice")
    return R.join_valid(lines, past.withColumnRenamed("o_orderkey", "l_orderkey"),
                        ["l_orderkey"], "l_shipdate", ["o_orderstatus"])


@query("""SELECT a.event_id, a.user_id, b.event_id AS purchase_id, b.value AS purchase_value
FROM (SELECT * FROM events WHERE event_type <> 'purchase') a
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') b
  ON a.user_id = b.user_id AND a.ts >= b.ts""")
def t4_join_asof(t):
    events = t.events.select("event_id", "user_id", "ts", "value", "event_type")
    purchases = events.where("event_type = 'purchase'").select(
        "user_id", "ts", F.col("event_id").alias("purchase_id"),
        F.col("value").alias("purchase_value"))
    others = events.where("event_type <> 'purchase'").select("event_id", "user_id", "ts")
    return (R.join_asof(others, purchases, ["user_id"], "ts", "ts",
                        ["purchase_id", "purchase_value"], tie=["purchase_id"])
            .select("event_id", "user_id", "purchase_id", "purchase_value"))


@query("""SELECT a.event_id, b.event_id AS low_id, b.value AS low_value
FROM (SELECT * FROM events WHERE value > 20) a
ASOF LEFT JOIN (SELECT * FROM events WHERE value <= 20) b
  ON a.event_type = b.event_type AND a.ts >= b.ts""")
def t4_join_asof_split(t):
    """Per event type: every type is above the group limit here."""
    events = t.events.select("event_id", "event_type", "ts", "value")
    low = events.where("value <= 20").select("event_type", "ts", F.col("event_id").alias("low_id"),
                                             F.col("value").alias("low_value"))
    high = events.where("value > 20").select("event_id", "event_type", "ts")
    return R.join_asof(high, low, ["event_type"], "ts", "ts", ["low_id", "low_value"],
                       max_rows=small_limit(t.events), tie=["low_id"]).select("event_id", "low_id", "low_value")


_PRICE = "CAST(l_extendedprice AS DECIMAL(12,2))"


@query(f"""SELECT l_returnflag, l_linestatus, count(*) AS lines,
  CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS quantity,
  CAST(sum({_PRICE}) AS DOUBLE) AS price,
  CAST(sum({_PRICE} * (1 - CAST(l_discount AS DECIMAL(12,2)))) AS DOUBLE) AS revenue,
  CAST(min({_PRICE}) AS DOUBLE) AS lowest, CAST(max({_PRICE}) AS DOUBLE) AS highest
FROM lineitem GROUP BY ALL""")
def t5_summarize(t):
    price = money("l_extendedprice")
    return R.summarize(t.lineitem, ["l_returnflag", "l_linestatus"], {
        "lines": F.count(F.lit(1)),
        "quantity": F.sum(money("l_quantity")).cast("double"),
        "price": F.sum(price).cast("double"),
        "revenue": F.sum(price * (1 - money("l_discount"))).cast("double"),
        "lowest": F.min(price).cast("double"), "highest": F.max(price).cast("double")})


def _subtotal_sql(sets: str) -> str:
    return f"""SELECT l_returnflag, l_linestatus, CAST(year(l_shipdate) AS BIGINT) AS ship_year,
  CAST(grouping(l_returnflag, l_linestatus, year(l_shipdate)) AS BIGINT) AS level,
  count(*) AS lines, CAST(sum({_PRICE}) AS DOUBLE) AS price
FROM lineitem GROUP BY {sets}"""


def _subtotals(t, how, sets=()):
    lines = t.lineitem.select("l_returnflag", "l_linestatus",
                              F.year("l_shipdate").cast("bigint").alias("ship_year"),
                              money("l_extendedprice").alias("price"))
    return R.subtotals(lines, ["l_returnflag", "l_linestatus", "ship_year"], {
        "lines": F.count(F.lit(1)), "price": F.sum("price").cast("double")}, how, sets)


@query(_subtotal_sql("ROLLUP (l_returnflag, l_linestatus, year(l_shipdate))"))
def t6_rollup(t):
    return _subtotals(t, "rollup")


@query(_subtotal_sql("CUBE (l_returnflag, l_linestatus, year(l_shipdate))"))
def t6_cube(t):
    return _subtotals(t, "cube")


@query(_subtotal_sql("GROUPING SETS ((l_returnflag, l_linestatus), (year(l_shipdate)), ())"))
def t6_grouping_sets(t):
    return _subtotals(t, "sets", [["l_returnflag", "l_linestatus"], ["ship_year"], []])


@query("""SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1""")
def t7_distinct_count(t):
    return R.distinct_count(t.orders, ["o_orderpriority"], "o_custkey", name="customers")


@query("""SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers, TRUE AS close
FROM orders GROUP BY 1""")
def t7_distinct_count_approximate(t):
    """The sketch next to the exact count: within five of its standard errors."""
    by = ["o_orderpriority"]
    sketch = R.distinct_count(t.orders, by, "o_custkey", False, rsd=0.02, name="estimate")
    exact = R.distinct_count(t.orders, by, "o_custkey", name="customers")
    gap = F.abs(F.col("estimate") - F.col("customers"))
    return exact.join(sketch, by).select(
        "o_orderpriority", "customers", (gap <= 0.1 * F.col("customers")).alias("close"))


@query("""SELECT o_orderpriority,
  CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS F,
  CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) FILTER (WHERE o_orderstatus = 'O') AS DOUBLE) AS O,
  CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS DOUBLE) AS other
FROM orders GROUP BY 1""")
def t8_pivot(t):
    return R.pivot(t.orders, ["o_orderpriority"], "o_orderstatus", ["F", "O"],
                   F.sum(money("o_totalprice")).cast("double"))


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, measure, amount FROM (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_quantity, l_discount, l_tax
  FROM lineitem) UNPIVOT (amount FOR measure IN (l_quantity, l_discount, l_tax))""")
def t8_unpivot(t):
    return R.unpivot(t.lineitem, ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                  "l_shipdate"],
                     ["l_quantity", "l_discount", "l_tax"], "measure", "amount")


@query("""SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey
  ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) AS rank FROM orders""")
def t9_row_number(t):
    return R.rank_in(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), ["o_custkey"],
                     ["-o_orderdate", "o_orderkey"], "row_number").select("o_orderkey", "rank")


def _ranks(t, kind):
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    return R.rank_in(orders, ["o_orderstatus"], ["o_orderdate"], kind)


@query("""SELECT o_orderkey, rank() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate) AS rank
FROM orders""")
def t9_rank(t):
    return _ranks(t, "rank").select("o_orderkey", "rank")


@query("""SELECT o_orderkey, dense_rank() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate)
AS rank FROM orders""")
def t9_dense_rank(t):
    return _ranks(t, "dense_rank").select("o_orderkey", "rank")


@query("""SELECT o_orderkey, CAST(CAST(percent_rank() OVER (PARTITION BY o_orderstatus
  ORDER BY o_orderdate) AS DECIMAL(18,6)) AS DOUBLE) AS rank FROM orders""")
def t9_percent_rank(t):
    return _ranks(t, "percent_rank").select("o_orderkey", number("rank", 6))


@query("""SELECT o_orderkey, ntile(7) OVER (PARTITION BY o_orderstatus
  ORDER BY o_orderdate, o_orderkey) AS rank FROM orders""")
def t9_ntile(t):
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    return R.rank_in(orders, ["o_orderstatus"], ["o_orderdate", "o_orderkey"], "ntile",
                     tiles=7).select("o_orderkey", "rank")


_EVENT_VALUE = "CAST(value AS DECIMAL(12,2))"


@query(f"""SELECT event_id,
  CAST(sum({_EVENT_VALUE}) OVER w AS DOUBLE) AS running_total, count(*) OVER w AS running_rows
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def t10_running(t):
    events = t.events.select("event_id", "user_id", "ts", money("value").alias("value"))
    return running(events, ["user_id"], ["ts", "event_id"], {
        "running_total": ("sum", "value"), "running_rows": ("count", "value")}).select(
        "event_id", F.col("running_total").cast("double").alias("running_total"), "running_rows")


@query(f"""SELECT event_id,
  CAST(sum({_EVENT_VALUE}) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS DOUBLE) AS moving_sum,
  max(value) OVER (w ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS moving_max,
  lag(value) OVER w AS previous, lead(value, 2) OVER w AS after_next
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def t10_moving(t):
    events = t.events.select("event_id", "user_id", "ts", "value")
    return R.moving(events, ["user_id"], ["ts", "event_id"], {
        "moving_sum": lambda w: F.sum(money("value")).over(w.rowsBetween(-4, 0)).cast("double"),
        "moving_max": lambda w: F.max("value").over(w.rowsBetween(-2, 2)),
        "previous": lambda w: F.lag("value").over(w),
        "after_next": lambda w: F.lead("value", 2).over(w),
    }, before=4, after=2).select("event_id", "moving_sum", "moving_max", "previous", "after_next")


@query(f"""SELECT event_id,
  CAST(sum({_EVENT_VALUE}) OVER (w ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_total,
  CAST(sum({_EVENT_VALUE}) OVER (w ROWS BETWEEN 4 PRECEDING AND 2 FOLLOWING) AS DOUBLE) AS moving_sum,
  lag(event_id, 3) OVER w AS third_before
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)""")
def t10_moving_split(t):
    """Running and moving values per event type, each type above the group limit."""
    events = t.events.select("event_id", "event_type", "ts", money("value").alias("value"))
    done = (arrange(events, ["event_type"], ["ts", "event_id"], max_rows=small_limit(t.events))
            .running({"running_total": ("sum", "value")})
            .windowed({"moving_sum": lambda w: F.sum("value").over(w.rowsBetween(-4, 2)),
                       "third_before": lambda w: F.lag("event_id", 3).over(w)}, 4, 2).rows())
    return done.select("event_id", F.col("running_total").cast("double").alias("running_total"),
                       F.col("moving_sum").cast("double").alias("moving_sum"), "third_before")


@query(f"""SELECT user_id, ts, CAST(sum({_EVENT_VALUE}) OVER w AS DOUBLE) AS moving_sum,
  count(*) OVER w AS moving_count
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts
  RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW)""")
def t10_moving_by_time(t):
    events = t.events.select("user_id", "ts", money("value").alias("value"))
    return R.moving_by_time(events, ["user_id"], "ts", 86400, "value").select(
        "user_id", "ts", F.col("moving_sum").cast("double").alias("moving_sum"), "moving_count")


@query("""SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""")
def t11_top_k(t):
    return R.top_k(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), 25,
                   ["-o_totalprice", "o_orderkey"])


@query("""SELECT o_orderkey, o_custkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3""")
def t11_top_k_per_group(t):
    return R.top_k(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), 3,
                   ["-o_totalprice", "o_orderkey"], ["o_custkey"])


_PARTIES = """WITH a AS (SELECT c_nationkey AS nation, floor(c_acctbal / 1000) AS band FROM customer),
b AS (SELECT s_nationkey AS nation, floor(s_acctbal / 1000) AS band FROM supplier)
SELECT nation, CAST(band AS BIGINT) AS band FROM ("""


def _parties(t):
    def band(df, p):
        return df.select(F.col(f"{p}_nationkey").alias("nation"),
                         F.floor(F.col(f"{p}_acctbal") / 1000).alias("band"))
    return band(t.customer, "c"), band(t.supplier, "s")


@query(_PARTIES + "FROM a UNION ALL FROM b)")
def t12_union_all(t):
    return R.union_by_name(*_parties(t))


@query(_PARTIES + "FROM a UNION FROM b)")
def t12_union(t):
    return R.union_by_name(*_parties(t), all=False)


@query(_PARTIES + "FROM a INTERSECT FROM b)")
def t12_intersect(t):
    return R.intersect(*_parties(t))


@query(_PARTIES + "FROM a INTERSECT ALL FROM b)")
def t12_intersect_all(t):
    return R.intersect(*_parties(t), all=True)


@query(_PARTIES + "FROM a EXCEPT FROM b)")
def t12_subtract(t):
    return R.subtract(*_parties(t))


@query(_PARTIES + "FROM a EXCEPT ALL FROM b)")
def t12_subtract_all(t):
    return R.subtract(*_parties(t), all=True)


@query("""SELECT CAST(day AS VARCHAR) AS day, year(day) AS year, quarter(day) AS quarter,
  month(day) AS month, day(day) AS day_of_month, dayofweek(day) AS day_of_week,
  weekofyear(day) AS iso_week, dayofweek(day) IN (0, 6) AS weekend
FROM (SELECT CAST(unnest(range(min(o_orderdate), max(o_orderdate) + INTERVAL 1 DAY, INTERVAL 1 DAY))
      AS DATE) AS day FROM orders)""")
def t13_date_dim(t):
    """The calendar that the order dates span."""
    days = t.orders.agg(F.min("o_orderdate").alias("first_day"),
                        F.max("o_orderdate").alias("last_day"))
    parts = ["year", "quarter", "month", "day_of_month", "day_of_week", "iso_week"]
    return R.date_dim(days).select(F.col("day").cast("string").alias("day"),
                                   *[F.col(p).cast("bigint").alias(p) for p in parts], "weekend")


@query("""SELECT c_custkey, md5(concat(length(c_name), ':', c_name, '|',
  length(CAST(c_nationkey AS VARCHAR)), ':', c_nationkey)) AS sk FROM customer""")
def t14_surrogate_key(t):
    return R.surrogate_key(t.customer, ["c_name", "c_nationkey"]).select("c_custkey", "sk")


@query("""SELECT event_id, CAST(CAST(ln(1 + value) AS DECIMAL(18,6)) AS DOUBLE) AS log_value
FROM events""")
def t15_apply_udf(t):
    def log_value(values: pd.Series) -> pd.Series:
        import numpy as np
        return np.log1p(values)
    return (R.apply_udf(t.events.select("event_id", "value"), "log_value", log_value, "double",
                        "value").select("event_id", number("log_value", 6)))


@query("""SELECT user_id, count(*) AS events, max(value) - min(value) AS spread
FROM events GROUP BY user_id""")
def t15_apply_partial_groups(t):
    def extent(batch: pd.DataFrame) -> pd.DataFrame:
        return (batch.groupby("user_id", as_index=False)
                .agg(n=("value", "size"), low=("value", "min"), high=("value", "max")))
    return R.apply_partial_groups(
        t.events.select("user_id", "value"), ["user_id"], extent,
        "user_id bigint, n bigint, low double, high double",
        {"events": F.sum("n"), "spread": F.max("high") - F.min("low")})


@query("""SELECT user_id, arg_max(event_type, ts) AS last_type, count(DISTINCT event_type) AS kinds
FROM events GROUP BY user_id""")
def t15_apply_group(t):
    def newest(pdf: pd.DataFrame) -> pd.DataFrame:
        last = pdf.loc[pdf["ts"].idxmax()]
        return pd.DataFrame({"user_id": [last["user_id"]], "last_type": [last["event_type"]],
                             "kinds": [pdf["event_type"].nunique()]})
    return R.apply_group(t.events.select("user_id", "ts", "event_type"), ["user_id"], newest,
                         "user_id bigint, last_type string, kinds bigint")


@query("""SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part""")
def t15_apply_udtf(t):
    def words(batch: pd.DataFrame) -> pd.DataFrame:
        return batch["p_name"].str.split(" ").explode().to_frame("word")
    return R.apply_udtf(t.part, words, "word string", "p_name", keep=["p_partkey"])
