"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.functions.columns import money
from tablewarden.operators import quality as Q
from tablewarden.plans.registry import query
from tablewarden.plans.values import number

DIRTY = ["dirty_customer"]

# Rules on dirty_customer; the conditions read the same in both engines.
RULES = {
    "balance_is_number": "TRY_CAST(acctbal_raw AS DECIMAL(12,2)) IS NOT NULL",
    "balance_not_negative": "coalesce(TRY_CAST(acctbal_raw AS DECIMAL(12,2)), 0) >= 0",
    "nation_in_range": "nation_raw BETWEEN 0 AND 24",
    "segment_known": "segment_raw IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')",
    "segment_set": "segment_raw IS NOT NULL AND segment_raw NOT IN ('', 'N/A')",
    "name_trimmed": "name_raw = trim(name_raw)",
}


def _reasons_sql(rules) -> str:
    parts = [f"CASE WHEN NOT coalesce({cond}, FALSE) THEN '{name}' END"
             for name, cond in rules.items()]
    return "concat_ws(', ', " + ",\n  ".join(parts) + ")"


_TAGGED = f"(SELECT *, {_reasons_sql(RULES)} AS failed_rules FROM dirty_customer)"


@query(f"SELECT src_id, rep, failed_rules FROM {_TAGGED} WHERE failed_rules <> ''", DIRTY)
def v1_check_rows(t):
    return Q.check_rows(t.dirty_customer, RULES).select(
        "src_id", "rep", F.array_join("failed_rules", ", ").alias("failed_rules"))


@query("""SELECT l_orderkey, count(*) AS rows, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE)
       AS price FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE NOT coalesce(l_shipdate >= o_orderdate, FALSE) GROUP BY l_orderkey""")
def v1_check_rows_across_tables(t):
    """Lines shipped before their order, counted per order."""
    lines = t.lineitem.select("l_orderkey", "l_shipdate", "l_extendedprice").join(
        t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    broken = Q.check_rows(lines, {"ships_after_order": "l_shipdate >= o_orderdate"})
    return broken.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(money("l_extendedprice")).cast("double").alias("price"))


@query("""SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
GROUP BY ALL HAVING count(*) > 1""")
def v2_check_unique(t):
    return Q.check_unique(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""SELECT src_id, rep, nation_raw FROM dirty_customer
WHERE nation_raw NOT IN (SELECT n_nationkey FROM nation)""", DIRTY)
def v3_check_fk(t):
    return (Q.check_fk(t.dirty_customer, t.nation, {"nation_raw": "n_nationkey"})
            .select("src_id", "rep", "nation_raw"))


@query("""SELECT l_orderkey, l_partkey FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""")
def v3_check_fk_clean(t):
    """All lines have an order: the rule reports nothing."""
    return (Q.check_fk(t.lineitem, t.orders, {"l_orderkey": "o_orderkey"})
            .select("l_orderkey", "l_partkey"))


@query("""SELECT p_name, count(DISTINCT p_brand) AS value_count FROM part
GROUP BY p_name HAVING count(DISTINCT p_brand) > 1""")
def v4_check_fd(t):
    return Q.check_fd(t.part, ["p_name"], "p_brand")


@query(f"""SELECT failed_rules = '' AS accepted, count(*) AS rows,
  count(DISTINCT src_id) AS customers FROM {_TAGGED} GROUP BY 1""", DIRTY)
def v5_split(t):
    ok, bad = Q.split(t.dirty_customer, RULES)
    parts = [part.select("src_id", F.lit(flag).alias("accepted"))
             for part, flag in ((ok, True), (bad, False))]
    return parts[0].union(parts[1]).groupBy("accepted").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("src_id").alias("customers"))


@query("\nUNION ALL ".join(
    f"""SELECT '{name}' AS rule, count(*) AS checked,
  count(*) FILTER (WHERE NOT coalesce({cond}, FALSE)) AS failed,
  CAST(CAST(count(*) FILTER (WHERE NOT coalesce({cond}, FALSE)) / count(*) AS DECIMAL(18,6)) AS DOUBLE)
  AS rate FROM dirty_customer""" for name, cond in RULES.items()), DIRTY)
def v6_quality_report(t):
    return Q.quality_report(t.dirty_customer, RULES).select(
        "rule", "checked", "failed", number("rate", 6))


@query("""WITH s AS (SELECT o_orderkey AS k, count(*) AS n,
  sum(CAST(o_totalprice AS DECIMAL(12,2))) AS p FROM orders GROUP BY 1),
t AS (SELECT l_orderkey AS k, count(*) AS n, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS p
  FROM lineitem GROUP BY 1)
SELECT coalesce(s.k, t.k) AS order_key, s.n AS source_rows, t.n AS target_rows,
  CAST(s.p AS DOUBLE) AS source_price, CAST(t.p AS DOUBLE) AS target_price
FROM s FULL OUTER JOIN t ON s.k = t.k
WHERE s.n IS DISTINCT FROM t.n OR coalesce(abs(s.p - t.p) > 1, (s.p IS NULL) <> (t.p IS NULL))""")
def v7_reconcile(t):
    orders = t.orders.select(F.col("o_orderkey").alias("order_key"),
                             money("o_totalprice").alias("price"))
    lines = t.lineitem.select(F.col("l_orderkey").alias("order_key"),
                              money("l_extendedprice").alias("price"))
    return Q.reconcile(orders, lines, ["order_key"], ["price"], tolerance=1).select(
        "order_key", "source_rows", "target_rows",
        F.col("source_price").cast("double").alias("source_price"),
        F.col("target_price").cast("double").alias("target_price"))
