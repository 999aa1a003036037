"""Load and history queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.operators import backup as B
from tablewarden.operators import loading as L
from tablewarden.plans.q_quality import RULES, _TAGGED
from tablewarden.plans.registry import query
from tablewarden.storage import new_path

KEYS = ["o_orderkey"]
VERSIONS = ["orders_v0", "orders_v1", "orders_v2"]
COLUMNS = ("o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice, "
           "o_orderdate, o_orderpriority")


def plain(df):
    """Amounts as double, as the checking SQL shows them."""
    return df.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


@query(f"""SELECT {COLUMNS} FROM orders_v0 UNION ALL
SELECT {COLUMNS} FROM orders_v1 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders_v0)""",
       VERSIONS)
def l1_load_new(t):
    return plain(L.load_new(t.orders_v0, t.orders_v1, KEYS))


_UPSERTED = f"""SELECT {COLUMNS} FROM orders_v1 UNION ALL
SELECT {COLUMNS} FROM orders_v0 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders_v1)"""


@query(_UPSERTED, VERSIONS)
def l2_upsert(t):
    return plain(L.upsert(t.orders_v0, t.orders_v1, KEYS))


@query(f"SELECT {COLUMNS} FROM orders_v2", VERSIONS)
def l3_apply_changes(t):
    """Two change sets on the first copy give the third."""
    feed = B.change_set(t.orders_v0, t.orders_v1, KEYS, "a", 1, "INCR").unionByName(
        B.change_set(t.orders_v1, t.orders_v2, KEYS, "b", 2, "INCR"))
    return plain(L.apply_changes(t.orders_v0, feed.drop("set_id", "kind"), KEYS, "seq"))


_HISTORY = """WITH s AS (
  SELECT *, 0 AS n, TIMESTAMP '2000-01-01' AS seen FROM orders_v0
  UNION ALL SELECT *, 1, TIMESTAMP '2000-07-01' FROM orders_v1
  UNION ALL SELECT *, 2, TIMESTAMP '2001-08-02' FROM orders_v2),
p AS (SELECT *, lag(n) OVER w AS pn, lag((o_custkey, o_orderstatus, o_totalprice, o_orderdate,
        o_orderpriority)) OVER w AS pr,
        (o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority) AS r
  FROM s WINDOW w AS (PARTITION BY o_orderkey ORDER BY n)),
i AS (SELECT *, sum(CASE WHEN pn = n - 1 AND pr = r THEN 0 ELSE 1 END)
        OVER (PARTITION BY o_orderkey ORDER BY n) AS g FROM p),
v AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
        min(seen) AS valid_from, max(n) AS last_n FROM i
  GROUP BY o_orderkey, g, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice,
  o_orderdate, o_orderpriority, valid_from,
  CASE last_n WHEN 0 THEN TIMESTAMP '2000-07-01' WHEN 1 THEN TIMESTAMP '2001-08-02' END AS valid_to
FROM v"""


@query(_HISTORY, VERSIONS)
def l4_history(t):
    return plain(L.history_of([(t.orders_v0, "2000-01-01"), (t.orders_v1, "2000-07-01"),
                               (t.orders_v2, "2001-08-02")], KEYS))


@query("""SELECT o_orderkey, o_custkey, o_orderdate FROM orders
WHERE o_orderdate > TIMESTAMP '2000-12-31'""")
def l5_load_since(t):
    return L.load_since(t.orders, "o_orderdate", "2000-12-31").select(
        "o_orderkey", "o_custkey", "o_orderdate")


@query(f"""SELECT 'run-1' AS run_id, count(*) AS read,
  count(*) FILTER (WHERE failed_rules = '') AS accepted,
  count(*) FILTER (WHERE failed_rules <> '') AS rejected, count(*) AS written, TRUE AS complete
FROM {_TAGGED}""", ["dirty_customer"])
def l6_audit(t):
    return L.audit(t.dirty_customer, RULES, "run-1", new_path(t.spark, "audit"))
