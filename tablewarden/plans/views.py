"""Derived tables that the topics need and the given tables do not have.

The same text runs in Spark and in the checking SQL. Every row of the base table is
used; the defects and the versions follow from its values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

_DIRTY = """
       SELECT c_custkey AS src_id,
              CASE WHEN c_custkey % 11 = 0 THEN concat('  ', lower(c_name), ' ')
                   ELSE c_name END AS name_raw,
              CASE WHEN c_custkey % 13 = 0 THEN 'N/A' WHEN c_custkey % 17 = 0 THEN ''
                   WHEN c_custkey % 19 = 0 THEN NULL ELSE c_mktsegment END AS segment_raw,
              CASE WHEN c_custkey % 23 = 0 THEN 'abc'
                   ELSE CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS {string}) END AS acctbal_raw,
              CASE WHEN c_custkey % 29 = 0 THEN 99 ELSE c_nationkey END AS nation_raw,
              CASE WHEN c_custkey % 31 = 0 THEN '31/02/2024'
                   WHEN c_custkey % 2 = 0 THEN '2024-01-15' ELSE '15/01/2024' END AS signup_raw,
              {rep} AS rep
       FROM {customer}"""

# name -> (base table, text); {base} is the table, {string} the engine's text type
VIEWS: dict[str, tuple[str, str]] = {
    # padded names, null tokens, bad numbers, bad keys, mixed dates; customers in debt twice
    "dirty_customer": ("customer",
                       _DIRTY.replace("{rep}", "0").replace("{customer}", "{base}")
                       + "\n       UNION ALL"
                       + _DIRTY.replace("{rep}", "1").replace("{customer}", "{base}")
                       + "\n       WHERE c_acctbal < 0"),
    # the order book at the end of 1999, of June 2000, and at the end of the data: new orders
    # come in, young orders are open, orders past the retention period are gone
    "orders_v0": ("orders", """
       SELECT o_orderkey, o_custkey,
              CASE WHEN o_orderdate >= DATE '1999-10-01' THEN 'O' ELSE o_orderstatus END
              AS o_orderstatus,
              CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, o_orderdate, o_orderpriority
       FROM {base} WHERE o_orderdate < DATE '2000-01-01'"""),
    "orders_v1": ("orders", """
       SELECT o_orderkey, o_custkey,
              CASE WHEN o_orderdate >= DATE '2000-04-01' THEN 'O' ELSE o_orderstatus END
              AS o_orderstatus,
              CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, o_orderdate, o_orderpriority
       FROM {base}
       WHERE o_orderdate >= DATE '1995-04-01' AND o_orderdate < DATE '2000-07-01'"""),
    # ... and urgent orders carry a surcharge
    "orders_v2": ("orders", """
       SELECT o_orderkey, o_custkey,
              CASE WHEN o_orderdate >= DATE '2001-05-01' THEN 'O' ELSE o_orderstatus END
              AS o_orderstatus,
              CAST(CASE WHEN o_orderpriority = '1-URGENT'
                        THEN CAST(o_totalprice AS DECIMAL(12,2)) + 1
                        ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS DECIMAL(12,2))
              AS o_totalprice, o_orderdate, o_orderpriority
       FROM {base} WHERE o_orderdate >= DATE '1996-04-01'"""),
    # events read as a workload log
    "query_log": ("events", """
       SELECT event_id AS query_id, ts AS started_at, user_id AS session_id,
              event_type AS query_class, value AS duration_ms,
              CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS object_id,
              event_type = 'error' AS failed
       FROM {base}"""),
    # every event read as one backup run of the database user_id
    "backup_catalog": ("events", """
       SELECT event_id AS backup_id, user_id AS database_id,
              CASE WHEN event_id % 28 < 4 THEN 'FULL' WHEN event_id % 4 = 0 THEN 'DIFF'
                   ELSE 'INCR' END AS kind,
              ts AS finished_at, value AS size_mb,
              CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'OK' END AS status
       FROM {base}"""),
    # arrival order differs from event time: every 20th event arrives 3,000 places late
    "late_events": ("events", """
       SELECT event_id, ts, user_id, event_type, value, props,
              CASE WHEN event_id % 20 = 0 THEN event_id + 3000 ELSE event_id END AS arrival_seq
       FROM {base}"""),
}


def view(tables, name: str) -> DataFrame:
    base, text = VIEWS[name]
    text = text.replace("{string}", "STRING").replace("{base}", "{base_table}")
    return tables.spark.sql(text, base_table=getattr(tables, base))


def view_sql(name: str) -> str:
    base, text = VIEWS[name]
    return text.replace("{string}", "VARCHAR").replace("{base}", base)


def with_views(sql: str, names: Sequence[str]) -> str:
    """Put the named views in front of ``sql`` as common table expressions."""
    if not names:
        return sql
    parts = [f"{n} AS ({view_sql(n)})" for n in names]
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body
