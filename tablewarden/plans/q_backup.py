"""Backup and recovery queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.operators import backup as B
from tablewarden.operators import catalog as K
from tablewarden.operators import chunks as C
from tablewarden.plans.q_loading import COLUMNS, KEYS, VERSIONS, plain
from tablewarden.plans.registry import query
from tablewarden.plans.values import number
from tablewarden.sources.sinks import write_partitions
from tablewarden.storage import new_path

ATTRIBUTES = ["o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice"]


def _part(column: str) -> str:
    return (f"coalesce(concat(length(CAST({column} AS VARCHAR)), ':', CAST({column} AS VARCHAR)), "
            "'-')")


def _row_md5(columns) -> str:
    return "md5(concat_ws('|', " + ", ".join(_part(c) for c in columns) + "))"


def _hex(text: str, start: int, digits: int) -> str:
    return f"CAST(concat('0x', substr({text}, {start}, {digits})) AS BIGINT)"


_DIGEST = (f"count(*) AS rows, coalesce(bit_xor({_hex('d', 1, 12)}), 0) AS xor48, "
           f"CAST(coalesce(sum({_hex('d', 17, 8)}), 0) AS VARCHAR) AS sum32")
_ORDER_MD5 = _row_md5(sorted(["o_orderkey", *ATTRIBUTES]))


_ALL_ORDERS = ("SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, "
               "o_orderdate, o_orderpriority FROM orders")


def _orders(t):
    """All orders, with money as decimals."""
    return t.orders.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(12,2)"))


@query(f"""SELECT 'full-1' AS snapshot_id, {_DIGEST}
FROM (SELECT {_ORDER_MD5} AS d FROM ({_ALL_ORDERS}))""")
def b1_snapshot(t):
    return B.snapshot(_orders(t), new_path(t.spark, "snapshot"), "full-1")


def _diff_sql(a: str, b: str) -> str:
    row = "(x.o_custkey, x.o_orderdate, x.o_orderpriority, x.o_orderstatus, x.o_totalprice)"
    old, new = row.replace("x.", "a."), row.replace("x.", "b.")
    return f"""SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
  CASE WHEN a.o_orderkey IS NULL THEN 'I' WHEN b.o_orderkey IS NULL THEN 'D' ELSE 'U' END AS op,
  a.o_orderstatus AS old_status, b.o_orderstatus AS new_status,
  CAST(a.o_totalprice AS DOUBLE) AS old_price, CAST(b.o_totalprice AS DOUBLE) AS new_price
FROM {a} a FULL OUTER JOIN {b} b ON a.o_orderkey = b.o_orderkey
WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR {old} IS DISTINCT FROM {new}"""


def _flat(changes):
    return changes.select(
        "o_orderkey", "op", F.col("before.o_orderstatus").alias("old_status"),
        F.col("after.o_orderstatus").alias("new_status"),
        F.col("before.o_totalprice").cast("double").alias("old_price"),
        F.col("after.o_totalprice").cast("double").alias("new_price"))


@query(_diff_sql("orders_v0", "orders_v1"), VERSIONS)
def b2_diff(t):
    return _flat(B.diff(t.orders_v0, t.orders_v1, KEYS))


def _set_sql(a, b, set_id, seq, kind):
    return (f"SELECT o_orderkey, op, new_status AS o_orderstatus, new_price AS o_totalprice, "
            f"'{set_id}' AS set_id, {seq} AS seq, '{kind}' AS kind FROM ({_diff_sql(a, b)})")


def _stored_sets(t):
    """Change sets appended one by one to a table partitioned by set."""
    path = new_path(t.spark, "change_sets")
    for a, b, name, seq, kind in (
            (t.orders_v0, t.orders_v1, "incr-1", 1, "INCR"),
            (t.orders_v0, t.orders_v2, "diff-2", 2, "DIFF"),
            (t.orders_v2, t.orders_v1, "incr-3", 3, "INCR")):
        write_partitions(B.change_set(a, b, KEYS, name, seq, kind), path, ["kind", "seq"])
    return t.spark.read.parquet(path)


@query(" UNION ALL ".join([_set_sql("orders_v0", "orders_v1", "incr-1", 1, "INCR"),
                           _set_sql("orders_v0", "orders_v2", "diff-2", 2, "DIFF"),
                           _set_sql("orders_v2", "orders_v1", "incr-3", 3, "INCR")]), VERSIONS)
def b3_change_set(t):
    return _stored_sets(t).select("o_orderkey", "op", "o_orderstatus",
                                  F.col("o_totalprice").cast("double").alias("o_totalprice"),
                                  "set_id", "seq", "kind")


@query(f"SELECT {COLUMNS} FROM orders_v2", VERSIONS)
def b4_restore_differential(t):
    """The differential replaces the increment before it."""
    return plain(B.restore(t.orders_v0, _stored_sets(t), KEYS, 2))


@query(f"SELECT {COLUMNS} FROM orders_v1", VERSIONS)
def b4_restore(t):
    """The differential, then the increment after it, which leads back to an earlier state."""
    return plain(B.restore(t.orders_v0, _stored_sets(t), KEYS, 3))


@query(f"""SELECT b AS bucket, {_DIGEST} FROM (
  SELECT {_ORDER_MD5} AS d, {_hex(_row_md5(['o_orderkey']), 25, 8)} % 16 AS b FROM ({_ALL_ORDERS}))
GROUP BY b""")
def b5_digest(t):
    return B.digest(_orders(t), KEYS, 16)


@query(_diff_sql("orders_v1", "orders_v2"), VERSIONS)
def b6_verify(t):
    return _flat(B.verify(t.orders_v1, t.orders_v2, KEYS))


@query("SELECT o_orderkey, '' AS op FROM orders WHERE FALSE")
def b6_verify_equal(t):
    """A copy of the whole table, written and read back, has no differing bucket."""
    path = new_path(t.spark, "copy")
    _orders(t).write.parquet(path)
    return B.verify(_orders(t), t.spark.read.parquet(path), KEYS).select("o_orderkey", "op")


@query(f"""SELECT {COLUMNS} FROM orders_v0 WHERE o_orderstatus = 'F' UNION ALL
SELECT {COLUMNS} FROM orders_v2
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders_v0 WHERE o_orderstatus = 'F')""", VERSIONS)
def b7_recover_rows(t):
    """Filled orders as the first copy had them, every other later edit kept."""
    return plain(B.recover_rows(t.orders_v2, t.orders_v0, KEYS, "o_orderstatus = 'F'"))


CATALOG = ["backup_catalog"]
# Runs with whether a failed increment before them breaks their chain.
_MARKED = """r AS (SELECT *, status = 'OK' AND kind = 'INCR' AND failed IS NOT NULL
    AND (base IS NULL OR failed > base) AS broken
  FROM (SELECT *, max(CASE WHEN status = 'OK' AND kind <> 'INCR' THEN finished_at END) OVER w AS base,
      max(CASE WHEN status <> 'OK' AND kind = 'INCR' THEN finished_at END) OVER w AS failed
    FROM backup_catalog
    WINDOW w AS (PARTITION BY database_id ORDER BY finished_at, backup_id ROWS UNBOUNDED PRECEDING)))"""


@query(f"""WITH {_MARKED.replace("r AS", "m AS", 1)},
r AS (SELECT * FROM m WHERE status = 'OK' AND NOT broken AND finished_at <= TIMESTAMP '2024-01-20'),
f AS (SELECT database_id, max(finished_at) AS f FROM r WHERE kind = 'FULL' GROUP BY 1),
d AS (SELECT r.database_id, max(finished_at) AS d FROM r JOIN f USING (database_id)
  WHERE kind = 'DIFF' AND finished_at > f GROUP BY 1)
SELECT database_id, backup_id, kind, finished_at,
  CASE WHEN finished_at = f THEN 1 WHEN finished_at = d THEN 2 ELSE 3 END AS step
FROM r JOIN f USING (database_id) LEFT JOIN d USING (database_id)
WHERE finished_at = f OR finished_at = d OR (kind = 'INCR' AND finished_at > coalesce(d, f))""",
       CATALOG)
def b8_restore_chain(t):
    return K.restore_chain(t.backup_catalog, "2024-01-20").select(
        "database_id", "backup_id", "kind", "finished_at", "step")


@query(f"""WITH {_MARKED}
SELECT database_id, backup_id, previous_at, finished_at,
  CAST(CAST(epoch_us(finished_at) - epoch_us(previous_at) AS DOUBLE) / 1e6 AS DOUBLE) AS gap_seconds
FROM (SELECT *, lag(finished_at) OVER (PARTITION BY database_id ORDER BY finished_at, backup_id)
        AS previous_at FROM r WHERE status = 'OK' AND NOT broken)
WHERE (epoch_us(finished_at) - epoch_us(previous_at)) / 1e6 > 86400""", CATALOG)
def b9_rpo_report(t):
    return K.rpo_report(t.backup_catalog, 86400)


def _tier_sql(tier: str, cutoff: str) -> str:
    return f"""SELECT database_id, arg_max(backup_id, finished_at) AS backup_id, '{tier}' AS tier
FROM ok JOIN n USING (database_id) GROUP BY database_id, date_trunc('{tier}', finished_at), newest
HAVING date_trunc('{tier}', finished_at) >= {cutoff}"""


@query(f"""WITH ok AS (SELECT * FROM backup_catalog WHERE status = 'OK'),
n AS (SELECT database_id, max(finished_at) AS newest FROM ok GROUP BY 1),
k AS ({_tier_sql('day', "date_trunc('day', newest) - INTERVAL 6 DAY")}
  UNION ALL {_tier_sql('week', "date_trunc('week', newest) - INTERVAL 21 DAY")}
  UNION ALL {_tier_sql('month', "date_trunc('month', newest) - INTERVAL 11 MONTH")})
SELECT database_id, backup_id, string_agg(tier, ',' ORDER BY tier) AS tiers FROM k GROUP BY 1, 2""",
       CATALOG)
def b10_retention(t):
    kept = K.retention(t.backup_catalog, {"day": 7, "week": 4, "month": 12})
    return kept.select("database_id", "backup_id", F.array_join("tiers", ",").alias("tiers"))


@query(f"""WITH {_MARKED}, h AS (SELECT *,
  avg(size_mb) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS t
  FROM r WINDOW w AS (PARTITION BY database_id ORDER BY finished_at, backup_id))
SELECT database_id, count(*) AS runs, count(*) FILTER (WHERE status = 'OK') AS ok_runs,
  CAST(CAST(count(*) FILTER (WHERE status = 'OK') / count(*) AS DECIMAL(18,6)) AS DOUBLE) AS success_rate,
  count(*) FILTER (WHERE broken) AS broken_increments,
  arg_max(size_mb, finished_at) AS newest_size,
  CAST(CAST(arg_max(t, finished_at) AS DECIMAL(18,4)) AS DOUBLE) AS trend_size
FROM h GROUP BY 1""", CATALOG)
def b11_backup_health(t):
    return K.backup_health(t.backup_catalog).select(
        "database_id", "runs", "ok_runs", number("success_rate", 6), "broken_increments",
        "newest_size", number("trend_size", 4))


ROWS_PER_CHUNK = 8


def _chunk_sql(name: str) -> str:
    """Chunks of a version: rows up to the next key whose hash is a cut."""
    half = [_hex("d", start, 15) for start in (1, 16)]
    return f"""SELECT sha256(concat_ws(':', CAST(count(*) AS VARCHAR), CAST(sum({half[0]}) AS VARCHAR),
    CAST(sum({half[1]}) AS VARCHAR))) AS chunk_id, count(*) AS rows
FROM (SELECT d, last_value(CASE WHEN {_hex('k', 25, 8)} % {ROWS_PER_CHUNK} = 0 THEN k END IGNORE NULLS)
    OVER (ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS first_key
  FROM (SELECT o_orderkey, {_row_md5(['o_orderkey'])} AS k, {_ORDER_MD5} AS d FROM {name}))
GROUP BY first_key"""


@query(_chunk_sql("orders_v1"), VERSIONS)
def b12_chunks(t):
    """Where a version is cut and what its chunks are named."""
    return C.chunks(t.orders_v1, KEYS, ROWS_PER_CHUNK)


def _store(t) -> str:
    path = new_path(t.spark, "chunk_store")
    for name in VERSIONS:
        C.add_snapshot(getattr(t, name), path, KEYS, name, ROWS_PER_CHUNK)
    return path


_CHUNKS = ", ".join(f"{name[-2:]} AS ({_chunk_sql(name)})" for name in VERSIONS)


@query(f"""WITH {_CHUNKS}, u AS (SELECT *, 'orders_v0' AS snapshot FROM v0
  UNION ALL SELECT *, 'orders_v1' FROM v1 UNION ALL SELECT *, 'orders_v2' FROM v2),
f AS (SELECT *, min(snapshot) OVER (PARTITION BY chunk_id) AS stored_with FROM u)
SELECT snapshot, count(*) AS chunks, CAST(sum(rows) AS BIGINT) AS rows,
  count(*) FILTER (WHERE snapshot = stored_with) AS new_chunks,
  CAST(coalesce(sum(rows) FILTER (WHERE snapshot = stored_with), 0) AS BIGINT) AS stored_rows,
  CASE snapshot WHEN 'orders_v0' THEN 0
    WHEN 'orders_v1' THEN (SELECT count(*) FROM ({_diff_sql("orders_v0", "orders_v1")}))
    ELSE (SELECT count(*) FROM ({_diff_sql("orders_v1", "orders_v2")})) END AS changed_rows
FROM f GROUP BY snapshot""", VERSIONS)
def b12_chunk_store(t):
    """What each of three versions adds to the store, next to its rows and its change set."""
    path = _store(t)
    held = C.manifest(t.spark, path).join(C.index(t.spark, path).drop("rows"), "chunk_id")
    first = held.groupBy("part").agg(F.min("snapshot").alias("stored_with"))
    own = F.col("snapshot") == F.col("stored_with")
    sizes = held.join(first, "part").groupBy("snapshot").agg(
        F.count(F.lit(1)).alias("chunks"), F.sum("rows").alias("rows"),
        F.count_if(own).alias("new_chunks"),
        F.coalesce(F.sum(F.when(own, F.col("rows"))), F.lit(0)).alias("stored_rows"))
    counts = [B.change_set(getattr(t, a), getattr(t, b), KEYS, b, 1, "INCR").groupBy().agg(
        F.lit(b).alias("snapshot"), F.count(F.lit(1)).alias("changed_rows"))
        for a, b in zip(VERSIONS, VERSIONS[1:])]
    return (sizes.join(counts[0].union(counts[1]), "snapshot", "left")
            .withColumn("changed_rows", F.coalesce("changed_rows", F.lit(0))))


@query(f"""WITH {_CHUNKS} SELECT chunk_id, rows, count(*) AS snapshots
FROM (SELECT * FROM v1 UNION ALL SELECT * FROM v2) GROUP BY chunk_id, rows""", VERSIONS)
def b12_chunk_references(t):
    """Chunks left, and snapshots that hold each, after the first version was let go."""
    path = _store(t)
    C.expire(t.spark, path, ["orders_v0"])
    C.sweep(t.spark, path, 0.0)
    return C.references(t.spark, path).select("chunk_id", "rows", "snapshots")


@query(" UNION ALL ".join(f"SELECT '{v}' AS snapshot, {COLUMNS} FROM {v}" for v in VERSIONS[1:]), VERSIONS)
def b12_chunk_restore(t):
    """Two versions row for row, after the first one was let go and its chunks were removed."""
    path = _store(t)
    C.expire(t.spark, path, ["orders_v0"])
    C.sweep(t.spark, path, 0.0)
    first, second = [plain(C.read_snapshot(t.spark, path, name)).withColumn("snapshot", F.lit(name))
                     for name in VERSIONS[1:]]
    return first.unionByName(second)
