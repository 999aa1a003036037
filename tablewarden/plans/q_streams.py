"""Source, sink and stream queries. Streams run to the end of the files and stop."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.plans.q_monitoring import LOG, _metrics, _throughput_sql
from tablewarden.plans.registry import Tables, query
from tablewarden.plans.views import VIEWS
from tablewarden.sources.rows import parse_json, parse_rows
from tablewarden.sources.sinks import write_partitions
from tablewarden.sources.streams import (
    event_time, read_batches, sink_batches, stream_table)
from tablewarden.sources.tables import SCHEMAS
from tablewarden.storage import new_path
from tablewarden.streaming import live, state

EVENTS = SCHEMAS["events"]


_COLUMNS = {name: [part.split()[0] for part in schema.split(", ")] for name, schema in SCHEMAS.items()}


@query("\nUNION ALL ".join(
    f"SELECT '{name}' AS table_name, '{c}' AS column_name, count(*) AS rows, count({c}) AS present, "
    + (f"CAST(max(len({c})) AS VARCHAR)" if c == "embedding" else f"CAST(max({c}) AS VARCHAR)")
    + f" AS highest FROM {name}" for name, columns in _COLUMNS.items() for c in columns))
def s1_read_table(t):
    """Every column of every table is decoded: its values are counted and the highest one taken."""
    parts = []
    for name, columns in _COLUMNS.items():
        df = getattr(t, name)
        highest = {c: F.size(c) if c == "embedding" else F.col(c) for c in columns}
        one = df.agg(F.count(F.lit(1)).alias("rows"), *[
            F.struct(F.count(c).alias("present"), F.max(v).cast("string").alias("highest")).alias(c)
            for c, v in highest.items()])
        entries = F.array(*[F.struct(F.lit(c).alias("column_name"), f"{c}.present", f"{c}.highest")
                            for c in columns])
        parts.append(one.select(F.lit(name).alias("table_name"), "rows", F.inline(entries)))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query("""SELECT src_id, rep, CAST(TRY_CAST(acctbal_raw AS DECIMAL(12,2)) AS DOUBLE) AS balance,
  nation_raw AS nation,
  CASE WHEN TRY_CAST(acctbal_raw AS DECIMAL(12,2)) IS NULL
       THEN concat(src_id, ',', rep, ',', acctbal_raw, ',', nation_raw) END AS bad_line
FROM dirty_customer""", ["dirty_customer"])
def s2_parse_rows(t):
    lines = t.dirty_customer.select(
        F.concat_ws(",", "src_id", "rep", "acctbal_raw", "nation_raw").alias("line"))
    parsed = parse_rows(lines, "line", "src_id bigint, rep int, balance decimal(12,2), nation int")
    return parsed.withColumn("balance", F.col("balance").cast("double"))


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def s3_parse_json(t):
    return parse_json(t.events.select("event_id", "props"), "props", "k bigint").select(
        "event_id", "k")


def _event_stream(t: Tables):
    return stream_table(t.spark, t.folder, "events.parquet", EVENTS)


def _stored(t: Tables, sdf, schema: str, mode: str = "append"):
    """Run a stream into a batch sink and read the sink."""
    path = new_path(t.spark, "stream")
    sink_batches(sdf, f"{path}/table", f"{path}/checkpoint", mode)
    return read_batches(t.spark, f"{path}/table", schema).drop("batch_id")


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def s4_stream_table(t):
    return _stored(t, _event_stream(t), EVENTS)


@query("""SELECT o_orderkey, o_custkey, o_totalprice,
  CASE WHEN year(o_orderdate) = 1998 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
  CAST(year(o_orderdate) AS BIGINT) AS order_year FROM orders""")
def s5_write_partitions(t):
    """All years written, then one year replaced."""
    path = new_path(t.spark, "partitions")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus",
                             F.year("o_orderdate").cast("bigint").alias("order_year"))
    write_partitions(orders, path, ["order_year"])
    changed = orders.where("order_year = 1998").withColumn("o_orderstatus", F.lit("X"))
    write_partitions(changed, path, ["order_year"])
    return t.spark.read.schema(orders.schema).parquet(path)


@query("""SELECT event_type, count(*) AS rows, count(DISTINCT event_id) AS events,
  CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total FROM events GROUP BY 1""")
def s6_sink_batches(t):
    """The sink is run twice on the same files: the second run adds nothing."""
    path = new_path(t.spark, "stream")
    for _ in range(2):
        sink_batches(_event_stream(t), f"{path}/table", f"{path}/checkpoint")
    return read_batches(t.spark, f"{path}/table", EVENTS).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("events"),
        F.sum(F.col("value").cast("decimal(12,2)")).cast("double").alias("total"))


def _arrivals(t: Tables, rows, load, number: int):
    """The folder where rows arrive, again after each of ``number`` loads has been added to it.

    The rows are written once, by load; each load is then copied when its turn comes.
    """
    path = new_path(t.spark, "arrivals")
    rows.withColumn("_load", load).write.partitionBy("_load").parquet(f"{path}/staged")
    staged = t.spark.read.schema(rows.withColumn("_load", F.lit(0)).schema).parquet(f"{path}/staged")
    for i in range(number):
        staged.where(F.col("_load") == i).drop("_load").write.mode("append").parquet(f"{path}/arrived")
        yield f"{path}/arrived"


def _part(t: Tables, number: int, newest_first: bool = False):
    """Events cut into parts of about equal size, by event_id."""
    last = t.events.agg(F.max("event_id").alias("m")).scalar()
    place = last - F.col("event_id") if newest_first else F.col("event_id")
    return F.floor(place * number / (last + 1)).cast("int")


def _log(t: Tables, sdf):
    text = VIEWS["query_log"][1].replace("{base}", "{base_table}")
    return event_time(t.spark.sql(text, base_table=sdf), "started_at")


def _closing(t: Tables):
    """One event so much later than all others that every window before it closes."""
    last = t.events.agg(F.max("ts").alias("m")).scalar()
    return t.spark.range(1).select(
        F.lit(-1).cast("bigint").alias("event_id"), (last + F.expr("INTERVAL '30' DAY")).alias("ts"),
        F.lit(-1).cast("bigint").alias("user_id"), F.lit("end").alias("event_type"),
        F.lit(0.0).alias("value"), F.lit('{"k": 0}').alias("props"))


def _closed(t: Tables, make, schema: str):
    """What a stream over the query log gives out in two loads and a closing event."""
    path = new_path(t.spark, "stream")
    rows = t.events.unionByName(_closing(t))
    for folder in _arrivals(t, rows, F.when(F.col("event_id") < 0, 2).otherwise(_part(t, 2)), 3):
        sdf = make(_log(t, stream_table(t.spark, folder, "*.parquet", EVENTS)))
        sink_batches(sdf, f"{path}/table", f"{path}/checkpoint")
    return read_batches(t.spark, f"{path}/table", schema).drop("batch_id")


def _plain_time(df, *columns: str):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query(_throughput_sql("time_bucket(INTERVAL '1 hour', started_at)", "query_log", "query_class,"), LOG)
def x1_stream_throughput(t):
    stored = _closed(t, lambda log: _plain_time(
        live.stream_throughput(log, "1 hour", by=["query_class"]), "bucket_start"),
        "bucket_start timestamp_ntz, query_class string, queries bigint, "
        "failures bigint, error_rate double, busy_ms decimal(28,4)")
    return _metrics(stored, "query_class")


@query(_throughput_sql("time_bucket(INTERVAL '15 minutes', started_at) - i * INTERVAL '15 minutes'",
                       "query_log, range(4) r(i)"), LOG)
def x1_stream_throughput_sliding(t):
    stored = _closed(t, lambda log: _plain_time(
        live.stream_throughput(log, "1 hour", "15 minutes"), "bucket_start"),
        "bucket_start timestamp_ntz, queries bigint, failures bigint, error_rate double, "
        "busy_ms decimal(28,4)")
    return _metrics(stored)


@query("""WITH p AS (SELECT *, lag(started_at) OVER w AS b FROM query_log
  WINDOW w AS (PARTITION BY session_id ORDER BY started_at, query_id)),
n AS (SELECT *, sum(CASE WHEN b IS NULL OR started_at >= b + INTERVAL 4 HOUR THEN 1 ELSE 0 END)
  OVER (PARTITION BY session_id ORDER BY started_at, query_id) AS s FROM p)
SELECT session_id, min(started_at) AS first_at, max(started_at) AS last_at, count(*) AS queries
FROM n GROUP BY session_id, s""", LOG)
def x2_stream_sessions(t):
    return _closed(t, lambda log: _plain_time(
        live.stream_sessions(log, "4 hours"), "first_at", "last_at").select(
        "session_id", "first_at", "last_at", "queries"),
        "session_id bigint, first_at timestamp_ntz, last_at timestamp_ntz, queries bigint")


@query("SELECT event_id, user_id, event_type, value FROM events")
def x3_stream_dedupe(t):
    """Every event arrives twice, in one load and again in the next, and is stored once."""
    path = new_path(t.spark, "stream")
    twice = t.events.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))) \
        .withColumn("_at", _part(t, 2) + F.col("_copy"))
    columns = EVENTS + ", _copy int, _at int"
    for folder in _arrivals(t, twice, F.col("_at"), 3):
        arrivals = event_time(stream_table(t.spark, folder, "*.parquet", columns), "ts")
        once = live.stream_dedupe(arrivals, ["event_id"])
        sink_batches(once.select("event_id", "user_id", "event_type", "value"),
                     f"{path}/table", f"{path}/checkpoint")
    return read_batches(t.spark, f"{path}/table", "event_id bigint, user_id bigint, event_type string, "
                                                  "value double").drop("batch_id")


ARRIVALS = 6


@query(f"""WITH e AS (SELECT *, floor(arrival_seq * {ARRIVALS} / (max(arrival_seq) OVER () + 1)) AS c
  FROM late_events),
m AS (SELECT c, max(ts) AS top FROM e GROUP BY c),
k AS (SELECT c, max(top) OVER (ORDER BY c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark FROM m)
SELECT event_id, user_id, coalesce(ts < mark - INTERVAL 1 HOUR, FALSE) AS late
FROM e JOIN k USING (c)""", ["late_events"])
def x4_stream_late(t):
    """Events in arrival order, one load per batch: on time, or set aside as late."""
    path = new_path(t.spark, "late")
    last = t.late_events.agg(F.max("arrival_seq").alias("m")).scalar()
    load = F.floor(F.col("arrival_seq") * ARRIVALS / (last + 1)).cast("int")
    columns = EVENTS + ", arrival_seq bigint"
    for folder in _arrivals(t, t.late_events, load, ARRIVALS):
        arrivals = stream_table(t.spark, folder, "*.parquet", columns)
        state.stream_late(arrivals, path, f"{path}/checkpoint", 3600)
    return read_batches(t.spark, f"{path}/rows", columns + ", late boolean").select(
        "event_id", "user_id", "late")


@query("""SELECT event_id, user_id, c_name, c_mktsegment
FROM events LEFT JOIN customer ON user_id = c_custkey""")
def x5_stream_enrich(t):
    path = new_path(t.spark, "stream")
    names = t.customer.select(F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment")
    for folder in _arrivals(t, t.events, _part(t, 2), 2):
        arrivals = stream_table(t.spark, folder, "*.parquet", EVENTS).select("event_id", "user_id")
        sink_batches(live.stream_enrich(arrivals, names, ["user_id"]), f"{path}/table", f"{path}/checkpoint")
    return read_batches(t.spark, f"{path}/table", "user_id bigint, event_id bigint, c_name string, "
                                                  "c_mktsegment string").drop("batch_id")


@query("""SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""")
def x6_stream_upsert(t):
    """The newest event per user; the newest events arrive first, and bases are folded on the way."""
    path = new_path(t.spark, "upsert")
    for folder in _arrivals(t, t.events, _part(t, 4, newest_first=True), 4):
        rows = stream_table(t.spark, folder, "*.parquet", EVENTS).select(
            "user_id", "event_id", "event_type", "value")
        state.stream_upsert(rows, path, ["user_id"], ["event_id"], f"{path}/checkpoint", fold_every=2)
    return state.read_upserted(t.spark, path, ["user_id"], ["event_id"])
