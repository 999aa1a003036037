"""Cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.functions.columns import money, null_if_token, tidy_text
from tablewarden.operators import cleaning as C
from tablewarden.operators.similar import fuzzy_groups, fuzzy_pairs, near_repeats
from tablewarden.plans.registry import query
from tablewarden.plans.values import number

DIRTY = ["dirty_customer"]
DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy")
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


@query("""SELECT src_id, rep, lower(trim(regexp_replace(name_raw, '\\s+', ' ', 'g'))) AS name_raw,
       lower(trim(regexp_replace(segment_raw, '\\s+', ' ', 'g'))) AS segment_raw
FROM dirty_customer""", DIRTY)
def c1_normalize_text(t):
    return (C.normalize_text(t.dirty_customer, ["name_raw", "segment_raw"], "lower")
            .select("src_id", "rep", "name_raw", "segment_raw"))


@query("""SELECT src_id, rep, CASE WHEN segment_raw NOT IN ('', 'N/A') THEN segment_raw END
       AS segment_raw FROM dirty_customer""", DIRTY)
def c2_nullify(t):
    return C.nullify(t.dirty_customer, ["segment_raw"]).select("src_id", "rep", "segment_raw")


@query("""SELECT src_id, rep, CAST(TRY_CAST(acctbal_raw AS DECIMAL(12,2)) AS DOUBLE) AS acctbal_raw,
       TRY_CAST(segment_raw AS BIGINT) AS segment_raw,
       concat_ws(', ',
         CASE WHEN acctbal_raw IS NOT NULL AND TRY_CAST(acctbal_raw AS DECIMAL(12,2)) IS NULL
              THEN 'acctbal_raw: not decimal(12,2)' END,
         CASE WHEN segment_raw IS NOT NULL AND TRY_CAST(segment_raw AS BIGINT) IS NULL
              THEN 'segment_raw: not bigint' END) AS reject_reasons
FROM dirty_customer""", DIRTY)
def c3_cast_or_reject(t):
    schema = T.StructType([T.StructField("acctbal_raw", T.DecimalType(12, 2)),
                           T.StructField("segment_raw", T.LongType())])
    return C.cast_or_reject(t.dirty_customer, schema).select(
        "src_id", "rep", F.col("acctbal_raw").cast("double").alias("acctbal_raw"), "segment_raw",
        F.array_join("reject_reasons", ", ").alias("reject_reasons"))


@query("""SELECT src_id, rep, CAST(CAST(try_strptime(signup_raw, ['%Y-%m-%d', '%d/%m/%Y']) AS DATE)
       AS VARCHAR) AS signup FROM dirty_customer""", DIRTY)
def c4_parse_date(t):
    return C.parse_date(t.dirty_customer, "signup_raw", DATE_FORMATS).select(
        "src_id", "rep", F.col("signup_raw").cast("string").alias("signup"))


@query("""SELECT src_id, rep, coalesce(n_name, 'UNKNOWN') AS n_name
FROM dirty_customer LEFT JOIN nation ON nation_raw = n_nationkey""", DIRTY)
def c5_map_codes(t):
    codes = t.nation.withColumnRenamed("n_nationkey", "nation_raw")
    return (C.map_codes(t.dirty_customer, codes, "nation_raw", "n_name", "UNKNOWN")
            .select("src_id", "rep", "n_name"))


@query("""SELECT src_id, rep, coalesce(segment_raw, 'NONE') AS segment_raw FROM dirty_customer""",
       DIRTY)
def c6_fill_const(t):
    return (C.fill_const(t.dirty_customer, {"segment_raw": "NONE"})
            .select("src_id", "rep", "segment_raw"))


_TYPED_SQL = """WITH typed AS (
  SELECT src_id, rep, CASE WHEN segment_raw NOT IN ('', 'N/A') THEN segment_raw END AS segment,
         TRY_CAST(acctbal_raw AS DECIMAL(12,2)) AS acctbal, nation_raw
  FROM dirty_customer)"""


def _typed(t):
    return t.dirty_customer.select(
        "src_id", "rep", null_if_token(F.col("segment_raw")).alias("segment"),
        F.col("acctbal_raw").try_cast("decimal(12,2)").alias("acctbal"), "nation_raw")


def _wide(t):
    """With room for the digits of a mean: a filled decimal keeps its scale."""
    return _typed(t).withColumn("acctbal", F.col("acctbal").cast("decimal(28,12)"))


@query(_TYPED_SQL + """, g AS (
  SELECT segment, avg(acctbal) AS fill FROM typed WHERE acctbal IS NOT NULL GROUP BY segment)
SELECT src_id, rep, CAST(CAST(coalesce(CAST(acctbal AS DOUBLE), fill) AS DECIMAL(18,4)) AS DOUBLE)
       AS acctbal
FROM typed LEFT JOIN g ON typed.segment IS NOT DISTINCT FROM g.segment""", DIRTY)
def c7_fill_group_mean(t):
    return (C.fill_group(_wide(t), "acctbal", ["segment"], "mean")
            .select("src_id", "rep", number("acctbal", 4)))


@query(_TYPED_SQL + """, g AS (
  SELECT segment, quantile_cont(CAST(acctbal AS DOUBLE), 0.5) AS fill FROM typed GROUP BY segment)
SELECT src_id, rep, CAST(CAST(coalesce(CAST(acctbal AS DOUBLE), fill) AS DECIMAL(18,4)) AS DOUBLE)
       AS acctbal
FROM typed LEFT JOIN g ON typed.segment IS NOT DISTINCT FROM g.segment""", DIRTY)
def c7_fill_group_median(t):
    return (C.fill_group(_wide(t), "acctbal", ["segment"], "median")
            .select("src_id", "rep", number("acctbal", 4)))


@query(_TYPED_SQL + """, n AS (
  SELECT nation_raw, segment, count(*) AS n FROM typed WHERE segment IS NOT NULL GROUP BY ALL),
g AS (SELECT nation_raw, segment AS fill FROM n
      QUALIFY row_number() OVER (PARTITION BY nation_raw ORDER BY n DESC, segment) = 1)
SELECT src_id, rep, coalesce(segment, fill) AS segment
FROM typed LEFT JOIN g ON typed.nation_raw IS NOT DISTINCT FROM g.nation_raw""", DIRTY)
def c7_fill_group_mode(t):
    return (C.fill_group(_typed(t), "segment", ["nation_raw"], "mode")
            .select("src_id", "rep", "segment"))


@query("""SELECT event_id, user_id,
       last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS)
         OVER (PARTITION BY user_id ORDER BY ts, event_id) AS last_purchase
FROM events""")
def c8_fill_forward(t):
    purchases = t.events.select("event_id", "user_id", "ts", F.when(
        F.col("event_type") == "purchase", F.col("value")).alias("last_purchase"))
    return (C.fill_forward(purchases, "last_purchase", ["user_id"], ["ts", "event_id"])
            .select("event_id", "user_id", "last_purchase"))


@query("""SELECT DISTINCT src_id, name_raw, segment_raw, acctbal_raw, nation_raw, signup_raw
FROM dirty_customer""", DIRTY)
def c9_dedupe_exact(t):
    return C.dedupe_exact(t.dirty_customer.drop("rep"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
       l_shipdate FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
           l_returnflag, l_linestatus) = 1""")
def c10_dedupe_keep(t):
    order = ["-l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    return C.dedupe_keep(t.lineitem, ["l_orderkey", "l_linenumber"], order).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_shipdate")


@query("""WITH v AS (
  SELECT lower(trim(regexp_replace(name_raw, '\\s+', ' ', 'g'))) AS v, count(*) AS n
  FROM dirty_customer GROUP BY 1)
SELECT a.v AS left_value, b.v AS right_value, a.n AS left_rows, b.n AS right_rows,
       CAST(levenshtein(a.v, b.v) AS BIGINT) AS distance
FROM v a JOIN v b ON a.v < b.v AND levenshtein(a.v, b.v) <= 1""", DIRTY)
def c11_fuzzy_pairs(t):
    names = C.normalize_text(t.dirty_customer, ["name_raw"], "lower")
    return (fuzzy_pairs(names, "name_raw", 1)
            .select("left_value", "right_value", "left_rows", "right_rows",
                    F.col("distance").cast("bigint").alias("distance")))


@query("""WITH v AS (SELECT lower(regexp_replace(trim(name_raw), '\\s+', ' ', 'g')) AS name, count(*) AS rows
  FROM dirty_customer WHERE name_raw IS NOT NULL GROUP BY 1),
k AS (SELECT DISTINCT name, rows, unnest(list_concat([name], list_transform(range(1, length(name) + 1),
  lambda i: substr(name, 1, i - 1) || substr(name, i + 1)))) AS shared FROM v)
SELECT shared, count(*) AS value_count, min(name) AS lowest, max(name) AS highest, sum(rows)::BIGINT AS rows
FROM k GROUP BY shared HAVING count(*) > 1""", ["dirty_customer"])
def c11_fuzzy_groups(t):
    names = C.normalize_text(t.dirty_customer, ["name_raw"], "lower")
    return fuzzy_groups(names, "name_raw", 1)


_FIELDS = ["p_name", "p_brand", "p_type", "p_size"]


def _near_sql(field: str) -> str:
    kept = [f for f in _FIELDS if f != field]
    shown = ", ".join(f if f in kept else f"NULL AS {f}" for f in _FIELDS)
    return f"""SELECT {shown}, '{field}' AS differing_field, count(DISTINCT {field}) AS value_count,
  min(CAST({field} AS VARCHAR)) AS lowest, max(CAST({field} AS VARCHAR)) AS highest, count(*) AS rows
FROM part GROUP BY {", ".join(kept)} HAVING count(DISTINCT {field}) > 1"""


@query("\nUNION ALL ".join(_near_sql(f) for f in _FIELDS))
def c12_near_repeats(t):
    return near_repeats(t.part, _FIELDS)


@query("""WITH g AS (SELECT event_type, avg(value) AS m, stddev_samp(value) AS s
  FROM events GROUP BY event_type)
SELECT event_id, event_type, value,
       CAST(CAST((value - m) / nullif(s, 0) AS DECIMAL(18,6)) AS DOUBLE) AS z
FROM events JOIN g USING (event_type) WHERE abs((value - m) / nullif(s, 0)) > 3""")
def c13_outliers_z(t):
    return (C.outliers_z(t.events, "value", ["event_type"], 3.0)
            .select("event_id", "event_type", "value", number("z", 6)))


@query("""WITH g AS (SELECT event_type, quantile_cont(value, 0.25) AS q1,
  quantile_cont(value, 0.75) AS q3 FROM events GROUP BY event_type)
SELECT event_id, event_type, value, CAST(CAST(q1 AS DECIMAL(18,6)) AS DOUBLE) AS q1,
       CAST(CAST(q3 AS DECIMAL(18,6)) AS DOUBLE) AS q3
FROM events JOIN g USING (event_type)
WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""")
def c14_outliers_iqr(t):
    return (C.outliers_iqr(t.events, "value", ["event_type"], 1.5)
            .select("event_id", "event_type", "value", number("q1", 6), number("q3", 6)))


@query("""WITH g AS (SELECT event_type, quantile_cont(value, 0.05) AS lo,
  quantile_cont(value, 0.95) AS hi FROM events GROUP BY event_type)
SELECT event_id, CAST(CAST(least(greatest(value, lo), hi) AS DECIMAL(18,6)) AS DOUBLE) AS value
FROM events JOIN g USING (event_type)""")
def c15_winsorize(t):
    return (C.winsorize(t.events, "value", ["event_type"], 0.05, 0.95)
            .select("event_id", number("value", 6)))


@query("""WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events)
SELECT event_id, CAST(least(floor((value - lo) / (hi - lo) * 10) + 1, 10) AS BIGINT) AS bucket
FROM events, e""")
def c16_bucketize_width(t):
    return C.bucketize(t.events, "value", 10, "width").select("event_id", "bucket")


@query("""SELECT event_id, CAST(ntile(10) OVER (ORDER BY value, event_id) AS BIGINT) AS bucket
FROM events""")
def c16_bucketize_count(t):
    return (C.bucketize(t.events, "value", 10, "count", ["event_id"])
            .select("event_id", F.col("bucket").cast("bigint").alias("bucket")))


@query(f"""SELECT doc_id, md5(m) AS text_md5, CAST(length(m) AS BIGINT) AS chars FROM (
  SELECT doc_id, regexp_replace(text, '{EMAIL}', '<email>', 'g') AS m FROM documents)""")
def c17_mask(t):
    return C.mask(t.documents, "text", EMAIL, "<email>", contains="@").select(
        "doc_id", F.md5("text").alias("text_md5"),
        F.length("text").cast("bigint").alias("chars"))
