"""Empty tables, single rows, constant columns, all rows rejected, chains without a start."""

import pytest
from pyspark.sql import functions as F

from tablewarden.operators import backup as B
from tablewarden.operators import catalog as K
from tablewarden.operators import cleaning as C
from tablewarden.operators import monitoring as M
from tablewarden.operators import quality as Q
from tablewarden.operators import reshape as R
from tablewarden.operators.quantiles import exact_quantiles
from tablewarden.sources.rows import parse_json, parse_rows
from tests.conftest import rows


@pytest.fixture(scope="module")
def values(spark):
    def make(data):
        return spark.createDataFrame(data, "id int, g string, v double")
    return make


def test_empty_table(values, spark):
    df = values([])
    assert C.outliers_z(df, "v", ["g"]).count() == 0
    assert C.outliers_iqr(df, "v", ["g"]).count() == 0
    assert C.fill_group(df, "v", ["g"], "median").count() == 0
    assert C.bucketize(df, "v", 4).count() == 0
    assert C.bucketize(df, "v", 4, "count", ["id"]).count() == 0
    assert rows(Q.quality_report(df, {"r": "v > 0"})) == [(0, 0, None, "r")]
    assert B.digest(df).first()["rows"] == 0
    assert M.profile(df).where("rows = 0").count() == 3
    assert R.rank_in(df, ["g"], ["v"], "percent_rank").count() == 0


def test_one_row(values):
    df = values([(1, "a", 2.0)])
    assert C.outliers_z(df, "v", ["g"]).count() == 0
    assert exact_quantiles(df, ["g"], "v", {"q": 0.9}).first()["q"] == 2.0
    assert C.bucketize(df, "v", 4).first()["bucket"] == 1
    assert R.rank_in(df, ["g"], ["v"], "percent_rank").first()["rank"] == 0.0


def test_constant_and_null_columns(values):
    df = values([(i, "a", 5.0) for i in range(4)] + [(9, "b", None), (10, None, 1.0)])
    assert C.outliers_z(df, "v", ["g"], 0.1).count() == 0
    filled = {r["id"]: r["v"] for r in C.fill_group(df, "v", ["g"], "mean").collect()}
    assert filled == {0: 5.0, 1: 5.0, 2: 5.0, 3: 5.0, 9: None, 10: 1.0}
    assert {r["bucket"] for r in C.bucketize(df.where("g = 'a'"), "v", 3).collect()} == {1}


def test_all_rows_rejected(values):
    ok, bad = Q.split(values([(1, "a", None), (2, "b", -1.0)]), {"positive": "v > 0"})
    assert ok.count() == 0 and bad.count() == 2


def test_equal_order_keys_in_rank(values):
    df = values([(1, "a", 1.0), (2, "a", 1.0), (3, "a", 2.0)])
    assert rows(R.rank_in(df, ["g"], ["v"], "rank"), "id", "rank") == [(1, 1), (2, 1), (3, 3)]
    assert rows(R.rank_in(df, ["g"], ["v"], "dense_rank"), "id", "rank") == [(1, 1), (2, 1), (3, 2)]


def test_asof_keeps_nulls_of_the_matched_row(spark):
    left = spark.sql("select 1 k, timestamp_ntz '2024-01-03' t")
    right = spark.sql("select * from values (1, timestamp_ntz '2024-01-01', 7), "
                      "(1, timestamp_ntz '2024-01-02', null) as x(k, t, v)")
    assert R.join_asof(left, right, ["k"], "t", "t", ["v"]).first()["v"] is None


def test_functional_dependency_counts_null(spark):
    df = spark.sql("select * from values ('a', 'x'), ('a', null), ('b', 'y') as t(l, r)")
    assert rows(Q.check_fd(df, ["l"], "r")) == [("a", 2)]


def test_foreign_key_ignores_null(spark):
    child = spark.sql("select * from values (1, 1), (2, null), (3, 9) as t(id, p)")
    parent = spark.sql("select 1 as key")
    assert rows(Q.check_fk(child, parent, {"p": "key"}), "id") == [(3,)]


def test_reconcile_null_and_missing(spark):
    a = spark.sql("select * from values (1, 1), (2, 2), (3, null) as t(k, m)")
    b = spark.sql("select * from values (1, 1), (3, 3), (4, 4) as t(k, m)")
    assert [r[0] for r in rows(Q.reconcile(a, b, ["k"], ["m"]), "k")] == [2, 3, 4]


def test_text_functions(spark):
    df = spark.sql("select '  Ada   Lovelace ' as n, 'N/A' as s, 'mail a.b@c.org now' as t")
    assert C.normalize_text(df, ["n"], "upper").first()["n"] == "ADA LOVELACE"
    assert C.nullify(df, ["s"]).first()["s"] is None
    assert C.mask(df, "t", r"\S+@\S+", "<m>").first()["t"] == "mail <m> now"


def test_surrogate_key_tells_null_from_text(spark):
    df = spark.sql("select * from values ('a|b', 'c'), ('a', 'b|c'), (null, 'x'), ('-', 'x'), ('', 'x') as t(p, q)")
    assert R.surrogate_key(df, ["p", "q"]).select("sk").distinct().count() == 5


def test_parse_rows_and_json(spark):
    lines = spark.createDataFrame([("1,2.5",), ("x,1",), ("3",)], "line string")
    parsed = rows(parse_rows(lines, "line", "a int, b double"), "a", "b", "bad_line")
    assert parsed == sorted([(1, 2.5, None), (None, 1.0, "x,1"), (3, None, "3")], key=repr)
    texts = spark.createDataFrame([('{"k": 1}',), ("{broken",), (None,)], "j string")
    assert rows(parse_json(texts, "j", "k int"), "k", "bad_json") == sorted(
        [(1, None), (None, "{broken"), (None, None)], key=repr)


def catalog(spark, runs):
    text = ", ".join(f"(1, {i}, '{k}', timestamp_ntz '2024-01-{d:02d}', 1.0, '{s}')"
                     for i, k, d, s in runs)
    return spark.sql(f"select * from values {text} as t(database_id, backup_id, kind, finished_at, size_mb, status)")


def test_restore_chain(spark):
    runs = [(1, "INCR", 1, "OK"), (2, "FULL", 2, "FAILED"), (3, "FULL", 3, "OK"), (4, "DIFF", 4, "OK"),
            (5, "INCR", 5, "OK"), (6, "DIFF", 6, "OK"), (7, "INCR", 7, "FAILED"), (8, "INCR", 8, "OK")]
    chain = lambda day: [r[0] for r in rows(K.restore_chain(catalog(spark, runs), f"2024-01-{day:02d}"), "backup_id")]
    assert chain(2) == []
    assert chain(3) == [3]
    assert chain(5) == [3, 4, 5]
    assert chain(9) == [3, 6]


def test_a_failed_increment_breaks_the_chain(spark):
    """One meaning in the chain, the recovery gaps and the health report."""
    runs = [(1, "INCR", 1, "OK"), (2, "FULL", 2, "OK"), (3, "INCR", 3, "OK"), (4, "INCR", 4, "FAILED"),
            (5, "INCR", 5, "OK"), (6, "INCR", 6, "OK"), (7, "DIFF", 7, "FAILED"), (8, "INCR", 8, "OK"),
            (9, "DIFF", 9, "OK"), (10, "INCR", 10, "OK")]
    df = catalog(spark, runs)
    assert [r[0] for r in rows(K.mark_broken(df).where("broken"), "backup_id")] == [5, 6, 8]
    assert [r[0] for r in rows(K.restore_chain(df, "2024-01-08"), "backup_id")] == [2, 3]
    assert [r[0] for r in rows(K.restore_chain(df, "2024-01-10"), "backup_id")] == [10, 2, 9]
    assert rows(K.rpo_report(df, 2 * 86400), "backup_id", "gap_seconds") == [(9, 6 * 86400.0)]
    assert K.backup_health(df).first()["broken_increments"] == 3
    split = K.mark_broken(df, max_rows=2)
    assert rows(split.where("broken"), "backup_id") == [(5,), (6,), (8,)]


def test_pivot_and_profile_leave_nothing_out(spark, values):
    df = values([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 4.0), (4, None, 8.0)])
    wide = R.pivot(df.selectExpr("'x' as k", "g", "v"), ["k"], "g", ["a", "b"], F.sum("v")).first()
    assert (wide["a"], wide["b"], wide["other"]) == (1.0, 2.0, 12.0)
    nested = spark.sql("select * from values (array(1, 2), map('a', 1), named_struct('x', 1)), "
                       "(array(3), map('a', 1), null) as t(a, m, s)")
    for exact in (True, False, ["a"]):
        assert rows(M.profile(nested, exact), "column_name", "nulls", "distinct_values", "min_value", "max_value") == [
            ("a", 0, 2, "1", "2"), ("m", 0, 1, "1", "1"), ("s", 1, 1, "1", "1")]


def test_asof_of_many_left_rows_at_one_time(spark):
    left = spark.range(200).selectExpr("id", "1 as k", "10 as t")
    right = spark.createDataFrame([(1, 5, "a"), (1, 11, "b")], "k int, t int, v string")
    joined = R.join_asof(left, right, ["k"], "t", "t", ["v"], max_rows=5)
    assert joined.count() == 200 and joined.where("v = 'a'").count() == 200


def test_retention(spark):
    runs = [(d, "FULL", d, "OK") for d in range(1, 29)]
    kept = rows(K.retention(catalog(spark, runs), {"day": 2, "week": 2, "month": 3}), "backup_id", "tiers")
    assert kept == [(21, ["week"]), (27, ["day"]), (28, ["day", "month", "week"])]


def test_alerts_need_neighbouring_buckets(spark):
    metric = spark.range(10).selectExpr("timestamp_ntz '2024-01-01' + make_dt_interval(0, cast(id as int)) as bucket_start",
                                        "case when id in (1, 2, 3, 5, 7, 8) then 9 else 0 end as queries")
    found = M.alerts(metric, {"high": "queries > 5"}, 2)
    assert [r[0] for r in rows(found, "breaches")] == [2, 3]


def test_apply_group_takes_any_group(values):
    df = values([(i, "a", 1.0) for i in range(20)])
    assert R.apply_group(df, ["g"], lambda p: p, "id int, g string, v double").count() == 20


def test_calendar(spark):
    days = rows(R.calendar(spark, "2024-02-28", "2024-03-02"), "day", "weekend")
    assert [str(d[0]) for d in days] == ["2024-02-28", "2024-02-29", "2024-03-01", "2024-03-02"]
    assert [d[1] for d in days] == [False, False, False, True]


def test_approximate_forms(tables):
    exact = {r[0]: r[1] for r in R.distinct_count(tables.orders, ["o_orderstatus"], "o_custkey").collect()}
    sketch = {r[0]: r[1] for r in R.distinct_count(tables.orders, ["o_orderstatus"], "o_custkey", False).collect()}
    assert all(abs(sketch[k] - v) <= 0.1 * v for k, v in exact.items())
    profile = M.profile(tables.orders)
    assert profile.where("column_name = 'o_orderkey'").first()["rows"] == tables.orders.count()
    heavy = M.key_skew_approximate(tables.query_log, "object_id", 5)
    assert heavy.agg(F.max("rows")).first()[0] == M.key_skew(tables.query_log, "object_id", 1).first()["rows"]


def test_throughput_sliding_covers_each_query(tables):
    metrics = M.throughput(tables.query_log, "1 hour", "15 minutes")
    assert metrics.agg(F.sum("queries")).first()[0] == 4 * tables.query_log.count()
