"""Large groups are split: every result must equal the plain window's."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablewarden.functions.columns import money
from tablewarden.operators import catalog as K
from tablewarden.operators import cleaning as C
from tablewarden.operators import monitoring as M
from tablewarden.operators import ordered as O
from tablewarden.operators import reshape as R
from tablewarden.operators.lookup import broadcast_if_small, table_bytes
from tablewarden.operators.quantiles import exact_quantiles
from tests.conftest import rows

ALL = 10 ** 9


@pytest.fixture(scope="module")
def skewed(spark):
    """One user (and one NULL user) with a third of the rows each, the rest spread out."""
    df = spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.col("id") % 50).cast("int").alias("user"),
        F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, "
               "cast((id * 7919) % 3000 as int), 0)").alias("ts"),
        F.when(F.col("id") % 5 != 0, (F.col("id") * 37 % 101).cast("decimal(12,2)")).alias("v"),
        F.when(F.col("id") % 4 == 0, F.concat(F.lit("s"), F.col("id") % 11)).alias("s"))
    return df.persist()


def both(make):
    return rows(make(150)), rows(make(ALL))


RUNNING = {"total": ("sum", "v"), "n": ("count", "v"), "low": ("min", "v"), "high": ("max", "v"),
           "newest": ("last", "s"), "oldest": ("first", "s"), "whole": ("total", "v")}


@pytest.mark.parametrize("by", [["user"], []])
@pytest.mark.parametrize("order", [["ts", "id"], ["-ts", "id"]])
def test_running(skewed, by, order):
    split, plain = both(lambda m: O.running(skewed, by, order, RUNNING, m))
    assert split == plain and len(plain) == 3000


@pytest.mark.parametrize("by", [["user"], []])
def test_number_rows(skewed, by):
    split = O.number_rows(skewed, by, ["-ts", "id"], "n", 150)
    w = Window.partitionBy(*by).orderBy(F.col("ts").desc(), "id")
    assert rows(split) == rows(skewed.withColumn("n", F.row_number().over(w)))


@pytest.mark.parametrize("by", [["user"], []])
def test_windowed(skewed, by):
    columns = {"a": lambda w: F.sum("v").over(w.rowsBetween(-6, 2)),
               "b": lambda w: F.lag("s", 3).over(w), "c": lambda w: F.lead("id", 2).over(w)}
    split, plain = both(lambda m: O.windowed(skewed, by, ["ts", "id"], columns, 6, 2, m))
    assert split == plain and len(plain) == 3000


def test_windowed_frame_wider_than_block(skewed):
    columns = {"a": lambda w: F.sum("v").over(w.rowsBetween(-200, 20))}
    split, plain = both(lambda m: O.windowed(skewed, ["user"], ["ts", "id"], columns, 200, 20, m))
    assert split == plain


def test_last_known(skewed):
    split, plain = both(lambda m: C.fill_forward(skewed, "s", ["user"], ["ts", "id"], m))
    assert split == plain


@pytest.mark.parametrize("by", [["user"], []])
def test_exact_quantiles(skewed, by):
    wanted = {"q": 0.3, "m": 0.5, "top": 1.0}
    split, plain = both(lambda m: exact_quantiles(skewed, by, "v", wanted, m))
    direct = skewed.groupBy(*by).agg(*[F.percentile("v", p).alias(n) for n, p in wanted.items()])
    # The direct form answers NULL for groups that only hold NULLs; exact_quantiles has no row.
    direct = direct.where(F.col("m").isNotNull())
    near = lambda found: [tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in found]
    assert near(split) == near(plain) == near(rows(direct))


@pytest.mark.parametrize("kind", ["row_number", "ntile"])
def test_rank_total_order(skewed, kind):
    split, plain = both(lambda m: R.rank_in(skewed, ["user"], ["ts", "id"], kind, max_rows=m))
    w = Window.partitionBy("user").orderBy("ts", "id")
    direct = {"row_number": F.row_number(), "ntile": F.ntile(4)}[kind].over(w)
    assert split == plain == rows(skewed.withColumn("rank", direct))


@pytest.mark.parametrize("kind", ["rank", "dense_rank", "percent_rank"])
def test_rank_with_ties(skewed, kind):
    split, plain = both(lambda m: R.rank_in(skewed, ["user"], ["-v"], kind, max_rows=m))
    w = Window.partitionBy("user").orderBy(F.col("v").desc_nulls_last())
    assert split == plain == rows(skewed.withColumn("rank", getattr(F, kind)().over(w)))


def test_join_asof(skewed):
    right = skewed.where("id % 10 = 0").select("user", "ts", F.col("id").alias("right_id"), "s")
    left = skewed.select("user", "id", "ts")
    split, plain = both(lambda m: R.join_asof(left, right, ["user"], "ts", "ts",
                                              ["right_id", "s"], m, ["right_id"]))
    assert split == plain and len(plain) == 3000
    by_id = {r["id"]: r for r in R.join_asof(left, right, ["user"], "ts", "ts",
                                             ["right_id", "s"], 150, ["right_id"]).collect()}
    data = {r["id"]: r for r in skewed.collect()}
    for i in range(0, 3000, 97):
        fits = [d for d in data.values() if d["id"] % 10 == 0 and d["user"] == data[i]["user"]
                and d["ts"] <= data[i]["ts"]]
        best = max(fits, key=lambda d: d["ts"])["id"] if fits else None
        assert by_id[i]["right_id"] == best


def test_join_asof_with_wide_right_rows(skewed, monkeypatch):
    """Rows carried between slices are broadcast only up to a size; beyond it the result is the same."""
    right = skewed.where("id % 10 = 0").select("user", "ts", F.col("id").alias("right_id"),
                                               F.repeat(F.lit("w"), 5000).alias("wide"))
    left = skewed.select("user", "id", "ts", F.create_map(F.lit("a"), "id").alias("m"))

    def joined(max_rows):
        return R.join_asof(left, right, ["user"], "ts", "ts", ["right_id", "wide"], max_rows, ["right_id"])
    measured = []

    def limited(df):
        measured.append(table_bytes(df))
        return broadcast_if_small(df, 10_000)
    plain = rows(joined(ALL), "id", "right_id", "wide")
    monkeypatch.setattr(O, "broadcast_if_small", limited)
    assert rows(joined(150), "id", "right_id", "wide") == plain
    assert len(measured) == 1 and measured[0] > 10_000


def test_join_valid_with_long_history(spark):
    history = spark.range(500).selectExpr(
        "id % 2 as k", "id as version", "timestamp_ntz '2024-01-01' + make_dt_interval(cast(id as int)) as valid_from",
        "case when id < 490 and id % 7 <> 0 then timestamp_ntz '2024-01-01' + make_dt_interval(cast(id as int) + 2) "
        "when id % 7 = 0 then timestamp_ntz '2024-01-01' + make_dt_interval(cast(id as int) + 1) end as valid_to")
    facts = spark.range(1200).selectExpr(
        "id", "id % 3 as k", "timestamp_ntz '2023-12-30' + make_dt_interval(cast(id % 600 as int), 12) as at")
    split, plain = both(lambda m: R.join_valid(facts, history, ["k"], "at", ["version"], max_rows=m))
    direct = facts.alias("f").join(history.alias("h"), F.expr(
        "f.k = h.k and f.at >= h.valid_from and (h.valid_to is null or f.at < h.valid_to)"), "left"
    ).select("f.id", "f.k", "f.at", "version")
    assert split == plain
    last_two = direct.groupBy("id", "k", "at").agg(F.max("version").alias("version"))
    assert plain == rows(last_two)


def test_moving_by_time(skewed):
    split, plain = both(lambda m: R.moving_by_time(skewed.where("v is not null"), ["user"], "ts",
                                                   3600.0, "v", m))
    assert split == plain
    spark = skewed.sparkSession
    direct = spark.sql("""select distinct user, ts, sum(v) over w as moving_sum, count(v) over w as moving_count
        from {d} where v is not null window w as (partition by user order by ts
        range between interval 1 hour preceding and current row)""", d=skewed)
    assert [tuple(map(str, r)) for r in plain] == [tuple(map(str, r)) for r in rows(direct)]


def log(skewed):
    return skewed.selectExpr("id as query_id", "ts as started_at", "user as session_id",
                             "s as query_class", "cast(coalesce(v, 3) * 60000 as double) as duration_ms",
                             "v is null as failed")


def test_sessions(skewed):
    split, plain = both(lambda m: M.sessions(log(skewed), 1200, max_rows=m))
    assert split == plain
    direct = (log(skewed).groupBy("session_id", F.session_window("started_at", "20 minutes"))
              .agg(F.count(F.lit(1)).alias("n")))
    known = [r for r in plain if r[3] is not None]
    assert sorted(r[2] for r in known) == sorted(
        r["n"] for r in direct.where("session_id is not null").collect())


def test_concurrency(skewed):
    split, plain = both(lambda m: M.concurrency(log(skewed), max_rows=m))
    assert split == plain
    assert rows(M.peak_concurrency(log(skewed), max_rows=150)) == rows(M.peak_concurrency(log(skewed)))
    moves = []
    for r in log(skewed).collect():
        end = r["started_at"].timestamp() + r["duration_ms"] / 1000
        moves += [(r["started_at"].timestamp(), 1), (end, -1)]
    peak = now = 0
    for _, change in sorted(moves):
        now += change
        peak = max(peak, now)
    assert M.peak_concurrency(log(skewed)).first()["peak"] == peak


def test_gaps_anomalies_alerts(skewed):
    entries = log(skewed).where("query_id % 3 <> 1")
    metric = M.throughput(entries, "10 minutes")
    for make in (lambda m: M.gaps(entries, 90, max_rows=m),
                 lambda m: M.anomalies(metric, "queries", 12, 1.0, max_rows=m),
                 lambda m: M.alerts(metric, {"many": "queries > 6"}, 2, max_rows=m),
                 lambda m: M.latency(entries, ["query_class"], max_rows=m),
                 lambda m: M.compare_periods(entries, "2024-01-02", ["query_class"], max_rows=m)):
        split, plain = both(make)
        assert split == plain and plain


def test_catalog_windows(skewed):
    runs = skewed.selectExpr("user as database_id", "id as backup_id",
                             "case when id % 9 = 0 then 'FULL' when id % 3 = 0 then 'DIFF' else 'INCR' end as kind",
                             "ts as finished_at", "cast(id as double) as size_mb",
                             "case when id % 8 = 0 then 'FAILED' else 'OK' end as status")
    for make in (lambda m: K.rpo_report(runs, 600, m), lambda m: K.backup_health(runs, 5, m)):
        split, plain = both(make)
        assert split == plain and plain


@pytest.mark.parametrize("how", ["median", "mean", "mode"])
def test_fill_group(skewed, how):
    split, plain = both(lambda m: C.fill_group(skewed, "v", ["user"], how, m))
    assert split == plain and len(plain) == 3000


def test_bucketize_count(skewed):
    split, plain = both(lambda m: C.bucketize(skewed, "v", 7, "count", ["id"], max_rows=m))
    w = Window.orderBy(F.col("v").asc_nulls_first(), "id")
    assert split == plain == rows(skewed.withColumn("bucket", F.ntile(7).over(w).cast("bigint")))


def test_outliers_and_caps(skewed):
    for make in (lambda m: C.outliers_iqr(skewed, "v", ["user"], 0.2, m),
                 lambda m: C.winsorize(skewed, "v", ["user"], 0.1, 0.9, m)):
        split, plain = both(make)
        assert split == plain and plain


def test_money_is_decimal(skewed):
    assert skewed.select(money(F.lit(1.005)).alias("m")).dtypes == [("m", "decimal(12,2)")]
