"""Laws that hold whatever the data."""

import pytest
from pyspark.sql import functions as F

from tablewarden.operators import backup as B
from tablewarden.operators import cleaning as C
from tablewarden.operators import layout as Y
from tablewarden.operators import loading as L
from tablewarden.operators import lookup as J
from tablewarden.operators import quality as Q
from tablewarden.operators import reshape as R
from tablewarden.operators import similar as S
from tablewarden.storage import materialize, new_path
from tests.conftest import rows

KEYS = ["o_orderkey"]


@pytest.fixture(scope="module")
def states(tables):
    return [materialize(getattr(tables, f"orders_v{i}"), f"v{i}") for i in range(3)]


def test_diff_of_itself_is_empty(states):
    assert B.diff(states[0], states[0], KEYS).count() == 0
    assert B.differing_buckets(states[0], states[0], KEYS).count() == 0


def test_restore_of_changes(states):
    sets = B.change_set(states[0], states[1], KEYS, "a", 1, "INCR").unionByName(
        B.change_set(states[1], states[2], KEYS, "b", 2, "INCR"))
    for upto, state in enumerate(states):
        assert rows(B.restore(states[0], sets, KEYS, upto)) == rows(state)


def test_differential_supersedes_earlier_sets(states):
    wrong = B.change_set(states[0], states[2], KEYS, "x", 1, "INCR")
    sets = (wrong.unionByName(B.change_set(states[0], states[1], KEYS, "d", 2, "DIFF")))
    assert rows(B.restore(states[0], sets, KEYS, 2)) == rows(states[1])


def test_upsert_twice_is_once(states):
    once = L.upsert(states[0], states[1], KEYS)
    assert rows(L.upsert(once, states[1], KEYS)) == rows(once)


def test_load_new_keeps_target(states):
    loaded = L.load_new(states[0], states[1], KEYS)
    assert rows(L.load_new(loaded, states[1], KEYS)) == rows(loaded)
    assert loaded.join(states[0], states[0].columns, "left_semi").count() == states[0].count()


def test_history_gives_every_state_back(states):
    days = ["2000-01-01", "2000-07-01", "2001-08-02"]
    past = L.history_of(list(zip(states, days)), KEYS)
    for state, day in zip(states, days):
        assert rows(L.as_of(past, day)) == rows(state)
    assert rows(L.history(past, states[2], KEYS, "2002-01-01")) == rows(past)


def test_accepted_and_rejected_make_the_input(tables):
    rules = {"nation": "nation_raw < 25", "segment": "segment_raw <> ''"}
    ok, bad = Q.split(tables.dirty_customer, rules)
    assert rows(ok.unionByName(bad.drop("failed_rules"))) == rows(tables.dirty_customer)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_is_the_join(tables, how):
    lines = tables.lineitem.select("l_orderkey", "l_suppkey", "l_shipdate")
    suppliers = tables.supplier.where("s_suppkey > 2").selectExpr("s_suppkey as l_suppkey", "s_name")
    salted = J.salted_join(lines, suppliers, ["l_suppkey"], 5, how, hot_rows=600)
    assert rows(salted) == rows(lines.join(suppliers, "l_suppkey", how))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_with_a_hot_and_a_missing_key(spark, how):
    left = spark.range(3000).selectExpr("id", "case when id % 2 = 0 then 1 when id % 3 = 0 then null else id end as k")
    right = spark.createDataFrame([(1, "a"), (5, "b"), (None, "c")], "k bigint, name string")
    salted = J.salted_join(left, right, ["k"], 5, how)
    assert rows(salted) == rows(left.join(right, "k", how))


def test_history_in_one_pass_is_the_stepwise_one(spark):
    state = lambda *r: spark.createDataFrame(list(r), "k int, v string")
    states = [(state((1, "a"), (2, "b"), (4, None)), "2020-01-01"), (state((1, "a"), (2, "c"), (3, "d")), "2020-02-01"),
              (state((2, "c"), (4, None)), "2020-03-01"), (state((1, "a"), (2, "b"), (4, None)), "2020-04-01")]
    stepwise = L.open_history(*states[0])
    for df, at in states[1:]:
        stepwise = L.history(stepwise, df, ["k"], at)
    assert rows(L.history_of(states, ["k"])) == rows(stepwise)


def test_lookup_join_beyond_the_broadcast_size(tables):
    plain = rows(J.lookup_join(tables.orders, tables.customer.withColumnRenamed("c_custkey", "o_custkey"),
                               ["o_custkey"]))
    large = J.lookup_join(tables.orders, tables.customer.withColumnRenamed("c_custkey", "o_custkey"),
                          ["o_custkey"], measure=True, max_bytes=1)
    assert rows(large) == plain


def test_summary_answers_as_the_table(tables):
    by = ["l_returnflag", "l_linestatus"]
    lines = tables.lineitem.withColumn("q", F.col("l_quantity").cast("decimal(12,2)"))
    summary = Y.build_summary(lines, [*by, "l_shipdate"], {"q": "q"})
    direct = R.summarize(lines, by, {"rows": F.count(F.lit(1)), "q_sum": F.sum("q"),
                                     "q_count": F.count("q"), "q_min": F.min("q"), "q_max": F.max("q")})
    assert [tuple(map(str, r)) for r in rows(Y.requery(summary, by))] == [
        tuple(map(str, r)) for r in rows(direct)]


def test_digest_ignores_order_and_sees_copies(tables):
    orders = tables.orders
    first = rows(B.digest(orders))
    assert rows(B.digest(orders.repartition(7, "o_custkey"))) == first
    twice = orders.unionByName(orders.where("o_orderkey < 2")).unionByName(orders.where("o_orderkey < 2"))
    assert rows(B.digest(twice)) != first


@pytest.mark.parametrize("damage", [
    lambda df: df.where("o_orderkey <> 17"),
    lambda df: df.limit(0),
    lambda df: df.withColumn("o_orderpriority", F.when(F.col("o_orderkey") == 5, F.lit(None))
                             .otherwise(F.col("o_orderpriority")))])
def test_verify_finds_damage(states, damage):
    damaged = damage(states[0])
    found = B.verify(states[0], damaged, KEYS, 32)
    assert rows(found) == rows(B.diff(states[0], damaged, KEYS)) and found.count() > 0


def test_recover_rows(states):
    whole = states[0]
    broken = whole.where("o_custkey > 20").withColumn(
        "o_orderstatus", F.when(F.col("o_custkey") > 90, F.lit("Z")).otherwise(F.col("o_orderstatus")))
    back = B.recover_rows(broken, whole, KEYS, "o_custkey <= 20")
    assert rows(back.where("o_custkey <= 90")) == rows(whole.where("o_custkey <= 90"))
    assert back.where("o_custkey > 90 and o_orderstatus = 'Z'").count() == whole.where("o_custkey > 90").count()


def test_fuzzy_pairs_against_all_pairs(spark):
    words = ["", "a", "ab", "abc", "abd", "acb", "abcd", "bc", "zzz", "zz", "azz", None, "ab", "kitten", "sitten", "sittin"]
    df = spark.createDataFrame([(w,) for w in words], "w string")

    def distance(x, y):
        row = list(range(len(y) + 1))
        for i, a in enumerate(x, 1):
            row, last = [i], row
            for j, b in enumerate(y, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (a != b)))
        return row[-1]
    distinct = sorted({w for w in words if w is not None})
    for limit in (1, 2):
        want = [(x, y, distance(x, y)) for x in distinct for y in distinct
                if x < y and distance(x, y) <= limit]
        got = rows(S.fuzzy_pairs(df, "w", limit), "left_value", "right_value", "distance")
        assert got == sorted(want, key=repr)


def test_fuzzy_groups_hold_all_near_values(spark):
    words = ["ab", "abc", "abd", "acb", "abcd", "zzz", "zz", "azz", None, "ab"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    left = lambda w: {w} | {w[:i] + w[i + 1:] for i in range(len(w))}
    groups = {}
    for w in {w for w in words if w is not None}:
        for k in left(w):
            groups.setdefault(k, []).append(w)
    want = [(min(g), max(g), sum(words.count(w) for w in g), k, len(g)) for k, g in groups.items() if len(g) > 1]
    got = rows(S.fuzzy_groups(df, "w"), "lowest", "highest", "rows", "shared", "value_count")
    assert got == sorted(want, key=repr)


def test_dedupe_keep_one_row_per_key(tables):
    kept = C.dedupe_keep(tables.dirty_customer, ["src_id"], ["rep"])
    assert kept.count() == tables.customer.count() and kept.where("rep > 0").count() == 0


def test_write_and_compact_keep_rows(tables, spark):
    lines = tables.lineitem
    again = Y.compact(lines, new_path(spark, "compact"), ["l_shipdate"], ["l_orderkey"], 3)
    assert rows(B.digest(again)) == rows(B.digest(lines))
    report = Y.layout_report(again)
    assert report.agg(F.sum("rows")).first()[0] == lines.count()
