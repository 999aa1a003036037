import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tablewarden.operators.intervals import overlap_join
from tablewarden.operators.periods import periods, state_at
from tablewarden.plans.catalogue import QUERIES
from tests.conftest import SMALL, rows


def both(spark, left, right, kind="bigint"):
    return (spark.createDataFrame(left, f"i long, k string, a {kind}, b {kind}"),
            spark.createDataFrame(right, f"j long, m string, c {kind}, d {kind}"))


def brute(left, right, keyed):
    def after(x, y):
        return y is None or x < y
    return sorted((i, j) for i, k, a, b in left for j, m, c, d in right
                  if a is not None and c is not None and after(a, b) and after(c, d) and after(a, d) and after(c, b)
                  and (not keyed or (k is not None and k == m)))


def random_intervals(rng, n, longest, span):
    out = []
    for i in range(n):
        start = rng.choice([None, *[rng.randrange(-span, span)] * 20])
        end = None if start is None or rng.random() < 0.05 else start + rng.choice([-2, 0, 1, rng.randrange(1, longest)])
        out.append((i, rng.choice(["x", "x", "x", "y", None]), start, end))
    return out


@pytest.mark.parametrize("longest,span,width", [(5, 300, None), (400, 300, None), (90, 20, 1), (10**15, 10**12, None), (50, 300, 7)])
@pytest.mark.parametrize("keyed", [False, True])
def test_overlaps_against_all_pairs(spark, longest, span, width, keyed):
    rng = random.Random(longest + span)
    left, right = random_intervals(rng, 90, longest, span), random_intervals(rng, 70, 3, span)
    # Repeated rows and many equal starts.
    left += left[:5] + [(500 + i, "x", 3, 4) for i in range(30)]
    one, two = both(spark, left, right)
    on = (["k"], ["m"]) if keyed else ([], [])
    got = rows(overlap_join(one, two, ("a", "b"), ("c", "d"), *on, width=width), "i", "j")
    assert sorted(got) == brute(left, right, keyed)


def test_dates_timestamps_and_empty_tables(spark):
    days = [(i, "x", dt.date(2024, 1, 1 + i), dt.date(2024, 1, 2 + 2 * i)) for i in range(10)]
    one, two = both(spark, days, days, "date")
    assert sorted(rows(overlap_join(one, two, ("a", "b"), ("c", "d")), "i", "j")) == brute(days, days, False)
    moments = [(i, k, dt.datetime.combine(a, dt.time(i, 0, 0, i)), dt.datetime.combine(b, dt.time(0))) for i, k, a, b in days]
    for kind in ("timestamp_ntz", "timestamp"):
        one, two = both(spark, moments, moments, kind)
        assert sorted(rows(overlap_join(one, two, ("a", "b"), ("c", "d")), "i", "j")) == brute(moments, moments, False)
        assert overlap_join(one, two.limit(0), ("a", "b"), ("c", "d")).count() == 0
    with pytest.raises(ValueError, match="both tables"):
        overlap_join(one, one, ("a", "b"), ("a", "b"))


def test_rows_stay_near_input_plus_output(spark):
    """A long interval is a few bins, and a crowd gives rows for its pairs only."""
    left = [(0, "x", 0, 1_000_000)] + [(i, "x", 500_000, 500_001) for i in range(1, 200)]
    right = [(i, "x", 5_000 * i, 5_000 * i + 1) for i in range(200)]
    one, two = both(spark, left, right)
    joined = overlap_join(one, two, ("a", "b"), ("c", "d"))
    assert joined.count() == 200 + 199
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def shuffled_rows(df):
    """Rows that the exchanges of a plan pass on, after a run of it."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    nodes, total = [plan.finalPhysicalPlan()], 0
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "Exchange":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        nodes += [node.plan()] if "QueryStage" in node.nodeName() else [node.children().apply(i) for i in range(node.children().size())]
    return total


@pytest.mark.parametrize("keyed", [False, True])
def test_intervals_move_few_times_and_are_not_broadcast(spark, keyed):
    rng = random.Random(7)
    starts = [rng.randrange(1_000_000) for _ in range(2000)]
    left = [(i, f"k{i % 100}", a, a + 4_000) for i, a in enumerate(starts)]
    right = [(i, f"k{i % 100}", a, a + 3_000) for i, a in enumerate(starts)]
    one, two = both(spark, left, right)
    joined = overlap_join(one, two, ("a", "b"), ("c", "d"), *((["k"], ["m"]) if keyed else ([], [])))
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
    assert 4000 <= shuffled_rows(joined) <= (4000 if keyed else 20_000)


def test_crowded_keys_among_others(spark):
    rng = random.Random(8)
    left = [(i, "big" if i < 400 else f"k{i}", a, a + rng.choice([1, 30, 4_000])) for i, a in
            enumerate(rng.randrange(100_000) for _ in range(500))]
    right = [(i, k, a + 1, b + 7) for i, k, a, b in left]
    one, two = both(spark, left, right)
    got = rows(overlap_join(one, two, ("a", "b"), ("c", "d"), ["k"], ["m"]), "i", "j")
    assert sorted(got) == brute(left, right, True)


DAY = dt.date(2024, 1, 1)


def on(n):
    return None if n is None else DAY + dt.timedelta(days=n)


def day_by_day(facts, last=60):
    """What is believed on each day of each day, by replaying the statements."""
    believed = {}
    for known in range(0, 12):
        for day in range(last):
            for key in {f[0] for f in facts if f[0] is not None}:
                own = [f for f in facts if f[0] == key and f[2] is not None and f[4] is not None and f[4] <= known
                       and f[2] <= day and (f[3] is None or day < f[3])]
                if own:
                    newest = max(own, key=lambda f: (f[4], f[5], f[6], f[1]))
                    if not newest[6]:
                        believed[key, day, known] = newest[1]
    return believed


@pytest.mark.parametrize("seed,most", [(1, None), (2, 10), (3, 5_000_000)])
def test_periods_against_a_replay(spark, seed, most):
    rng = random.Random(seed)
    facts = []
    for n in range(60):
        start = rng.choice([None, *[rng.randrange(40)] * 15])
        facts.append((rng.choice(["a", "a", "a", "b", "c", None]), rng.choice(["v", "w", "x"]), start,
                      None if start is None or rng.random() < 0.15 else start + rng.randrange(-1, 15),
                      rng.choice([None, *range(10)]), rng.randrange(3), rng.random() < 0.15))
    facts += facts[:6]
    df = spark.createDataFrame([(k, v, on(a), on(b), on(c), n, g, 0) for k, v, a, b, c, n, g in facts],
                               "k string, v string, valid_from date, valid_to date, known_at date, n int, gone boolean, _from int")
    table = periods(df, ["k"], ["v"], tie=["n"], ended="gone", max_rows=most)
    got = {}
    found = [tuple(r) for r in table.select("k", "v", "valid_from", "valid_to", "known_from", "known_to").collect()]
    for k, v, a, b, c, d in found:
        for day in range(60):
            for known in range(12):
                if a <= on(day) and (b is None or on(day) < b) and c <= on(known) and (d is None or on(known) < d):
                    assert (k, day, known) not in got
                    got[k, day, known] = v
    assert got == day_by_day(facts)
    # No two rectangles could be one along the time of validity.
    assert not {(k, v, b, c, d) for k, v, a, b, c, d in found} & {(k, v, a, c, d) for k, v, a, b, c, d in found}
    state = state_at(table, *(F.lit(on(x)) for x in (20, 5)))
    assert sorted(tuple(r) for r in state.collect()) == sorted((k, v) for (k, x, y), v in got.items() if (x, y) == (20, 5))


def test_no_facts(spark):
    df = spark.createDataFrame([], "k string, v string, valid_from date, valid_to date, known_at date")
    assert periods(df, ["k"], ["v"]).collect() == []


def test_the_days_asked_share_one_pass(spark):
    plan = QUERIES["t17_state_at"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("Relation ") <= 1
