import random

from tablewarden.llm.chat import format_chats


def plain(rows):
    convs = {}
    for i, (conv, turn, role, text) in enumerate(rows):
        convs.setdefault((conv is None, i if conv is None else conv), []).append((turn is not None, turn or 0, "unknown" if role is None else role, text or ""))
    turns = {c: tuple(x[2:] for x in sorted(t)) for c, t in convs.items()}
    kept = []
    for c, t in turns.items():
        longer = any(len(o) > len(t) and o[:len(t)] == t for o in turns.values())
        first = min(d for d, o in turns.items() if o == t)
        if not longer and c == first:
            kept.append((None if c[0] else c[1], len(t), "".join(f"<|{r}|>\n{x}\n<|end|>\n" for r, x in t)))
    return sorted(kept, key=repr)


SCHEMA = "conv_id bigint, turn bigint, role string, text string, _conv int, chat string"


def check(spark, rows):
    df = spark.createDataFrame([(*r, 0, "z") for r in rows], SCHEMA).repartition(4)
    got = format_chats(df)
    assert got.columns == ["conv_id", "n_turns", "chat"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(rows)


def test_snapshots_copies_and_orders(spark):
    rng = random.Random(7)
    rows = []
    for conv in range(150):
        base = rng.randrange(12)
        for turn in range(rng.randrange(1, 7)):
            text = f"{base} {turn}" if turn < 4 else f"{base} {turn} {rng.randrange(3)}"
            rows.append((conv, turn, "user" if turn % 2 == 0 else "assistant", text))
    check(spark, rows)


def test_nulls_ties_and_repeated_rows(spark):
    check(spark, [(1, 0, "user", "a"), (1, 0, "user", "a"), (2, 0, "user", "a"), (3, None, None, None), (3, 1, "user", ""),
                  (None, 0, "user", "a"), (None, 1, "user", "b"), (4, 5, "user", "x"), (4, 5, "assistant", "x"),
                  (5, 1, "b", "a"), (6, 1, "ba", ""), (7, 0, "user", "long " * 50_000), (8, 0, "user", "é\U0001f600")])
    assert format_chats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_many_turns_without_an_id(spark):
    from pyspark.sql import functions as F

    from tablewarden.llm.chat import maximal
    rows = [(None, i % 3, "user", f"t{i % 700}") for i in range(2000)] + [(1, 0, "user", "t1"), (2, 0, "user", "t2"), (2, 1, "user", "t2")]
    check(spark, rows)
    df = spark.createDataFrame([(*r, 0, "z") for r in rows], SCHEMA)
    sizes = maximal(df).groupBy("_conv", "_own").agg(F.count("*").alias("n")).where("_conv IS NULL")
    assert sizes.agg(F.max("n"), F.count("*")).first()[:] == (1, 698)
