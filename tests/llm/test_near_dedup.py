import random
from collections import Counter

import numpy as np
import pyarrow as pa

from tablewarden.llm import near_dedup
from tablewarden.llm.components import components
from tablewarden.llm.near_dedup import deduplicate, near_duplicates
from tablewarden.llm.near_dedup import PICKS, RUN, SKETCHES
from tablewarden.llm.sketches import aligned_distance, allowed_edits, first_run_batches, order_sketches, words_of
from tests.llm.conftest import SMALL


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_alignment_equals_the_full_table():
    rng = random.Random(3)
    for _ in range(600):
        a = rng.choices("abc", k=rng.randrange(0, 14))
        b = list(a) if rng.random() < 0.6 else rng.choices("abc", k=rng.randrange(0, 14))
        for _ in range(rng.randrange(4)):
            if b:
                b[rng.randrange(len(b))] = rng.choice("abcd")
        limit = rng.randrange(6)
        want = levenshtein(a, b)
        assert aligned_distance(a, b, limit) == (want if want <= limit else None)


def classes_by_brute_force(docs):
    docs = [(i, t) for i, t in docs if t is not None]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    cut = [words_of(t.encode()) for _, t in docs]
    for i in range(len(docs)):
        for j in range(i):
            limit = allowed_edits(max(len(cut[i]), len(cut[j])), 0.8)
            alike = docs[i][1] == docs[j][1] or (cut[i] and cut[j] and aligned_distance(cut[i], cut[j], limit) is not None)
            if alike:
                parent[find(i)] = find(j)
    groups = {}
    for k, (i, _) in enumerate(docs):
        groups.setdefault(find(k), []).append(i)
    return sorted(sorted(g) for g in groups.values())


def grouped(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["class_id"], []).append(r["doc_id"])
    assert all(min(g) == c for c, g in groups.items())
    return sorted(sorted(g) for g in groups.values())


def test_documents_against_all_pairs(spark, texts):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert grouped(near_duplicates(docs).collect()) == classes_by_brute_force(sorted(texts.items()))


def test_planted_copies_chains_and_common_passages(spark):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = rng.choices(vocabulary, k=60)
    docs = []
    for g in range(12):
        base = rng.choices(vocabulary, k=rng.randrange(60, 300))
        docs.append(base)
        for _ in range(4):
            copy = list(base)
            for _ in range(len(copy) // 25):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            docs.append(copy)
    docs += [passage + rng.choices(vocabulary, k=45) for _ in range(60)]
    rows = [(i, " ".join(d)) for i, d in enumerate(docs)] + [(500, " ".join(docs[0]).upper()), (501, " ".join(docs[7]))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert grouped(near_duplicates(df).collect()) == classes_by_brute_force(rows)
    # Where many texts are too many, those that share a passage are told apart by rare runs.
    assert grouped(near_duplicates(df, bucket=6).collect()) == classes_by_brute_force(rows)
    kept = deduplicate(df)
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == [g[0] for g in classes_by_brute_force(rows)]


def test_a_large_group_of_near_copies_is_one_class(spark):
    base = [f"b{i}" for i in range(80)]
    rows = [(i, " ".join(base[:i % 80] + [f"x{i}"] + base[i % 80:])) for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    assert grouped(near_duplicates(df).collect()) == [list(range(800))]
    assert [r["doc_id"] for r in deduplicate(df).collect()] == [0]


def test_texts_of_common_passages_wholly(spark):
    """Most of each text is passages that many others have; some of them are near and no end shows it."""
    rng = random.Random(21)
    passages = [[f"p{i}w{j}" for j in range(30)] for i in range(4)]
    rows = []
    for i in range(90):
        order = rng.sample(range(4), 3)
        rows.append((i, " ".join(w for p in order for w in passages[p]) + f" own{i % 60} end{i % 60}"))
    # A few are passages with words of their own that they share in pairs.
    for i in range(30):
        rows.append((100 + i, " ".join(passages[0] + [f"q{i // 2}v{j}" for j in range(60)] + [f"only{i}"])))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    want = classes_by_brute_force(rows)
    assert 15 < len(want) < 60
    assert grouped(near_duplicates(df).collect()) == want
    assert grouped(near_duplicates(df, bucket=5).collect()) == want
    # Beyond a size the common runs are joined.
    assert grouped(near_duplicates(df, bucket=5, common_bytes=0).collect()) == want


def test_a_task_alone_gives_out_only_runs_that_two_texts_have():
    rng = random.Random(9)
    shared = [f"s{i}" for i in range(40)]
    texts = [" ".join(shared + rng.choices([f"t{i}u{j}" for j in range(500)], k=8)) for i in range(30)]
    texts += [" ".join(f"v{i}w{j}" for j in range(50)) for i in range(30)]
    batches = [pa.RecordBatch.from_arrays([pa.array([b"%d" % i for i in range(at, at + 20)], pa.binary()), pa.array(texts[at:at + 20])],
                                          ["_key", "_text"]) for at in range(0, 60, 20)]
    every, alone = ([tuple(r.values()) for b in first_run_batches(iter(batches), RUN, np.zeros(0, np.int64), 0.8, alone)
                     for r in b.to_pylist()] for alone in (False, True))
    held = Counter(r[2] for r in every)
    assert alone == [r for r in every if held[r[2]] > 1] and 0 < len(alone) < len(every) / 2
    assert list(first_run_batches(iter([]), RUN, np.zeros(0, np.int64), 0.8, True)) == []


def rows_of_joins(df):
    """Rows that the joins of a plan make when it runs."""
    df.collect()

    def count(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return count(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return count(node.plan())
        rows = node.metrics().apply("numOutputRows").value() if "Join" in kind else 0
        return rows + sum(count(node.children().apply(i)) for i in range(node.children().size()))
    return count(df._jdf.queryExecution().executedPlan())


def test_few_texts_beside_many_near_copies_cost_no_square(spark, monkeypatch):
    """Texts of the passages of a large class, in other orders: not near, with its common runs first."""
    passages = [[f"p{i}w{j}" for j in range(25)] for i in range(4)]
    base = [w for p in passages for w in p]
    rows = [(i, " ".join(base[:i % 100] + [f"x{i}"] + base[i % 100:])) for i in range(300)]
    rows += [(1000 + i, " ".join(w for p in order for w in passages[p])) for i, order in enumerate([[3, 2, 1, 0], [1, 0, 3, 2]])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    made, compare = [], near_dedup._Links.compare

    def counted(links, pairs):
        made.append(rows_of_joins(pairs))
        compare(links, pairs)
    monkeypatch.setattr(near_dedup._Links, "compare", counted)
    want = [list(range(300)), [1000], [1001]]
    assert grouped(near_duplicates(df, bucket=5).collect()) == want
    # Two of 302 texts are of other components, in the runs that come first: 24 of each text.
    assert sum(made[1:]) < 24 * 2 * 302
    # In rounds, too, pairs are joined only when they are of two components.
    monkeypatch.setattr(near_dedup, "PAIRS", 0)
    monkeypatch.setattr(near_dedup, "PAIRS_EACH", 0)
    made.clear()
    assert grouped(near_duplicates(df, bucket=5).collect()) == want
    assert len(made) > 3 and sum(made[1:]) < 24 * 2 * 302


def classes_by_shared_sketches(rows):
    """All pairs that share a sketch value are aligned; the texts are distinct and have words."""
    cut = [words_of(t.encode()) for _, t in rows]
    ends = np.cumsum([0] + [len(t.encode()) for _, t in rows])
    data = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8)
    values = [set(v) for v in order_sketches(data, ends, RUN, PICKS, SKETCHES)[2].tolist()]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            limit = allowed_edits(max(len(cut[i]), len(cut[j])), 0.8)
            if find(i) != find(j) and values[i] & values[j] and aligned_distance(cut[i], cut[j], limit) is not None:
                parent[find(i)] = find(j)
    groups = {}
    for k, (i, _) in enumerate(rows):
        groups.setdefault(find(k), []).append(i)
    return sorted(sorted(g) for g in groups.values())


def test_a_star_of_variants_that_are_not_near_each_other(spark):
    rng = random.Random(5)
    base = [f"b{i}" for i in range(200)]
    rows = [(0, " ".join(base))]
    for i in range(1, 301):
        variant = list(base)
        for at in rng.sample(range(200), 30):
            variant[at] = f"x{i}y{at}"
        rows.append((i, " ".join(variant)))
    # Of quite another length, so that an end of a bucket may have no partner.
    rows += [(400 + i, " ".join(base[:60 + 4 * i] + [f"z{i}y{at}" for at in range(500)])) for i in range(30)]
    want = classes_by_shared_sketches(rows)
    assert max(map(len, want)) > 240
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    assert grouped(near_duplicates(df).collect()) == want


def test_odd_documents_and_empty_tables(spark, odd, empty):
    rows = near_duplicates(odd).collect()
    assert sorted(((r["doc_id"], r["class_id"]) for r in rows), key=repr) == sorted(
        [(1, 1), (1, 1), (2, 1), (3, 3), (4, 3), (5, 5), (6, 6), (None, 1), (None, None), (7, 7), (8, 8), (9, 9),
         (10, 10)], key=repr)
    kept = deduplicate(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([1, 3, 5, 6, None, 7, 8, 9, 10], key=repr)
    assert near_duplicates(empty).count() == 0 and deduplicate(empty).count() == 0
    nameless = spark.createDataFrame([(None, "a b c d e f g")] * 3, "doc_id bigint, text string")
    assert deduplicate(nameless).count() == 1


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 180)] + [(300, 300), (171, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 180)}, 200: 100}
    assert components(spark.createDataFrame([], "a int, b int")).count() == 0
