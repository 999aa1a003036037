import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewarden.llm import quality, toxicity
from tablewarden.llm.segments import Lexicon, maximal_segments
from tablewarden.llm.statistics import NAMES, Discriminant, statistics_of
from tablewarden.llm.training import held_out, logistic, sigmoid, training_rows

MIDDLE = "/root/testdata/sf0.1"


def test_segments_against_the_definition():
    """Maximal segments: best segment, then the best ones left and right of it, and so on."""
    def best(scores, low, high):
        top = None
        for i in range(low, high):
            total = 0.0
            for j in range(i, high):
                total += scores[j]
                if total > 1e-12 and (top is None or total > top[2] + 1e-9):
                    top = (i, j + 1, total)
        return top

    def plain(scores, low, high):
        top = best(scores, low, high)
        return [] if top is None else [*plain(scores, low, top[0]), top, *plain(scores, top[1], high)]
    rng = random.Random(6)
    for _ in range(300):
        n = rng.randrange(0, 40)
        hits = [(i, rng.uniform(0.5, 6)) for i in range(n) if rng.random() < 0.25]
        scores = [-0.37] * n
        for i, s in hits:
            scores[i] = s
        got = maximal_segments(hits, 0.37)
        assert [g[:2] for g in got] == [w[:2] for w in plain(scores, 0, n)]
        assert [g[2] for g in got] == pytest.approx([w[2] for w in plain(scores, 0, n)])


def test_the_scan_is_linear():
    hits = [(i * 10, 1.0) for i in range(200_000)]
    assert len(maximal_segments(hits, 0.2)) == 200_000
    assert len(maximal_segments([(i, 1.0) for i in range(200_000)], 0.2)) == 1


def test_decay_solves_its_equation():
    terms = [(0.001, 3.0), (0.0002, 5.5)]
    v = toxicity._decay(terms, 0.2)
    assert sum(p * math.exp(v * s) for p, s in terms) + 0.9988 * math.exp(-0.2 * v) == pytest.approx(1, abs=1e-6)


def test_logistic_finds_the_curve():
    points = [(x / 10, 1000 * (1 - sigmoid(-2 + 1.5 * x / 10)), 1000 * sigmoid(-2 + 1.5 * x / 10)) for x in range(40)]
    assert logistic(points) == pytest.approx((-2, 1.5), abs=0.02)
    a, b = logistic([(0.0, 100, 0), (5.0, 0, 100)])
    assert sigmoid(a) < 0.05 and sigmoid(a + 5 * b) > 0.95


def test_discriminant_against_full_densities():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, len(NAMES)))
    x[200:] = x[200:] * 2 + 1
    labels = np.repeat([0, 1], 200)
    parts = [x[labels == k] for k in range(2)]
    model = Discriminant.of(np.array([200, 200]), np.array([p.sum(0) for p in parts]),
                            np.array([p.T @ p for p in parts]), 0.1, 0.01)
    want = np.zeros(400)
    pooled = sum((p - p.mean(0)).T @ (p - p.mean(0)) for p in parts) / 398
    for k, p in enumerate(parts):
        cov = 0.9 * np.cov(p.T) + 0.1 * pooled
        cov = 0.99 * cov + 0.01 * (np.trace(cov) / len(NAMES) + 1e-6) * np.eye(len(NAMES))
        d = x - p.mean(0)
        value = -0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) - 0.5 * np.linalg.slogdet(cov)[1]
        want += value if k else -value
    assert np.allclose(model.log_ratio(x), want)


def test_statistics_of_odd_texts_are_finite():
    for text in ("", " ", "\n", "a", "a a a a", "éß" * 10, "1 2 3", "x" * 10_000, "\x00"):
        assert np.isfinite(statistics_of(text)).all() and len(statistics_of(text)) == len(NAMES)


def accuracy(df, labels, label):
    rows = df.join(labels, "doc_id").where("held_out").select("predicted", label).collect()
    assert len(rows) > 500
    hits = sum(r[0] == r[1] for r in rows) / len(rows)
    found = [r[0] for r in rows if r[1] == 1]
    false = [r[0] for r in rows if r[1] == 0]
    return hits, sum(found) / len(found), sum(false) / len(false)


def test_held_out_accuracy(spark):
    import __spark_entry__ as entry_points
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    scored = entry_points.queries()["op4_quality"](spark, MIDDLE)
    hits, found, false = accuracy(scored, labels, "quality")
    assert hits > 0.97 and found > 0.97 and false < 0.1
    scored = entry_points.queries()["op9_toxicity"](spark, MIDDLE)
    hits, found, false = accuracy(scored, labels, "toxic")
    assert hits > 0.96 and found > 0.75 and false < 0.02


def test_held_out_fold_and_training_rows(spark):
    ids = [1, 2, 12345, 10 ** 12, None]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id bigint").select("doc_id", held_out("doc_id").alias("h"))
    assert {r[0]: r[1] for r in df.collect()} == {
        i: i is not None and zlib.crc32(str(i).encode()) % 5 == 0 for i in ids}
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("toxic")).unionAll(docs.select("doc_id", F.lit(0))) \
        .unionAll(spark.createDataFrame([(None, 1), (3, None)], "doc_id bigint, toxic int"))
    rows = training_rows(docs, labels, "toxic")
    kept = {int(r["_text"]) for r in rows.collect()}
    assert kept == {i for i in range(2000) if zlib.crc32(str(i).encode()) % 5} and rows.where("_label = 0").count() == 0
    few = training_rows(docs, labels, "toxic", bound=200).count()
    assert 120 < few < 280


def test_passages_are_found_where_they_are(spark):
    lexicon = Lexicon({"idiot": 6.0, "clown": 6.0, "rauss*": 5.0}, 0.2, decay=1.0, rate=0.001, intercept=-3.0, slope=3.0)
    text = "Fine words here. " * 30 + "You IDIOT, you clown! " + "More fine words. " * 60 + "Raussoten idiot."
    docs = spark.createDataFrame([(1, text), (2, "Fine words here. " * 90), (3, "İ idiot clown idiot")], "doc_id bigint, text string")
    rows = {r["doc_id"]: r for r in toxicity.score(docs, lexicon).collect()}
    assert [text[p["start"]:p["stop"]] for p in rows[1]["passages"]] == ["IDIOT, you clown", "Raussoten idiot"]
    assert rows[1]["score"] > 0.5 > rows[2]["score"] and rows[2]["passages"] == []
    assert len(rows[3]["passages"]) == 1


def test_odd_documents_and_empty_tables(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (None, 1, None), (5, 1, 1)], "doc_id bigint, quality int, toxic int")
    for operator, label in ((quality, "quality"), (toxicity, "toxic")):
        for docs, known in ((odd, labels), (odd, labels.limit(0)), (empty, labels)):
            model = operator.fit(training_rows(docs, known, label))
            scored = operator.score(odd, model)
            rows = scored.collect()
            assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
            assert len(scored.columns) == len({c.lower() for c in scored.columns})
            by_text = {r["text"]: r["score"] for r in rows}
            assert by_text[None] == by_text[""]
            assert operator.score(empty, model).count() == 0
