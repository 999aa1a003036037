"""Each stage against a plain version of what it decides, on its own input."""

import corpus_pipeline as pipeline
from tablewarden.llm import toxicity
from tablewarden.llm.training import training_rows
from tests.llm.conftest import SMALL
from tests.llm.test_decontamination import plain as contamination_of
from tests.llm.test_near_dedup import classes_by_brute_force
from tests.llm.test_secrets import KINDS, plain as secrets_of


def rows_of(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages_one_by_one(spark, con):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stages = dict(pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_duplicates", "benchmark_decontamination", "secret_scan", "byte_bpe"]
    kept = pipeline.materialize(stages["toxicity"](spark, docs, SMALL), "test_stage")
    assert kept.columns == docs.columns
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    scores = rows_of(toxicity.score(docs, toxicity.fit(training_rows(docs, labels, "toxic"))))
    assert set(rows_of(kept)) == {i for i, r in scores.items() if r["score"] < 0.5}

    single = pipeline.materialize(stages["near_duplicates"](spark, kept, SMALL), "test_stage")
    pairs = sorted((i, r["text"]) for i, r in rows_of(kept).items())
    assert single.columns == docs.columns and sorted(rows_of(single)) == [g[0] for g in classes_by_brute_force(pairs)]

    clean = pipeline.materialize(stages["benchmark_decontamination"](spark, single, SMALL), "test_stage")
    pairs = sorted((i, r["text"]) for i, r in rows_of(single).items())
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    assert clean.columns == docs.columns
    assert set(rows_of(clean)) == {d for d, _, hit, _ in contamination_of(pairs, items) if not hit}

    masked = pipeline.materialize(stages["secret_scan"](spark, clean, SMALL), "test_stage")
    before, after = rows_of(clean), rows_of(masked)
    assert masked.columns == docs.columns and set(before) == set(after)
    for ident, spans in secrets_of([(i, r["text"]) for i, r in before.items()]):
        text, out, at = before[ident]["text"], "", 0
        for start, kind, stop in spans:
            if start >= at:
                out += text[at:start] + f"[{KINDS[kind]}]"
            at = max(at, stop)
        assert after[ident]["text"] == out + text[at:] and after[ident]["n_chars"] == len(after[ident]["text"])

    tokens = stages["byte_bpe"](spark, masked, SMALL)
    assert set(rows_of(tokens)) == set(after) and tokens.where("NOT round_trip").count() == 0
    assert pipeline.run(spark, SMALL).count() == tokens.count()


def test_odd_documents(spark, odd):
    docs = odd
    for _, stage in pipeline.STAGES[:-1]:
        docs = pipeline.materialize(stage(spark, docs.withColumnRenamed("Score", "n_chars"), SMALL), "test_odd")
    assert {r["doc_id"] for r in docs.collect()} >= {3, 5, 6, 9, 10}
