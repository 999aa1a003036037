import hashlib

from pyspark.sql import functions as F

from tablewarden.llm.fingerprints import differences, fingerprints, likeness, tree, with_next
import re


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(text):
    sections = []
    for s in re.split("\n[ \t]*\n", text or ""):
        paragraphs = []
        for p in s.split("\n"):
            w = p.split(" ")
            blocks = [sha(" ".join(w[i:i + 16])) for i in range(0, len(w), 16)]
            paragraphs.append((sha("".join(blocks)), blocks))
        sections.append((sha("".join(h for h, _ in paragraphs)), paragraphs))
    root = sha("".join(h for h, _ in sections))
    return root + ":" + ";".join(h[:16] + "=" + ",".join(
        p[:8] + "." + "".join(b[:8] for b in bs) for p, bs in ps) for h, ps in sections)


def test_fingerprints_against_plain_hashes(spark, odd, empty, texts):
    rows = fingerprints(odd)
    assert all(r["fingerprint"] == plain(r["text"]) and r["root"] == r["fingerprint"][:64] for r in rows.collect())
    assert fingerprints(empty).count() == 0
    docs = [*texts.values(), "\n\n", "a\n \t\nb", "a\n\n\nb", " ", "  a  ", "\n" + "w " * 40 + "\n\n" + "v " * 16]
    df = spark.createDataFrame([(t,) for t in docs], "text string")
    assert sorted(r["fingerprint"] for r in fingerprints(df).collect()) == sorted(map(plain, docs))


def test_edits_are_located(spark):
    paragraph = [f"p{i} " + " ".join(f"w{i}_{j}" for j in range(40)) for i in range(9)]
    text = "\n\n".join("\n".join(paragraph[k:k + 3]) for k in (0, 3, 6))
    edited = text.replace("w4_20", "edit").replace("w8_1 ", "new ")
    df = spark.createDataFrame([(text, edited, text + "\nmore")], "a string, b string, c string")
    a, b, c = (tree(x) for x in "abc")
    row = df.select(differences(a, b).alias("ab"), differences(a, a).alias("aa"), differences(a, c).alias("ac"),
                    likeness(a, b).alias("near"), likeness(a, a).alias("same")).first()
    assert [tuple(x) for x in row["ab"]] == [(1, 1, 1), (2, 2, 0)]
    assert row["aa"] == [] and [tuple(x) for x in row["ac"]] == [(2, 3, 0)]
    assert 0.9 < row["near"] < 1 and row["same"] == 1


def test_next_texts(spark, odd, empty, texts):
    rows = [(i, t) for i, t in sorted(texts.items())]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    want = {i: rows[(k + 1) % len(rows)][1] for k, (i, _) in enumerate(rows)}
    for size in (7, 50, 1000):
        assert {r["doc_id"]: r["next_text"] for r in with_next(df, rows=size).collect()} == want
    order = sorted(((i is not None, i or 0, t or "") for i, t in odd.select("doc_id", "text").collect()))
    got = sorted((r[0] is not None, r[0] or 0, r[1], r[2]) for r in with_next(odd, rows=2).collect())
    assert got == sorted((*x, order[(k + 1) % len(order)][2]) for k, x in enumerate(order))
    assert with_next(empty).count() == 0
    assert with_next(df.limit(1)).select((F.col("text") == F.col("next_text")).alias("own")).first()["own"]
