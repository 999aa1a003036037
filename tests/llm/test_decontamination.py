import hashlib
import random
import re

from tablewarden.llm.decontamination import SPAN, contamination, uncontaminated
from tests.llm.conftest import ODD_SCHEMA

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SMALLER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(SMALLER))


def plain(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(SPAN, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w = words(text)
        hit, ids = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                found = windows.get(tuple(w[i:i + n]))
                if found is not None:
                    hit.update(range(i, i + n))
                    ids.update(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), sorted(ids)))
    return sorted(out, key=repr)


def found(spark, docs, items):
    rows = contamination(spark.createDataFrame(docs, "doc_id bigint, text string"),
                         spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert all(r["contaminated"] == (r["n_hit"] > 0) and r["n_items"] == len(r["item_ids"]) for r in rows)
    return sorted([(r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"]) for r in rows], key=repr)


def test_windows_short_items_ties_and_nulls(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(6)] + ["É", "ΟΔΟΣ", "İx", "Kelvin"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 4, 9, 10, 11, 25])))) for i in range(12)]
    items += [(3, items[3][1]), (None, "n1 n2 n3 n4 n5 n6 n7 n8 n9 n10"), (50, None), (51, " ..! "), (52, "")]
    docs = []
    for i in range(60):
        w = rng.choices(vocabulary, k=rng.randrange(0, 60))
        if i % 3 == 0:
            at = rng.randrange(len(w) + 1)
            w[at:at] = words(rng.choice(items[:12])[1])
        docs.append((i, rng.choice([" ", "-", "'. "]).join(w).upper() if i % 2 else " ".join(w)))
    docs += [(70, "x N1 n2 n3 n4, n5 n6 n7 n8 n9 N10 y"), (71, None), (72, ""), (70, docs[0][1]), (None, docs[3][1])]
    assert found(spark, docs, items) == plain(docs, items)


def test_shared_spans_of_every_place_are_found(spark):
    rng = random.Random(9)
    item = [f"i{k}" for k in range(40)]
    docs = []
    for at in range(0, 31, 3):
        around = [f"d{rng.randrange(10_000)}" for _ in range(50)]
        docs.append((at, " ".join(around[:at] + item[at:at + SPAN] + around[at:])))
        docs.append((100 + at, " ".join(around[:at] + item[at:at + SPAN - 1] + around[at:])))
    rows = found(spark, docs, [(1, " ".join(item))])
    assert {r[0]: r[2] for r in rows} == {d: (SPAN if d < 100 else 0) for d, _ in docs}


def test_odd_documents_and_empty_tables(spark, odd, empty):
    items = spark.createDataFrame([(1, "one two three four"), (None, None)], "item_id bigint, text string")
    marked = contamination(odd, items)
    assert len(marked.columns) == len(set(c.lower() for c in marked.columns))
    assert sorted((r["n_words"], r["n_hit"]) for r in marked.collect() if r["doc_id"] in (1, 2, 5)) == \
        [(0, 0), (6, 4), (6, 4), (6, 4)]
    assert contamination(empty, items).count() == 0
    none = contamination(odd, items.limit(0))
    assert none.count() == odd.count() and none.where("contaminated").count() == 0
    kept = uncontaminated(odd, items)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 4
    assert {f.name for f in kept.schema} == {c.split()[0] for c in ODD_SCHEMA.split(", ")}


def test_query_digest(spark, con):
    import __spark_entry__ as entry_points
    rows = entry_points.queries()["op1_decontamination"](spark, "/root/testdata/sf0.001").collect()
    want = plain(con.execute("SELECT doc_id, text FROM documents").fetchall(),
                 con.execute("SELECT item_id, text FROM benchmark").fetchall())
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"], r["items_sha256"]) for r in rows) == \
        sorted((d, n, h, hashlib.sha256(",".join(i).encode()).hexdigest()) for d, n, h, i in want)
