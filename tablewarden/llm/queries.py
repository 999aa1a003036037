"""The registered queries of this package and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.llm import (
    bpe, centroids, chat, decontamination, fingerprints, licenses, near_dedup, quality, repair,
    secrets, token_ids, toxicity, warc)
from tablewarden.llm.common import let
from tablewarden.llm.training import held_out, training_rows
from tablewarden.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(make: Callable[[SparkSession, str], DataFrame]):
        QUERIES[make.__name__] = make
        if sql is not None:
            ORACLES[make.__name__] = sql
        return make
    return register


OP1_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS span
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS span
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, item_id, i, dw.n FROM dw JOIN bw ON dw.n = bw.n AND dw.span = bw.span),
per_word AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hits),
n_hit AS (SELECT doc_id, count(*) AS n_hit FROM per_word GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items,
               string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
        FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n_hit ON d.doc_id = n_hit.doc_id LEFT JOIN ids ON d.doc_id = ids.doc_id
"""


@query(OP1_SQL)
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontamination.contamination(read_table(spark, sf_dir, "documents"),
                                           read_table(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", "n_words", "n_hit", "n_items",
                         F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                         "contaminated")


@query()
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(read_table(spark, sf_dir, "pages"))
    records = warc.read_archives(archives, payloads=False)
    intact = F.when(F.col("intact"), F.col("payload_digest")).otherwise(
        F.raise_error(F.concat(F.lit("damaged record "), "record_id")))
    return records.select(warc.page_of("record_id").alias("page_id"), "payload_bytes",
                          intact.alias("payload_digest"), "record_type",
                          warc.page_of("refers_to").alias("refers_to"))


@query()
def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return near_dedup.near_duplicates(docs).select("doc_id", "class_id")


@query()
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = quality.fit(training_rows(docs, labels, "quality"))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


OP5_SQL = """
WITH t AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place,
                  count(*) OVER (PARTITION BY conv_id) AS size FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT conv_id, place, size, string_agg(sha256(role || chr(0) || text), '') OVER (
             PARTITION BY conv_id ORDER BY place) AS prefix FROM t),
w AS (SELECT place, prefix, min(conv_id) AS conv_id FROM p WHERE place = size GROUP BY place, prefix),
kept AS (SELECT conv_id FROM w WHERE NOT EXISTS (
             SELECT 1 FROM p WHERE p.place < p.size AND p.place = w.place AND p.prefix = w.prefix))
SELECT conv_id, count(*) AS n_turns,
       string_agg('<|' || role || '|>' || chr(10) || text || chr(10) || '<|end|>' || chr(10), '' ORDER BY place) AS chat
FROM t WHERE conv_id IN (SELECT conv_id FROM kept) GROUP BY conv_id
UNION ALL
SELECT DISTINCT NULL, 1, '<|' || role || '|>' || chr(10) || text || chr(10) || '<|end|>' || chr(10) FROM conversations
WHERE conv_id IS NULL AND NOT EXISTS (SELECT 1 FROM p WHERE p.place = 1 AND p.prefix = sha256(role || chr(0) || text))
"""


@query(OP5_SQL)
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(read_table(spark, sf_dir, "conversations"))


@query()
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    tokens = bpe.encode(docs, ranks, pattern).select("doc_id", "ids", "n_tokens")
    return bpe.decode(tokens, ranks, pattern).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query()
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    lexicon = toxicity.fit(training_rows(docs, labels, "toxic"))
    scored = toxicity.score(docs.select("doc_id", "text"), lexicon)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


OP7_TREE = r"""
WITH o AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT doc_id, text, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS nt FROM o),
e AS (SELECT doc_id, text, nt, substr(text, 1, length(text) - length(text) // 4) || substr(nt, 1, length(text) // 4) AS ed FROM n),
v AS (SELECT doc_id, 0 AS k, text AS t FROM e UNION ALL SELECT doc_id, 1, ed FROM e UNION ALL SELECT doc_id, 2, nt FROM e),
trees AS (SELECT doc_id, k, list_transform(regexp_split_to_array(t, '\n[ \t]*\n'), lambda s: list_transform(string_split(s, chr(10)),
            lambda p: list_transform(range(0, (len(string_split(p, ' ')) - 1) // 16 + 1),
                lambda i: sha256(array_to_string(string_split(p, ' ')[16 * i + 1 : 16 * i + 16], ' '))))) AS b FROM v),
h AS (SELECT doc_id, k, b, list_transform(b, lambda s: list_transform(s, lambda p: sha256(array_to_string(p, '')))) AS ph FROM trees),
g AS (SELECT doc_id, k, b, ph, list_transform(ph, lambda s: sha256(array_to_string(s, ''))) AS sh FROM h),
f AS (SELECT doc_id, k, sha256(array_to_string(sh, '')) AS root,
        list_distinct(list_transform(flatten(flatten(b)), lambda x: x[1:8])) AS leaves,
        array_to_string(list_transform(range(1, len(sh) + 1), lambda i: sh[i][1:16] || '=' ||
          array_to_string(list_transform(range(1, len(ph[i]) + 1), lambda j: ph[i][j][1:8] || '.' ||
            array_to_string(list_transform(b[i][j], lambda x: x[1:8]), '')), ',')), ';') AS rest FROM g)
"""

OP7_SQL = OP7_TREE + """
SELECT e.doc_id, length(e.text) AS n_chars, sha256(e.ed) AS edited_sha256, a.root || ':' || a.rest AS fingerprint,
       c.root || ':' || c.rest AS edited_fingerprint,
       CASE WHEN a.root = c.root THEN 1.0::DOUBLE ELSE
         2.0::DOUBLE * len(list_intersect(a.leaves, c.leaves)) / (len(a.leaves) + len(c.leaves)) END AS near_edited,
       CASE WHEN a.root = x.root THEN 1.0::DOUBLE ELSE
         2.0::DOUBLE * len(list_intersect(a.leaves, x.leaves)) / (len(a.leaves) + len(x.leaves)) END AS near_next
FROM e JOIN f a ON a.doc_id = e.doc_id AND a.k = 0 JOIN f c ON c.doc_id = e.doc_id AND c.k = 1
JOIN f x ON x.doc_id = e.doc_id AND x.k = 2
"""


@query(OP7_SQL)
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fingerprints.with_next(read_table(spark, sf_dir, "documents"))
    size = F.length("text")
    cut = F.floor(size / 4).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), size - cut), F.substr("next_text", F.lit(1), cut))

    def facts(t: Column) -> Column:
        own, changed, following = t["own"], t["changed"], t["following"]
        return F.struct(fingerprints.fingerprint(own).alias("fingerprint"),
                        fingerprints.fingerprint(changed).alias("edited_fingerprint"),
                        fingerprints.likeness(own, changed).alias("near_edited"),
                        fingerprints.likeness(own, following).alias("near_next"))
    made = docs.select("doc_id", size.cast("bigint").alias("n_chars"), edited.alias("edited"), "text", "next_text")
    trees = F.struct(fingerprints.tree("text").alias("own"), fingerprints.tree("edited").alias("changed"),
                     fingerprints.tree("next_text").alias("following"))
    made = made.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       let(trees, facts).alias("facts"))
    return made.select("doc_id", "n_chars", "edited_sha256", "facts.*")


@query()
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("secrets", lambda s: s["kind"] != "random")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("secrets")).alias("spans"))


def _op10_sql() -> str:
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"
    known = ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in licenses.KNOWN.items())
    steps = []
    for i, (name, ids) in enumerate(licenses.RULES):
        piece = quoted(" " + "  ".join(ids) + " ")
        steps.append(f"r{i + 1} AS (SELECT doc_id, n, replace(rest, {piece}, ' | ') AS rest, CASE WHEN contains(rest, {piece}) "
                     f"THEN list_append(found, {quoted(name)}) ELSE found END AS found FROM r{i})")
    return rf"""
WITH s AS (SELECT doc_id, unnest(list_transform(range(1, len(p) + 1), lambda i: {{'place': i, 's': p[i]}})) AS x
           FROM (SELECT doc_id, regexp_split_to_array(regexp_replace(text, '([.!?:])[ \t\r\n\f]+', '\1' || chr(10), 'g'), '[\r\n]+') AS p FROM documents)),
known(plain, name) AS (VALUES {known}),
found AS (SELECT doc_id, x.place AS place, name FROM s JOIN known
          ON trim(regexp_replace(lower(x.s), '[^a-z0-9]+', ' ', 'g')) = plain),
r0 AS (SELECT doc_id, count(*) AS n, '  ' || string_agg(name, '  ' ORDER BY place) || '  ' AS rest,
              CAST([] AS VARCHAR[]) AS found FROM found GROUP BY doc_id),
{", ".join(steps)}
SELECT d.doc_id, coalesce(array_to_string(list_sort(list_distinct(found)), ','), '') AS licenses,
       coalesce(n, 0) AS n_sentences
FROM documents d LEFT JOIN r{len(licenses.RULES)} r ON d.doc_id = r.doc_id
"""


@query(_op10_sql())
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.recognise(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.array_join("licenses", ",").alias("licenses"),
                        F.size("license_sentences").cast("bigint").alias("n_sentences"))


@query()
def op11_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = token_ids.write_ids(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return token_ids.read_ids(spark, folder).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def _op13_sql(rounds: int = 3) -> str:
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""d{r} AS MATERIALIZED (SELECT rid, c, d FROM (SELECT rid, c, d, row_number() OVER (PARTITION BY rid ORDER BY d, c) AS place
    FROM (SELECT rid, c, CAST(list_sum(list_transform(list_zip(k.q, c{r}.q), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
          FROM k, c{r})) WHERE place = 1)""")
        if r < rounds:
            steps.append(f"""m{r} AS (SELECT c, list(m ORDER BY j) AS q FROM (SELECT c, j, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
    FROM d{r} JOIN parts USING (rid) GROUP BY c, j) GROUP BY c),
c{r + 1} AS MATERIALIZED (SELECT c, coalesce(m{r}.q, c{r}.q) AS q FROM c{r} LEFT JOIN m{r} USING (c))""")
    return """
WITH k AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS rid,
           list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
      WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT rid, unnest(q) AS x, unnest(range(64)) AS j FROM k),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c, q FROM k ORDER BY c LIMIT 16),
""" + ",\n".join(steps) + f"""
SELECT k.vec_id, CAST(d.c AS INTEGER) AS cluster, d.d AS distance, CAST(sum(d.d) OVER (PARTITION BY d.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM k JOIN d{rounds} d ON d.rid = k.rid JOIN c{rounds} c ON c.c = d.c
"""


@query(_op13_sql())
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(read_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


@query()
def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations")
    return repair.repaired(turns, repair.damage(turns))
