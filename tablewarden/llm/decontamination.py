"""Benchmark decontamination by winnowing.

Every document keeps the smallest hash of its k-grams in each sliding window of ``WINDOW``
k-grams. A span of ``SPAN`` = ``WINDOW + GRAM - 1`` words holds a whole such window, and the
smallest hash of a window depends on its words alone, so a span that a document shares with an
item gives both the same fingerprint. Joining the fingerprints therefore finds every document
that can hold a shared span; the hits are then extended to whole windows of words, compared
word by word.

All of it is DataFrame functions: words, hashes and minima are array expressions inside a scan,
and only fingerprints, hits and counts are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.llm.common import Packed, let, materialize, semi_join_stored, text_key
from tablewarden.operators.lookup import broadcast_if_small

# What lies between words, and the letters that are made small.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

SPAN = 10
GRAM = 5
WINDOW = SPAN - GRAM + 1


def split_words(text: str | Column) -> Column:
    """The words of a text as they are written; none for a NULL text."""
    return F.coalesce(F.filter(F.split(text, BETWEEN), lambda w: w != ""),
                      F.array().cast("array<string>"))


def words_of(text: str | Column) -> Column:
    """The words of a text with A-Z made small; other letters keep their case."""
    text = F.col(text) if isinstance(text, str) else text
    return split_words(F.translate(text, CAPITALS, CAPITALS.lower()))


def _grams(words: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words.

    Whole words are made small here, which is much faster than one kind of letter is. Words
    that are equal but for A-Z stay equal, so no hit is lost; extending compares exactly.
    """
    def over(hashes: Column) -> Column:
        return F.when(F.size(hashes) < size, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(0), F.size(hashes) - size), lambda i: F.xxhash64(
                *[F.get(hashes, i + j) for j in range(size)])))
    return let(F.transform(words, lambda w: F.xxhash64(F.lower(w))), over)


def fingerprints(words: Column) -> Column:
    """The distinct window minima of a text's k-gram hashes."""
    def minima(grams: Column) -> Column:
        return F.when(F.size(grams) < WINDOW, F.array().cast("array<bigint>")).otherwise(
            F.array_distinct(F.transform(
                F.sequence(F.lit(0), F.size(grams) - WINDOW),
                lambda i: F.least(*[F.get(grams, i + j) for j in range(WINDOW)]))))
    return let(_grams(words, GRAM), minima)


def _spans(words: Column, length: int) -> Column:
    """(start, text) of every run of ``length`` words."""
    def over(w: Column) -> Column:
        return F.when(F.size(w) < length, F.array().cast("array<struct<start:int,span:string>>")) \
            .otherwise(F.transform(F.sequence(F.lit(0), F.size(w) - length), lambda i: F.struct(
                i.cast("int").alias("start"),
                F.array_join(F.slice(w, i + 1, length), " ").alias("span"))))
    return let(words, over)


def contamination(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """Add to each document how much of it occurs in the items.

    Result columns: ``n_words``, ``n_hit`` (words inside an occurrence of an item's window),
    ``n_items``, ``item_ids`` (those items' ids as strings, sorted), ``contaminated``.
    A window is ``SPAN`` consecutive words of an item; an item with fewer words, but some, is
    one window. Hits depend on the text alone, so each distinct text is worked on once and
    repeated documents get equal results. A NULL or empty text has no words and no hits, an
    item without words has no windows, an item with a NULL id counts for hits and not for
    ids, repeated items count once. Without items nothing is contaminated.
    """
    spark = docs.sparkSession
    source = Packed(items)
    item_words = materialize(source.df.select(
        F.col(source.named(item_id)).cast("string").alias("_item"),
        words_of(source.named(item_text)).alias("_words")), "item_words")
    size = F.size("_words")
    # One row per distinct window, with the items that have it.
    lengths = [r[0] for r in item_words.where((size > 0) & (size < SPAN))
               .select(size).distinct().collect()]  # fewer than SPAN numbers
    windows = materialize(_windows(item_words, lengths), "item_windows")
    marks = materialize(item_words.select(F.explode(fingerprints(F.col("_words"))).alias("_print"))
                        .distinct().withColumn("_known", F.lit(True)), "item_prints")

    packed = Packed(docs)
    base = packed.df.withColumn("_key", text_key(packed.named(text)))
    # Texts in groups of their own: how many words, and whether a fingerprint is an item's.
    texts = base.select("_key", split_words(packed.named(text)).alias("_words"))
    prints = texts.select("_key", size.cast("bigint").alias("_n"),
                          F.explode_outer(fingerprints(F.col("_words"))).alias("_print"))
    seen = (prints.join(broadcast_if_small(marks), "_print", "left").groupBy("_key")
            .agg(F.max("_n").alias("_n"), F.max("_known").alias("_known")))
    seen = materialize(seen, "contamination_seen")

    found = _hits(base, packed.named(text), windows,
                  seen.where("_known").select("_key"), lengths)
    found = materialize(found, "contamination_hits")
    covered = _covered(found)
    ids = (found.select("_key", F.explode("_items").alias("_item")).distinct()
           .groupBy("_key").agg(F.array_sort(F.collect_list("_item")).alias("_ids")))
    facts = materialize(seen.drop("_known").join(covered, "_key", "left").join(ids, "_key", "left"),
                        "contamination_facts")
    joined = base.join(facts, "_key", "left")
    hit = F.coalesce("_hit", F.lit(0).cast("bigint"))
    item_ids = F.coalesce("_ids", F.array().cast("array<string>"))
    return packed.unpack(joined, [
        F.coalesce("_n", F.lit(0).cast("bigint")), hit, F.size(item_ids).cast("bigint"), item_ids,
        hit > 0], ["n_words", "n_hit", "n_items", "item_ids", "contaminated"])


def _windows(item_words: DataFrame, lengths: list[int]) -> DataFrame:
    size = F.size("_words")
    parts = [item_words.select("_item", F.lit(SPAN).alias("_length"),
                               F.explode(_spans(F.col("_words"), SPAN)).alias("_s"))]
    for n in lengths:
        parts.append(item_words.where(size == n).select(
            "_item", F.lit(n).alias("_length"), F.explode(_spans(F.col("_words"), n)).alias("_s")))
    both = parts[0]
    for part in parts[1:]:
        both = both.unionAll(part)
    return (both.groupBy(F.col("_s.span").alias("_span"), "_length")
            .agg(F.collect_set("_item").alias("_items")))


def _hits(base: DataFrame, text: str, windows: DataFrame, suspects: DataFrame,
          lengths: list[int]) -> DataFrame:
    """(text, start, length, items) of every occurrence of a window.

    Whole windows are looked for in the texts that share a fingerprint. Items shorter than a
    window have no guarantee from winnowing, so their few words are looked for in all texts.
    """
    suspects = materialize(suspects, "suspects")
    chosen = semi_join_stored(base.select("_key", text), suspects, "_key")
    found = _occurrences(chosen.dropDuplicates(["_key"]), text, windows, SPAN)
    for n in lengths:
        found = found.unionAll(_occurrences(base.where(F.col("_key").isNotNull()), text, windows, n)
                               .dropDuplicates(["_key", "_start", "_length"]))
    return found


def _occurrences(texts: DataFrame, text: str, windows: DataFrame, length: int) -> DataFrame:
    spans = texts.select("_key", F.explode(_spans(words_of(text), length)).alias("_s"))
    spans = spans.select("_key", F.col("_s.start").alias("_start"), F.col("_s.span").alias("_span"))
    return spans.join(broadcast_if_small(windows.where(F.col("_length") == length)), "_span") \
        .select("_key", "_start", "_length", "_items")


def _covered(found: DataFrame) -> DataFrame:
    """Words per text that lie in an occurrence; occurrences overlap and vary in length."""
    order = Window.partitionBy("_key").orderBy("_start", "_length")
    stop = F.col("_start") + F.col("_length")
    before = F.coalesce(F.max(stop).over(order.rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0))
    return (found.select("_key", "_start", "_length",
                         F.greatest(stop - F.greatest(F.col("_start"), before), F.lit(0)).alias("_new"))
            .groupBy("_key").agg(F.sum("_new").alias("_hit")))


def uncontaminated(docs: DataFrame, items: DataFrame, text: str = "text",
                   item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents without a hit, with their own columns."""
    marked = contamination(Packed(docs).df.toDF(*[f"d{i}" for i in range(len(docs.columns))]),
                           items, f"d{_place(docs, text)}", item_id, item_text)
    kept = marked.where(~F.col("contaminated"))
    return kept.select(*[F.col(f"d{i}").alias(n) for i, n in enumerate(docs.columns)])


def _place(docs: DataFrame, name: str) -> int:
    return [c.lower() for c in docs.columns].index(name.lower())
