"""Near-duplicate classes by order minhash and banded alignment.

The similarity of two texts is one minus their edit distance in words over the longer one's
words. A sketch value takes the few occurrence-labelled runs of ``k`` words with the smallest
hashes and keeps them in text order, so equal values speak for shared words in a shared order.
Texts with an equal value are candidates, and alignment decides; where very many unlike texts have a
value, its candidates are those that share rare runs. Classes are the connected components.

Which texts are found: two that share 0.8 or more of their runs of five words miss all sketches with
a chance below 1e-13. Texts that are near by alignment but share fewer runs, because their edits are spread
out, are found less often: with 0.5 a chance of 1e-4 is missed, with 0.25 one in eight, and texts that
share no run, such as five words with the middle one changed, are never found.
"""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.llm.common import Packed, in_small_batches, materialize, semi_join_stored, text_key
from tablewarden.llm.components import components
from tablewarden.llm.sketches import (
    aligned_batches, counted_run_batches, first_run_batches, run_batches, sketch_batches)
from tablewarden.operators.lookup import broadcast_if_small
from tablewarden.storage import release

SIMILARITY = 0.8
RUN = 5
PICKS = 2
SKETCHES = 32
# Texts of a sketch value up to which every two of them are compared.
BUCKET = 128
# Bytes of text that a task counts runs of.
TASK_BYTES = 16_000_000
# Size of the common runs up to which every task gets them; more are joined.
COMMON_BYTES = 8_000_000
# What is left of a value is cut into so many times more parts in each round.
MORE_PARTS = 8
# Pairs that are joined at once rather than in rounds: so many, or so many for each text of a value.
PAIRS, PAIRS_EACH = 100_000, 4


def _near(texts: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """The stored ``pairs`` (a, b) whose texts are near by alignment, stored."""
    involved = materialize(pairs.select("a").unionAll(pairs.select("b")).distinct()
                           .toDF("_key"), "near_involved")
    chosen = materialize(semi_join_stored(texts.select("_key", "_text"), involved, "_key")
                         .dropDuplicates(["_key"]), "near_texts")
    both = (pairs.join(chosen.select(F.col("_key").alias("b"), F.col("_text").alias("_second")), "b")
            .join(chosen.select(F.col("_key").alias("a"), F.col("_text").alias("_first")), "a")
            .select("a", "b", "_first", "_second"))
    near = materialize(in_small_batches(both).mapInArrow(
        partial(aligned_batches, similarity=similarity), "a binary, b binary"), "near_pairs")
    release(involved, chosen)
    return near


def _pairs(one: DataFrame, two: DataFrame, similarity: float, apart: Column | None = None) -> DataFrame:
    """(a, b) of the texts of ``one`` and ``two`` (_key, _words, _value, _root) that have a value in common.

    Lengths rule out some pairs, and ``apart`` over ``_root_one`` and ``_root_two`` others; neither become rows.
    """
    one = one.select("_value", *[F.col(c).alias(f"{c}_one") for c in ("_key", "_words", "_root")])
    two = two.select("_value", *[F.col(c).alias(f"{c}_two") for c in ("_key", "_words", "_root")])
    how = (F.col("o._value") == F.col("t._value")) & (
        F.least("_words_one", "_words_two") >= similarity * F.greatest("_words_one", "_words_two") - 1e-9)
    joined = one.alias("o").join(two.alias("t"), how if apart is None else how & apart)
    return joined.select(F.least("_key_one", "_key_two").alias("a"), F.greatest("_key_one", "_key_two").alias("b"))


def _candidates(members: DataFrame, similarity: float) -> DataFrame:
    """(a, b) of every two texts of ``members`` with a value in common that are not of one root."""
    return _pairs(members, members, similarity, F.col("_root_one") < F.col("_root_two"))


def _join_roots(members: DataFrame, roots: DataFrame) -> DataFrame:
    known = roots.select(F.col("node").alias("_key"), F.col("root").alias("_root"))
    return members.join(known, "_key", "left").withColumn("_root", F.coalesce("_root", "_key"))


def _mixed(members: DataFrame) -> DataFrame:
    """Stored (_value, _n, _main, _meets) of the values whose texts are in more than one component.

    ``_n`` texts, of which ``_main`` has most; a text of another component is in ``_meets`` pairs, each counted once.
    """
    each = members.groupBy("_value", "_root").agg(F.count(F.lit(1)).alias("_m"))
    each = each.groupBy("_value").agg(F.sum("_m").alias("_n"), F.max(F.struct("_m", "_root")).alias("_most"))
    meets = (F.col("_n") + F.col("_most._m")) / 2
    return materialize(each.where(F.col("_most._m") < F.col("_n")).select(
        "_value", "_n", F.col("_most._root").alias("_main"), meets.alias("_meets")), "near_mixed")


def _of_mixed(members: DataFrame) -> DataFrame:
    """Stored ``members`` of the values whose texts are in more than one component, with ``_n``, ``_main`` and ``_meets``."""
    mixed = _mixed(members)
    kept = materialize(members.join(broadcast_if_small(mixed), "_value"), "near_rest")
    release(mixed)
    return kept


class _Links:
    """The components so far, and the pairs that were compared for them."""

    def __init__(self, texts: DataFrame, similarity: float):
        self.texts, self.similarity = texts, similarity
        self.roots, self.compared = None, None

    def compare(self, pairs: DataFrame) -> None:
        pairs = pairs.distinct()
        if self.compared is not None:
            pairs = pairs.join(self.compared, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "near_candidates")
        if self.roots is not None and pairs.isEmpty():
            release(pairs)
            return
        self.compared = pairs if self.compared is None else self.compared.unionAll(pairs)
        near = _near(self.texts, pairs, self.similarity)
        if self.roots is None:
            self.roots = materialize(components(near), "near_components")
        elif not near.isEmpty():
            # Only the roots of the components so far are joined anew.
            before = self.roots
            a, b = (before.select(F.col("node").alias(c), F.col("root").alias(f"_{c}")) for c in ("a", "b"))
            edges = near.join(a, "a", "left").join(b, "b", "left").select(
                F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
            moved = materialize(components(edges), "near_components")
            old = before.join(moved.select(F.col("node").alias("root"), F.col("root").alias("_new")), "root", "left")
            old = old.select("node", F.coalesce("_new", "root").alias("root"))
            alone = moved.join(before, "node", "left_anti")
            self.roots = materialize(old.unionAll(alone), "near_components")
            release(before, moved)
        release(near)


def _ends_first(links: _Links, members: DataFrame, parts: int) -> DataFrame:
    """Compare the texts of each value with the smallest and the largest of each of its parts.

    Returns the stored members of values that are not all in one component yet, without those ends.
    With ``_main``, the component that has most texts of a value, two texts of it never meet: one of
    the two is always of another component.
    """
    part = F.pmod(F.xxhash64("_key"), F.lit(parts))
    member = F.struct("_key", "_words", "_root")
    known = "_main" in members.columns
    ends = materialize(members.groupBy("_value", part.alias("_part")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(member).alias("_low"), F.max(member).alias("_high"),
        *[F.min("_main").alias("_main")] * known)
        .where(F.lit(parts > 1) | (F.col("_n") > 1)), "sketch_ends")
    if known:
        each = ends.select("_value", "_main", F.explode(F.array_distinct(F.array("_low", "_high"))).alias("_end"))
        each = each.select("_value", "_main", "_end.*")
        other = F.col("_root") != F.col("_main")
        links.compare(
            _pairs(members.where(other), each, links.similarity, F.col("_root_one") != F.col("_root_two"))
            .unionAll(_pairs(members.where(~other), each.where(other), links.similarity)))
    else:
        linked = members.join(ends.select("_value", "_low", "_high"), "_value")
        linked = linked.select("_key", "_words", "_root", F.explode(F.array("_low", "_high")).alias("_end"))
        shorter, longer = F.least("_words", "_end._words"), F.greatest("_words", "_end._words")
        links.compare(linked.where((F.col("_root") != F.col("_end._root"))
                                   & (shorter >= links.similarity * longer - 1e-9))
                      .select(F.least("_key", "_end._key").alias("a"), F.greatest("_key", "_end._key").alias("b")))
    inner = ends.where(F.col("_n") > (3 if parts == 1 else 2)).select(
        "_value", "_part", F.col("_low._key").alias("_least"), F.col("_high._key").alias("_most"))
    rest = (members.select("_key", "_words", "_value", part.alias("_part")).join(inner, ["_value", "_part"])
            .where((F.col("_key") != F.col("_least")) & (F.col("_key") != F.col("_most")))
            .select("_key", "_words", "_value"))
    rest = materialize(_join_roots(rest, links.roots), "near_rest")
    kept = _of_mixed(rest)
    release(ends, rest)
    return kept


def _compare_rest(links: _Links, rest: DataFrame) -> None:
    """Compare texts with a value in common, until all of a value that were not compared are in one component.

    Only pairs of two components count, so a value of one large component and a few other texts costs
    the product of the two. Where there are many, rounds link what they can before.
    """
    rest, parts = _of_mixed(rest), 1
    while True:
        other = F.col("_root") != F.col("_main")
        size, pairs = rest.agg(F.count(F.lit(1)), F.sum(F.when(other, F.col("_meets")))).first()
        if not size:
            return
        if pairs <= max(PAIRS, PAIRS_EACH * size):
            few = rest.where(other)
            links.compare(_candidates(few, links.similarity)
                          .unionAll(_pairs(few, rest.where(~other), links.similarity)))
            return
        rest = _ends_first(links, rest, parts)
        parts *= MORE_PARTS


def _values(runs: DataFrame) -> np.ndarray:
    return np.sort(np.array([r._value for r in runs.select("_value").collect()], np.int64))


def _rare_runs_first(links: _Links, texts: DataFrame, hot: DataFrame, k: int, limit: int,
                     max_bytes: int = COMMON_BYTES) -> DataFrame:
    """Stored (_key, _words, _value, _common): runs, some of which near texts have in common.

    ``hot`` has the keys of the texts in question. Their runs are put in one order, in which those
    that more than ``limit`` of the texts have come last. Two texts with n runs each at most that share a
    share of t of all their runs have one of them among the first n - ceil(t n) + 1 of either.
    """
    chosen = materialize(semi_join_stored(texts.select("_key", "_text"), hot, "_key").dropDuplicates(["_key"]),
                         "hot_texts")
    size = chosen.agg(F.sum(F.octet_length("_text"))).first()[0]
    tasks = -(-size // TASK_BYTES)
    # A run that more than ``limit`` texts have is in more than limit / tasks texts of some task.
    limit = max(limit, 16 * tasks)

    def counted(more_than: int, among: np.ndarray | None) -> DataFrame:
        return in_small_batches(chosen.coalesce(tasks)).mapInArrow(
            partial(counted_run_batches, k=k, more_than=more_than, among=among), "_value bigint, _texts bigint")
    often = materialize(counted(limit // tasks, None).select("_value").distinct(), "often_runs")
    few = 8 * often.count() <= max_bytes
    if few:
        # So few runs that every task can have them; only first runs become rows then.
        counts = counted(0, _values(often)).groupBy("_value").agg(F.sum("_texts").alias("_texts"))
    else:
        runs = in_small_batches(chosen).mapInArrow(partial(run_batches, k=k),
                                                   "_key binary, _words bigint, _runs array<bigint>")
        each = runs.select("_key", "_words", F.size("_runs").alias("_n"), F.explode("_runs").alias("_value"))
        counts = each.groupBy("_value").agg(F.count(F.lit(1)).alias("_texts"))
    common = materialize(counts.where(F.col("_texts") > limit).select("_value", F.lit(True).alias("_common")),
                         "common_runs")
    if few:
        known = _values(common)
        alone = tasks <= 1
        first = in_small_batches(chosen.coalesce(1) if alone else chosen).mapInArrow(
            partial(first_run_batches, k=k, common=known, similarity=links.similarity, alone=alone),
            "_key binary, _words bigint, _value bigint, _common boolean")
    else:
        place = Window.partitionBy("_key").orderBy("_common", "_value")
        first = each.join(common, "_value", "left").withColumn(
            "_common", F.coalesce("_common", F.lit(False))).withColumn("_place", F.row_number().over(place))
        first = first.where(F.col("_place") <= F.col("_n") - F.ceil(F.col("_n") * links.similarity - 1e-9) + 1)
    first = materialize(first.select("_key", "_words", "_value", "_common"), "first_runs")
    release(chosen, often, common)
    return first


def near_roots(texts: DataFrame, similarity: float = SIMILARITY, k: int = RUN, picks: int = PICKS,
               sketches: int = SKETCHES, bucket: int = BUCKET, common_bytes: int = COMMON_BYTES) -> DataFrame:
    """(node, root) of the texts that are near another; ``texts`` has ``_key`` and ``_text``.

    A text may be there many times; it is sketched each time and counted once.

    The texts of a sketch value are its bucket. First all texts of a bucket are compared with its
    smallest and its largest text. Then, in buckets of at most ``bucket`` texts that are not in one
    component yet, every two are. A larger one stems from a passage that many unlike texts have; its
    texts are compared when they share a rare one of their first runs, which is exact for texts
    that share ``similarity`` of their runs. Texts whose first runs reach into common ones are made of
    common passages almost wholly; those that share such a run and are in two components are compared,
    all at once where such pairs are few, else in rounds, each of which takes out the ends of more and
    smaller parts, until all that remain are in one component.
    """
    texts = texts.where(F.col("_text").isNotNull())
    sketched = in_small_batches(texts.select("_key", "_text")).mapInArrow(
        partial(sketch_batches, k=k, picks=picks, sketches=sketches),
        "_key binary, _words bigint, _sketch array<bigint>")
    values = materialize(
        sketched.select("_key", "_words", F.explode("_sketch").alias("_value")).distinct(), "sketches")
    links = _Links(texts, similarity)
    rest = _ends_first(links, values.withColumn("_root", F.col("_key")), 1)
    release(values)
    pairs = _candidates(rest.where(F.col("_n") <= bucket), similarity)
    large = rest.where(F.col("_n") > bucket)
    if large.isEmpty():
        links.compare(pairs)
        return links.roots
    hot = materialize(large.select("_key").distinct(), "hot_texts")
    first = _rare_runs_first(links, texts, hot, k, bucket, common_bytes)
    rare = first.where(~F.col("_common")).select("_key", "_words", "_value")
    shared = materialize(rare.groupBy("_value").agg(F.count(F.lit(1)).alias("_texts"))
                         .where(F.col("_texts") > 1).select("_value"), "shared_runs")
    rare = _join_roots(semi_join_stored(rare, shared, "_value"), links.roots)
    links.compare(pairs.unionAll(_candidates(materialize(rare, "rare_runs"), similarity)))
    rest = materialize(_join_roots(first.where("_common").select("_key", "_words", "_value"), links.roots), "near_rest")
    release(first)
    _compare_rest(links, rest)
    return links.roots


def _classes(base: DataFrame, text: str, ident: str, **how) -> DataFrame:
    """Stored (_key, _root, _id): each text with the root text of its class and its smallest id."""
    roots = near_roots(base.select("_key", F.col(text).alias("_text")), **how)
    roots = roots.select(F.col("node").alias("_key"), F.col("root").alias("_root"))
    texts = base.where(F.col("_key").isNotNull()).groupBy("_key").agg(F.min(ident).alias("_id"))
    return materialize(texts.join(roots, "_key", "left")
                       .withColumn("_root", F.coalesce("_root", "_key")), "near_roots")


def near_duplicates(docs: DataFrame, text: str = "text", ident: str = "doc_id", **how) -> DataFrame:
    """Add ``class_id`` to each document: the smallest id in its near-duplicate class.

    Exact copies share a class; so do texts joined by a chain of near pairs. Texts that differ
    only in what lies between words, or in the case of A-Z, are near. A NULL text is a class of
    its own row, an empty text is like other empty texts, a text of fewer than ``k`` words is
    one run. The class id is NULL if all ids of the class are. ``how`` are the parameters of
    ``near_roots``. Of an empty table the result is empty.
    """
    packed = Packed(docs)
    ident, text = packed.named(ident), packed.named(text)
    base = packed.df.withColumn("_key", text_key(text))
    roots = _classes(base, text, ident, **how)
    ids = materialize(roots.groupBy("_root").agg(F.min("_id").alias("_class")), "near_classes")
    classes = roots.join(ids, "_root").select("_key", "_class")
    joined = base.join(materialize(classes, "near_class_ids"), "_key", "left")
    return packed.unpack(joined, [F.when(F.col("_key").isNull(), F.col(ident))
                                  .otherwise(F.col("_class"))], ["class_id"])


def deduplicate(docs: DataFrame, text: str = "text", ident: str = "doc_id", **how) -> DataFrame:
    """One document of each near-duplicate class: the one with the smallest id.

    A class without ids keeps one of its documents; documents without a text all stay. Of
    repeated rows with the same id and text one stays.
    """
    packed = Packed(docs)
    ident, text = packed.named(ident), packed.named(text)
    base = packed.df.withColumn("_key", text_key(text))
    roots = _classes(base, text, ident, **how)
    best = F.min(F.struct(F.col("_id").isNull(), F.col("_id"), F.col("_key")))
    keepers = roots.groupBy("_root").agg(best.alias("_best"))
    keepers = keepers.select(F.col("_best._key").alias("_key"), F.col("_best._id").alias("_keep"))
    rows = base.groupBy("_key", F.col(ident).alias("_keep")).agg(F.count(F.lit(1)).alias("_rows"))
    keepers = materialize(keepers.alias("k").join(
        rows.alias("r"), (F.col("k._key") == F.col("r._key")) & F.col("k._keep").eqNullSafe(F.col("r._keep")))
        .select(F.col("k._key").alias("_kept_key"), F.col("k._keep").alias("_keep"), "_rows"), "near_keepers")
    joined = base.join(keepers, (F.col("_key") == F.col("_kept_key"))
                       & F.col(ident).eqNullSafe(F.col("_keep")), "left")
    joined = joined.where(F.col("_key").isNull() | F.col("_rows").isNotNull())
    if keepers.where(F.col("_rows") > 1).isEmpty():
        return packed.unpack(joined)
    repeated = F.coalesce("_rows", F.lit(1)) > 1
    once = joined.where(~repeated).unionAll(
        joined.where(repeated).dropDuplicates(["_kept_key"]))
    return packed.unpack(once)
