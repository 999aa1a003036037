"""Merkle fingerprints of documents, in DataFrame functions only.

A text is cut into sections at blank lines, a section into paragraphs at line breaks, and a
paragraph into blocks of ``BLOCK`` words. Every node is hashed over its parts, up to the root of
the text. Equal roots mean equal texts; where roots differ, only differing branches need to be
walked to find the edits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.llm.common import Packed, let, materialize
from tablewarden.operators.lookup import broadcast_if_small

BLOCK = 16
SECTION_END = "\n[ \t]*\n"
# Hex digits of a node's hash that a fingerprint shows.
SECTION_DIGITS, PARAGRAPH_DIGITS, BLOCK_DIGITS = 16, 8, 8


def _blocks(paragraph: Column) -> Column:
    """The blocks of a paragraph; joined by blanks they are the paragraph."""
    return let(F.split(paragraph, " "), lambda words: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(words) - 1) / BLOCK).cast("int")),
        lambda i: F.array_join(F.slice(words, i * BLOCK + 1, BLOCK), " ")))


def _node(parts: Column) -> Column:
    """The hash over the hashes of a node's parts."""
    return F.sha2(F.array_join(parts, ""), 256)


def _paragraph(text: Column) -> Column:
    return let(F.transform(_blocks(text), lambda b: F.sha2(b, 256)), lambda hashes: F.struct(
        _node(hashes).alias("hash"), hashes.alias("blocks")))


def _section(text: Column) -> Column:
    return let(F.transform(F.split(text, "\n"), _paragraph), lambda paragraphs: F.struct(
        _node(paragraphs["hash"]).alias("hash"), paragraphs.alias("paragraphs")))


def tree(text: str | Column) -> Column:
    """The tree of a text: ``hash`` and ``sections`` of ``hash`` and ``paragraphs`` of ``hash`` and ``blocks``.

    A NULL text has the tree of an empty one: one section, paragraph and block, each empty.
    """
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return let(F.transform(F.split(text, SECTION_END), _section), lambda sections: F.struct(
        _node(sections["hash"]).alias("hash"), sections.alias("sections")))


def fingerprint(tree: Column) -> Column:
    """A tree as text: the root, then sections of paragraphs of blocks with shortened hashes."""
    def paragraph(p: Column) -> Column:
        return F.concat(F.left(p["hash"], F.lit(PARAGRAPH_DIGITS)), F.lit("."), F.array_join(
            F.transform(p["blocks"], lambda b: F.left(b, F.lit(BLOCK_DIGITS))), ""))

    def section(s: Column) -> Column:
        return F.concat(F.left(s["hash"], F.lit(SECTION_DIGITS)), F.lit("="),
                        F.array_join(F.transform(s["paragraphs"], paragraph), ","))
    return F.concat(tree["hash"], F.lit(":"), F.array_join(F.transform(tree["sections"], section), ";"))


def _leaves(tree: Column) -> Column:
    """The distinct blocks of a tree, as its fingerprint shows them."""
    blocks = F.flatten(F.transform(tree["sections"], lambda s: F.flatten(s["paragraphs"]["blocks"])))
    return F.array_distinct(F.transform(blocks, lambda b: F.left(b, F.lit(BLOCK_DIGITS))))


def likeness(one: Column, two: Column) -> Column:
    """1 for trees with equal roots, else twice the shared distinct blocks over those of both."""
    def shared(a: Column, b: Column) -> Column:
        both = F.size(F.array_intersect(a, b)).cast("double")
        return F.lit(2.0) * both / (F.size(a) + F.size(b))
    return F.when(one["hash"] == two["hash"], F.lit(1.0)).otherwise(
        let(_leaves(one), lambda a: let(_leaves(two), lambda b: shared(a, b))))


def differences(one: Column, two: Column) -> Column:
    """Where two trees differ: (section, paragraph, block) from 0, walking differing branches only.

    Parts are compared by place; a part that one tree lacks is a difference at its first block.
    """
    def places(a: Column, b: Column) -> Column:
        n = F.greatest(F.coalesce(F.size(a), F.lit(0)), F.coalesce(F.size(b), F.lit(0)))
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def unlike(a: Column, b: Column, i: Column) -> Column:
        return ~F.get(a, i).eqNullSafe(F.get(b, i))

    def blocks(a: Column, b: Column, s: Column, p: Column) -> Column:
        return F.transform(F.filter(places(a, b), lambda i: unlike(a, b, i)), lambda i: F.struct(
            s.alias("section"), p.alias("paragraph"), i.alias("block")))

    def paragraphs(a: Column, b: Column, s: Column) -> Column:
        return F.flatten(F.transform(
            F.filter(places(a, b), lambda p: unlike(a["hash"], b["hash"], p)),
            lambda p: blocks(F.get(a, p)["blocks"], F.get(b, p)["blocks"], s, p)))

    def sections(a: Column, b: Column) -> Column:
        return F.flatten(F.transform(
            F.filter(places(a, b), lambda s: unlike(a["hash"], b["hash"], s)),
            lambda s: paragraphs(F.get(a, s)["paragraphs"], F.get(b, s)["paragraphs"], s)))
    return F.when(one["hash"] == two["hash"],
                  F.array().cast("array<struct<section:int,paragraph:int,block:int>>")).otherwise(
        let(one["sections"], lambda a: let(two["sections"], lambda b: sections(a, b))))


# Rows in a slice of the order, and the most slices that a table is cut into.
SLICE_ROWS = 1_000
MAX_SLICES = 20_000


def _slice_of(ident: Column, bounds: list) -> Column:
    """How many bounds are at most ``ident``, found in two steps of about sqrt(bounds) each."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    heads = F.array(*[F.lit(g[0]).cast("bigint") for g in groups])
    parts = F.array(*[F.array(*[F.lit(b).cast("bigint") for b in g]) for g in groups])
    group = F.size(F.filter(heads, lambda b: b <= ident)) - 1
    return F.when(ident.isNull(), 0).otherwise(let(group, lambda g: F.when(g < 0, 0).otherwise(
        g * step + F.size(F.filter(F.get(parts, g), lambda b: b <= ident)))))


def with_next(docs: DataFrame, ident: str = "doc_id", text: str = "text", rows: int = SLICE_ROWS
              ) -> DataFrame:
    """(ident, text, next_text) of each document: the text that follows in ascending order of ids.

    NULL ids come first; rows with equal ids are ordered by text; the first text follows the last
    one. NULL texts are empty. The order is cut into slices at quantiles of the ids, so each text
    is shuffled once, to the task of its slice, and only the first text of a slice goes to the
    slice before. Rows of one id lie in one slice.
    """
    table = docs.select(F.col(ident).cast("bigint").alias("_id"),
                        F.coalesce(F.col(text), F.lit("")).alias("_text"))
    count = table.count()
    slices = min(MAX_SLICES, count // rows)
    bounds: list = []
    if slices > 1:
        shares = [i / slices for i in range(1, slices)]
        found = table.agg(F.percentile_approx("_id", shares, 10 * slices)).first()[0]
        bounds = sorted(set(found or []))  # fewer numbers than slices
    table = table.withColumn("_slice", _slice_of(F.col("_id"), bounds))
    order = [F.col("_id").asc_nulls_first(), F.col("_text")]
    first = F.min_by("_text", F.struct(F.col("_id").isNotNull(), F.col("_id"), F.col("_text")))
    firsts = materialize(table.groupBy("_slice").agg(first.alias("_first")), "slice_firsts")
    # One row per slice: the first text of the slice after it, or of all.
    line = Window.orderBy("_slice")
    opening = F.first("_first").over(line.rowsBetween(Window.unboundedPreceding, 0))
    following = firsts.select("_slice", F.coalesce(F.lead("_first").over(line), opening)
                              .alias("_after"))
    following = materialize(following, "slice_followers")
    here = Window.partitionBy("_slice").orderBy(*order)
    joined = (table.withColumn("_next", F.lead("_text").over(here))
              .join(broadcast_if_small(following), "_slice", "left"))
    return joined.select(F.col("_id").alias(ident), F.col("_text").alias(text),
                         F.coalesce("_next", "_after").alias("next_text"))


def fingerprints(docs: DataFrame, text: str = "text", names: tuple[str, str] = ("fingerprint", "root")
                 ) -> DataFrame:
    """Add the fingerprint of each text and its root. Equal texts have equal fingerprints."""
    packed = Packed(docs)
    marked = packed.df.withColumn("_tree", tree(packed.named(text)))
    return packed.unpack(marked, [fingerprint(F.col("_tree")), F.col("_tree.hash")], names)
