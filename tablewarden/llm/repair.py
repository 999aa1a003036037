"""Repair of the structure of conversations: what is wrong with them and the cheapest edits.

A conversation is cut into blocks of rows. Within a block an auction finds least costs; a block is
summed up by the costs between its four states, so long conversations are spread over many tasks and
only these sums meet per conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.llm import auction
from tablewarden.llm.common import materialize
from tablewarden.operators.ordered import MAX_GROUP_ROWS, number_rows

BLOCK_ROWS = 1024
# White space that leaves a text blank (fixed values).
SPACES = r"\x20\x09-\x0D"
RESULTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def damage(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
           ) -> DataFrame:
    """(conv_id, turn, role, text, copy) after planted faults, which the CRC of ``conv:turn`` chooses.

    Of the CRC modulo 20, 0 drops a row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it and
    4 makes it a user's. NULL roles and texts are one blank, as are NULL ids and turns in the CRC.
    """
    def name(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(name(conv), F.lit(":"), name(turn))) % 20
    rows = turns.select(
        F.col(conv).alias("conv_id"), F.col(turn).cast("bigint").alias("turn"), fault.alias("fault"),
        F.when(fault == 4, "user").otherwise(name(role)).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(name(text), "[.!?]", "")).otherwise(name(text))
        .alias("text"))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where(F.col("fault") != 0).select("conv_id", "turn", "role", "text", F.explode(copies).alias("copy"))


def _key(conv: str) -> Column:
    """A key that is never NULL."""
    return F.when(F.col(conv).isNull(), F.lit("")).otherwise(F.concat(F.lit("#"), F.col(conv).cast("string")))


def repair(turns: DataFrame, block_rows: int = BLOCK_ROWS, max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """What is wrong with each conversation of ``turns`` (conv_id, turn, role, text), and its repair.

    Rows are in order of turn, NULLs first, then role and text. The first fault of a row counts: a
    blank text, role and text that an earlier row has, a text whose last character other than white
    space is not one of ``.!?``. ``illegal`` counts neighbours whose roles' initials are not su, ua
    or au, ``gaps`` the missing turn numbers. Edits keep a row (0), give it the role user or assistant
    (3), delete it (4, required for blank and repeated ones) or insert an empty turn (3); a text cut
    short that stays costs 3 more. ``audit`` has the initials of the cheapest edits after which the
    roles' initials are an s at most and then any number of ua, ``cost`` their cost, and
    ``repaired_sha256`` the hash of the ``role:text`` lines; of equally cheap edits those with
    the ASCII-least initials are taken.

    NULL roles and texts are one blank. Rows without an id are one conversation. Repeated rows are
    repeats that the edits delete. A conversation of any length is worked on in blocks; only its
    hash is taken in one task, which streams its rows. Other columns are not looked at. Of an empty
    table the result is empty.
    """
    turns = turns.select(_key("conv_id").alias("conv"), "conv_id", F.col("turn").cast("bigint").alias("turn"),
                         *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
                         *(["copy"] if "copy" in turns.columns else [F.lit(0).alias("copy")]))
    numbered = number_rows(turns, ["conv"], ["turn", "role", "text", "copy"], "pos", max_rows)
    blank = ~F.col("text").rlike(f"[^{SPACES}]")
    cut = ~F.col("text").rlike(f"[.!?][{SPACES}]*\\z")
    digest = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    initial = F.left("role", F.lit(1))
    rows = materialize(numbered.select(
        "conv", "conv_id", "turn", "role", "text", (F.col("pos") - 1).alias("pos"), digest.alias("digest"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
        blank.alias("blank"), cut.alias("cut")), "repair_rows")
    firsts = rows.groupBy("conv", "digest").agg(F.min("pos").alias("first"))
    facts = rows.select("conv", "conv_id", "turn", "pos", "digest", "initial", "blank", "cut") \
        .join(firsts, ["conv", "digest"]).withColumn("repeated", ~F.col("blank") & (F.col("pos") > F.col("first")))
    short = ~F.col("blank") & ~F.col("repeated") & F.col("cut")
    facts = materialize(facts.select(
        "conv", "conv_id", "turn", "pos", "initial", "blank", "repeated", short.alias("short"),
        F.floor(F.col("pos") / block_rows).alias("block")), "repair_facts")
    counts = facts.groupBy("conv").agg(
        F.first("conv_id").alias("conv_id"),
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
        *[F.count_if(F.col(c)).alias(n) for c, n in
          (("blank", "blank"), ("repeated", "duplicate"), ("short", "truncated"))])
    mark = F.when(F.col("blank") | F.col("repeated"), auction.GONE).when(F.col("short"), auction.CUT) \
        .otherwise(auction.FINE)
    # At most ``block_rows`` pairs of letters in a group.
    letters = F.array_sort(F.collect_list(F.struct("pos", "initial", mark.alias("mark"))))
    blocks = facts.groupBy("conv", "block").agg(letters.alias("rows")).select(
        "conv", "block", F.array_join("rows.initial", "").alias("initials"), F.array_join("rows.mark", "").alias("marks"))
    blocks = materialize(blocks, "repair_blocks")
    edited = _edited(blocks)
    whole = _joined(edited)
    # The edits of a block, cut at its rows.
    pieces = edited.join(whole.select("conv", F.posexplode("entries").alias("block", "entry")), ["conv", "block"])
    pieces = pieces.select("conv", "block", F.posexplode(F.regexp_extract_all(
        F.get("edits", F.col("entry")), F.lit("(I*[DKR])"))).alias("place", "piece")) \
        .select("conv", (F.col("block") * block_rows + F.col("place")).alias("pos"), "piece")
    hashed = rows.select("conv", "pos", "role", "text").join(pieces, ["conv", "pos"]) \
        .repartition("conv").sortWithinPartitions("conv", "pos").select("conv", "piece", "role", "text") \
        .mapInArrow(auction.hash_batches, "conv string, repaired_sha256 string")
    return counts.join(whole.drop("entries"), "conv").join(hashed, "conv").select("conv_id", *RESULTS)


def _edited(blocks: DataFrame) -> DataFrame:
    """Stored: the edits of each block, its costs and what follows, from each of the four states."""
    several = materialize(blocks.groupBy("conv").agg(F.max("block").alias("last"))
                          .where(F.col("last") > 0).select("conv"), "repair_long")
    ends = F.array(*[F.lit(c).cast("bigint") for c in auction.TAIL_COSTS])
    if several.isEmpty():
        chosen = blocks.withColumn("end", ends)
    else:
        sums = blocks.join(several, "conv", "left_semi").mapInArrow(
            auction.matrix_batches, "conv string, block bigint, matrix array<bigint>")
        # One short row per block.
        behind = sums.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("block", "matrix"))).alias("blocks")) \
            .mapInArrow(auction.end_batches, "conv string, block bigint, end array<bigint>")
        chosen = blocks.join(behind, ["conv", "block"], "left").withColumn("end", F.coalesce("end", ends))
    return materialize(chosen.select("conv", "block", "initials", "marks", "end").mapInArrow(
        auction.edit_batches, "conv string, block bigint, initials string, edits array<string>, afters array<int>, "
                              "costs array<bigint>, illegal bigint"), "repair_edits")


def _joined(edited: DataFrame) -> DataFrame:
    """(conv, cost, audit, illegal, entries): blocks put together, with the state before each."""
    size = F.length("initials")
    block = F.struct("block", "edits", "afters", "costs", "illegal", F.left("initials", F.lit(1)).alias("head"),
                     F.substring("initials", size, F.lit(1)).alias("tail"))
    lined = edited.groupBy("conv").agg(F.array_sort(F.collect_list(block)).alias("blocks"))
    start = F.array(F.lit(0))
    entries = F.aggregate("blocks", start, lambda states, b: F.concat(
        states, F.array(F.get(b["afters"], F.element_at(states, -1)))))
    lined = lined.withColumn("states", entries)
    parts = F.zip_with("blocks", "states", lambda b, q: F.get(b["edits"], q))
    last = F.element_at("states", -1)
    audit = F.concat(F.array_join(F.filter(parts, lambda p: p.isNotNull()), ""),
                     F.get(F.array(*[F.lit(t) for t in auction.TAILS]), last))
    seams = F.aggregate(
        F.transform("blocks", lambda b: F.struct(b["head"].alias("head"), b["tail"].alias("tail"))),
        F.struct(F.lit("").alias("before"), F.lit(0).cast("bigint").alias("wrong")),
        lambda s, b: F.struct(b["tail"].alias("before"), (s["wrong"] + F.when(
            (s["before"] == "") | F.concat(s["before"], b["head"]).isin("su", "ua", "au"), 0).otherwise(1)).alias("wrong")))
    within = F.aggregate("blocks", F.lit(0).cast("bigint"), lambda s, b: s + b["illegal"])
    cost = F.get(F.element_at("blocks", 1)["costs"], F.lit(0))
    return materialize(lined.select("conv", cost.alias("cost"), audit.alias("audit"),
                                    (within + seams["wrong"]).alias("illegal"),
                                    F.slice("states", 1, F.size("blocks")).alias("entries")), "repair_audits")


def repaired(turns: DataFrame, damaged: DataFrame, **how) -> DataFrame:
    """``repair`` of ``damaged`` with a row for every conversation of ``turns``.

    One that has no rows left has zeros, an empty audit and the hash of an empty text.
    """
    every = turns.select("conv_id").distinct()
    found = repair(damaged, **how).withColumnRenamed("conv_id", "_found")
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("_found")), "left")
    none = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)}
    return joined.select("conv_id", *[F.coalesce(c, none.get(c, F.lit(0).cast("bigint"))).alias(c) for c in RESULTS])
