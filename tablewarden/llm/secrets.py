"""Secret scans: fixed patterns, and a battery of randomness tests, in DataFrame functions only.

Long tokens that no pattern covers are tested for randomness. The alphabet of a token is inferred
from its characters; a chi-squared test asks whether all characters of it are equally frequent, a
runs test and a serial-correlation test whether their order is random. A token stays a secret
unless the tests reject randomness. Rejections are decided over all distinct tokens of similar
length and equal alphabet together, by the step-up rule that bounds the share of false rejections,
so that a true secret is rarely lost however many tokens there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.llm.common import Packed, in_blocks, let, materialize, running, text_key
from tablewarden.operators.lookup import broadcast_if_small

# The patterns, with the letters of the words in either case.
ASSIGN = (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
          r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
          r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
LEAST_VALUE = 6
# A run is as long as it can be, so asking for the length in the pattern finds the same runs.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# '=' is padding only where no character of a token follows.
_PADDING = r"(?:={1,2}(?![A-Za-z0-9+/_=-]))?"
TOKEN = r"[A-Za-z0-9+/_-]{20,}" + _PADDING
# A token with marks of both base64 alphabets is in none; these parts of it are.
PARTS = [r"[A-Za-z0-9_-]{20,}" + _PADDING, r"[A-Za-z0-9+/]{20,}" + _PADDING, r"[A-Za-z0-9]{20,}" + _PADDING]
KINDS = ["assign", "access", "hex", "random"]

# The alphabets, narrow ones first. Padding is not part of them.
ALPHABETS = [
    ("hex", "0123456789abcdef"),
    ("HEX", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("BASE36", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base62", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
]

FALSE_REJECTIONS = 0.05
# p-values are counted in tenths of a power of ten, down to this many.
BINS = 300

SPAN_TYPE = "array<struct<start:int,kind:int,stop:int,token:string>>"


def _matches(text: Column, pattern: str, kind: int, keep: Column | None = None) -> Column:
    """(start, kind, stop, token) of all leftmost matches, in code points.

    The pieces between the matches and the matches themselves alternate, so their lengths give
    the places. The pieces are only made for texts with a match.
    """
    def placed(found: Column) -> Column:
        widths = F.zip_with(found, F.slice(F.split(text, pattern, -1), 1, F.size(found)),
                            lambda m, gap: F.length(gap) + F.length(m))
        return F.zip_with(found, running(widths, lambda a, b: a + b), lambda m, stop: F.struct(
            (stop - F.length(m)).alias("start"), F.lit(kind).alias("kind"), stop.alias("stop"),
            m.alias("token")))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(found, lambda m: F.when(F.size(m) > 0, placed(m)).otherwise(
        F.array().cast(SPAN_TYPE)))


def base_spans(text: Column) -> Column:
    """The spans of the fixed patterns; assignments only with a value that is long enough."""
    value = F.regexp_extract
    assign = F.filter(_matches(text, ASSIGN, 0),
                      lambda s: F.length(value(s["token"], ASSIGN, 2)) >= LEAST_VALUE)
    return F.concat(assign, _matches(text, ACCESS, 1), _matches(text, HEX, 2))


def _parts(token: Column) -> Column:
    """The long parts of a token of no alphabet, each in the places of the text."""
    found = F.array_distinct(F.concat(*[_matches(token["token"], p, 3) for p in PARTS]))
    return F.transform(found, lambda s: F.struct(
        (s["start"] + token["start"]).alias("start"), s["kind"].alias("kind"),
        (s["stop"] + token["start"]).alias("stop"), s["token"].alias("token")))


def candidates(text: Column) -> Column:
    """Long tokens, or their long parts, that have a digit and a letter."""
    def cut(tokens: Column) -> Column:
        return F.flatten(F.transform(tokens, lambda s: F.when(
            s["token"].rlike("[_-]") & s["token"].rlike("[+/]"), _parts(s)).otherwise(F.array(s))))
    return F.filter(let(_matches(text, TOKEN, 3), cut),
                    lambda s: s["token"].rlike("[0-9]") & s["token"].rlike("[A-Za-z]"))


def _normal_tail(z: Column) -> Column:
    """P(|Z| >= |z|) of a standard normal, by a rational approximation good to about 1e-7."""
    x = F.abs(z) / (2 ** 0.5)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return poly * F.exp(-x * x)


def randomness_tests(tokens: DataFrame) -> DataFrame:
    """Add ``_alphabet``, ``_band`` (of the length) and ``_p`` to distinct tokens (``_token``).

    A token in no alphabet is left out. The p-value is three times the smallest of the tests'.
    """
    bare = F.rtrim(F.col("_token"), F.lit("="))
    alphabet = F.coalesce(*[F.when(bare.rlike(f"^[{letters.replace('-', chr(92) + '-')}]+$"), i)
                            for i, (_, letters) in enumerate(ALPHABETS)])
    rows = tokens.select("_token", bare.alias("_bare"), alphabet.alias("_alphabet")) \
        .where(F.col("_alphabet").isNotNull() & (F.length("_bare") > 1))
    letters = F.element_at(F.array(*[F.lit(x) for _, x in ALPHABETS]), F.col("_alphabet") + 1)
    values = F.transform(F.split("_bare", ""), lambda c: (F.instr(letters, c) - 1).cast("double"))
    rows = rows.select("_token", "_alphabet", values.alias("_v"), F.length(letters).cast("double").alias("_m"),
                       F.length("_bare").cast("double").alias("_n"))
    n, m = F.col("_n"), F.col("_m")
    squares = F.aggregate(F.array_distinct("_v"), F.lit(0.0), lambda s, x: s + F.pow(
        F.size(F.filter("_v", lambda y: y == x)).cast("double"), F.lit(2.0)))
    chi = m / n * squares - n
    free = m - 1
    # The cube root of a chi-squared value over its freedom is nearly normal.
    spread = F.lit(2.0) / (9 * free)
    z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / free, F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread)
    p_chi = F.when(z_chi > 0, _normal_tail(z_chi) / 2).otherwise(1 - _normal_tail(z_chi) / 2)
    high = F.size(F.filter("_v", lambda y: y >= m / 2)).cast("double")
    low = n - high
    following = F.slice("_v", 2, F.size("_v") - 1)
    before = F.slice("_v", 1, F.size("_v") - 1)
    changes = F.aggregate(F.zip_with(before, following, lambda a, b: ((a >= m / 2) != (b >= m / 2))
                                     .cast("double")), F.lit(0.0), lambda s, x: s + x)
    expected = 2 * high * low / n + 1
    variance = (expected - 1) * (expected - 2) / (n - 1)
    p_runs = F.when(variance > 0, _normal_tail((changes + 1 - expected) / F.sqrt(variance))) \
        .otherwise(0.0)
    middle = (m - 1) / 2
    moment = F.aggregate(F.zip_with(before, following, lambda a, b: (a - middle) * (b - middle)),
                         F.lit(0.0), lambda s, x: s + x)
    p_serial = _normal_tail(moment / ((n - 1) * (m * m - 1) / 12) * F.sqrt(n - 1))
    p = F.least(F.lit(1.0), 3 * F.least(p_chi, p_runs, p_serial))
    return rows.select("_token", "_alphabet", F.floor(F.log2("_n")).cast("int").alias("_band"), p.alias("_p"))


def random_tokens(tests: DataFrame, rate: float = FALSE_REJECTIONS) -> DataFrame:
    """The tokens of stored ``tests`` whose randomness is not rejected.

    Within an alphabet and a band of lengths the step-up rule rejects the k smallest p-values for
    the largest k with p(k) <= k * rate / tokens. It is applied to counts in bins of p, with the
    upper end of a bin as its p, so it never rejects more than the exact rule. The table of
    bins is bounded by alphabets, bands and ``BINS``, whatever the number of tokens.
    """
    bin_of = F.least(F.lit(BINS), F.floor(-10 * F.log10(F.greatest("_p", F.lit(1e-300))))).cast("int")
    binned = tests.withColumn("_bin", bin_of)
    counts = binned.groupBy("_alphabet", "_band", "_bin").agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy("_alphabet", "_band")
    lower = group.orderBy(F.desc("_bin")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.select("_alphabet", "_band", "_bin", F.sum("_n").over(lower).alias("_k"),
                           F.sum("_n").over(group).alias("_all"))
    passed = F.pow(F.lit(10.0), -F.col("_bin") / 10) <= F.col("_k") * rate / F.col("_all")
    cuts = ranked.where(passed).groupBy("_alphabet", "_band").agg(F.min("_bin").alias("_cut"))
    return (binned.join(F.broadcast(cuts), ["_alphabet", "_band"], "left")  # bounded, see above
            .where(F.col("_cut").isNull() | (F.col("_bin") < F.col("_cut"))).select("_token"))


def scan(docs: DataFrame, text: str = "text", rate: float = FALSE_REJECTIONS) -> DataFrame:
    """Add ``secrets`` to each document: (start, stop, kind) in order, in code points.

    The spans of the fixed patterns are all there; random tokens are added where they overlap none
    of them. Decisions are over the distinct tokens of all documents, so copies do not weigh. A NULL
    or empty text has no spans, an empty table no rows; a very long text costs little more than its
    length and its spans. Equal texts have equal spans, and repeated rows stay repeated. Other columns
    are kept, whatever their names; one named ``secrets`` is replaced.
    """
    packed = Packed(docs)
    text = packed.named(text)
    base = packed.df.withColumn("_key", text_key(text))
    spans = F.explode(F.concat(base_spans(F.col(text)), candidates(F.col(text)))).alias("_s")
    found = materialize(base.where(F.col("_key").isNotNull()).select("_key", spans)
                        .select("_key", "_s.*").distinct(), "secret_spans")
    tokens = found.where(F.col("kind") == 3).select(F.col("token").alias("_token")).distinct()
    tests = materialize(randomness_tests(tokens), "secret_tests")
    random = materialize(random_tokens(tests, rate), "random_tokens")
    added = found.join(broadcast_if_small(random), F.col("token") == F.col("_token"), "left_semi") \
        .where(F.col("kind") == 3)
    kept = found.where(F.col("kind") < 3).unionAll(added)
    # Overlaps show between neighbours in the order of the places: the farthest stop so far and the
    # next start. Windows that grow in one direction take one step per span.
    text_spans = Window.partitionBy("_key")
    upto, back = text_spans.orderBy("start"), text_spans.orderBy(F.desc("start"))
    is_fixed = F.col("kind") < 3
    kept = kept.select("_key", "start", "kind", "stop",
                       F.max(F.when(is_fixed, F.col("stop"))).over(upto).alias("_reach"),
                       F.min(F.when(is_fixed, F.col("start"))).over(back).alias("_next"))
    kept = kept.where(is_fixed | ~(F.coalesce(F.col("_reach") > F.col("start"), F.lit(False))
                                   | F.coalesce(F.col("_next") < F.col("stop"), F.lit(False))))
    # Of the parts of one token, those inside another one add nothing.
    outer = text_spans.orderBy("start", F.desc("stop")).rowsBetween(Window.unboundedPreceding, -1)
    kept = kept.withColumn("_outer", F.max(F.when(~is_fixed, F.col("stop"))).over(outer))
    kept = kept.where(is_fixed | F.col("_outer").isNull() | (F.col("_outer") < F.col("stop")))
    chosen = F.array_sort(F.collect_list(F.struct("start", "kind", "stop")))
    names = F.array(*[F.lit(k) for k in KINDS])
    named = F.transform("_chosen", lambda s: F.struct(
        s["start"].alias("start"), s["stop"].alias("stop"), F.get(names, s["kind"]).alias("kind")))
    grouped = kept.groupBy("_key").agg(chosen.alias("_chosen"))
    grouped = materialize(grouped.select("_key", named.alias("_secrets")), "secrets")
    joined = base.join(grouped, "_key", "left")
    return packed.unpack(joined, [F.coalesce("_secrets", F.array().cast(
        "array<struct<start:int,stop:int,kind:string>>"))], ["secrets"])


def redact(text: Column, spans: Column, mark: str = "[{}]") -> Column:
    """The text with each span replaced by its kind; overlapping spans are replaced as one.

    A span that begins inside the one before it only lengthens that one.
    """
    before, after = mark.split("{}")

    def block(spans: Column, at: Column, to: Column) -> Column:
        """The text from ``at`` to ``to``, which ``spans`` cover; cut out once, so places are near."""
        def piece(own: Column) -> Column:
            return F.array_join(F.transform(spans, lambda s: F.when(s["start"] >= s["at"], F.concat(
                F.substr(own, s["at"] - at + 1, s["start"] - s["at"]), F.lit(before), s["kind"],
                F.lit(after))).otherwise("")), "")
        return let(F.substr(text, at + 1, to - at), piece)

    def cleaned(reach: Column) -> Column:
        placed = F.zip_with(spans, F.concat(F.array(F.lit(0)), reach), lambda s, at: F.when(
            s.isNotNull(), F.struct(at.alias("at"), s["start"].alias("start"), s["kind"].alias("kind"))))
        placed = F.slice(placed, 1, F.size(spans))
        parts = let(in_blocks(placed), lambda blocks: F.transform(blocks, lambda b, i: block(
            b, F.get(b, 0)["at"], F.coalesce(F.get(F.get(blocks, i + 1), 0)["at"], F.get(reach, F.size(reach) - 1)))))
        return F.concat(F.array_join(parts, ""),
                        F.substr(text, F.get(reach, F.size(reach) - 1) + 1, F.length(text)))
    reach = running(F.transform(spans, lambda s: s["stop"]), lambda a, b: F.greatest(a, b))
    return F.when(F.size(spans) > 0, let(reach, cleaned)).otherwise(text)
