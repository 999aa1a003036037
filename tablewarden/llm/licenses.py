"""Licence recognition by sentences and ordered rules, in DataFrame functions only.

A text is cut into sentences; each is reduced to its lower-case letters and digits and looked up
among known licence sentences. The identifiers found, in text order, are then matched against
rules in order: a rule that finds its sequence takes those identifiers away, so a general rule
after it cannot use them again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import Packed, let, materialize, text_key

# Sentences of public licences and notices, as they are written, each up to where
# ``ENDS`` ends it.
SENTENCES = {
    "mit-name": "The MIT License (MIT)",
    "mit-short": "Released under the MIT License.",
    "mit-under": "Licensed under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
                 "software and associated documentation files (the \"Software\"), to deal in the Software "
                 "without restriction, including without limitation the rights to use, copy, modify, merge, "
                 "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
                 "to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or "
                  "substantial portions of the Software.",
    "mit-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
                 "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
                 "PURPOSE AND NONINFRINGEMENT.",
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
                     "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
                     "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
                 "without fee is hereby granted, provided that the above copyright notice and this permission "
                 "notice appear in all copies.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are "
                 "permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of "
                  "conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of "
                  "conditions and the following disclaimer in the documentation and/or other materials "
                  "provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to "
                 "endorse or promote products derived from this software without specific prior written "
                 "permission.",
    "apache-short": "Licensed under the Apache License, Version 2.0.",
    "apache-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
                     "file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-as-is": "Unless required by applicable law or agreed to in writing, software distributed under "
                    "the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
                    "KIND, either express or implied.",
    "apache-see": "See the License for the specific language governing permissions and limitations under the "
                  "License.",
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                "published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version.",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of "
                 "the GNU General Public License as published by the Free Software Foundation; either version 2 "
                 "of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
                "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl-see": "See the GNU General Public License for more details.",
    "mpl-terms": "This Source Code Form is subject to the terms of the Mozilla Public License, v.",
    "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    "cc-by": "Licensed under CC BY 4.0.",
    "cc-by-sa": "Licensed under CC BY-SA 4.0.",
    "cc-by-work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-work": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
                     "License.",
    "cc-by-nc-work": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
                     "International License.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "reserved": "All rights reserved.",
}

# Fixed values: (licence, identifiers that follow one another among those found). Longer rules
# stand before those that would match a part of them.
RULES = [
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-grant",)),
    ("MIT", ("mit-name",)),
    ("MIT", ("mit-short",)),
    ("MIT", ("mit-under",)),
    ("ISC", ("isc-grant",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("Apache-2.0", ("apache-header", "apache-copy", "apache-as-is", "apache-see")),
    ("Apache-2.0", ("apache-header", "apache-copy")),
    ("Apache-2.0", ("apache-header",)),
    ("Apache-2.0", ("apache-short",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope", "gpl-see")),
    ("GPL-3.0-or-later", ("gpl-free",)),
    ("GPL-2.0-or-later", ("gpl2-free", "gpl-hope", "gpl-see")),
    ("GPL-2.0-or-later", ("gpl2-free",)),
    ("GPL-3.0-only", ("gpl3-work",)),
    ("MPL-2.0", ("mpl-terms",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-work",)),
    ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-work",)),
    ("CC-BY-SA-4.0", ("cc-by-sa",)),
    ("CC-BY-4.0", ("cc-by-work",)),
    ("CC-BY-4.0", ("cc-by",)),
    ("Unlicense", ("unlicense",)),
    ("proprietary", ("reserved",)),
]

# Pieces end with a stop before a blank, with a colon or stop at the end of a line, or with a line
# break. A sentence is a piece, or pieces of one paragraph joined over the line breaks between them.
ENDS = r"(?<=[.!?:])[ \t\r\n\f]+|[\r\n]+"
BLANK_LINE = r"\n[\r\n]|\r\r|\r\n\r"


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def _plain(sentence: str) -> str:
    return " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in sentence.lower()).split())


KNOWN = {_plain(s): name for name, s in SENTENCES.items()}


_WORDS = max(len(k.split()) for k in KNOWN)


def _pieces(text: Column) -> Column:
    """(plain, last) of all pieces; ``last`` if no sentence goes on after it."""
    return F.zip_with(F.split(text, ENDS, -1), F.regexp_extract_all(text, F.lit(ENDS), F.lit(0)), lambda p, end: F.struct(
        normalised(p).alias("plain"),
        (end.isNull() | p.rlike("[.!?:]$") | end.rlike(BLANK_LINE)).alias("last")))


def known_sentences(text: Column) -> Column:
    """(place, plain) of the known sentences; the place is that of the first piece.

    The pieces after one that begins a known sentence are joined to it while they still do, and
    the longest sentence counts. A line of marks only is a blank line.
    """
    known = F.array(*[F.lit(k) for k in KNOWN])

    def begins(plain: Column) -> Column:
        return (plain != "") & F.exists(known, lambda k: F.startswith(F.concat(k, F.lit(" ")), F.concat(plain, F.lit(" "))))

    def joined(pieces: Column, place: Column) -> Column:
        start = F.struct(F.lit("").alias("sofar"), F.lit(True).alias("open"), F.lit(None).cast("string").alias("best"))

        def step(s: Column, p: Column) -> Column:
            longer = F.when(s["sofar"] == "", p["plain"]).otherwise(F.concat(s["sofar"], F.lit(" "), p["plain"]))
            more = let(longer, lambda t: F.struct(
                t.alias("sofar"), (~p["last"] & begins(t)).alias("open"),
                F.when(F.array_contains(known, t), t).otherwise(s["best"]).alias("best")))
            closed = F.struct(s["sofar"].alias("sofar"), F.lit(False).alias("open"), s["best"].alias("best"))
            return F.when(s["open"] & (p["plain"] != ""), more).otherwise(closed)
        best = F.aggregate(F.slice(pieces, place + 1, F.lit(_WORDS)), start, step, lambda s: s["best"])
        return F.struct(place.alias("place"), best.alias("plain"))

    def found(pieces: Column) -> Column:
        placed = F.transform(pieces, lambda p, i: F.when(begins(p["plain"]), i))
        starts = F.filter(placed, lambda i: i.isNotNull())
        return F.filter(F.transform(starts, lambda i: joined(pieces, i)), lambda s: s["plain"].isNotNull())
    return let(_pieces(text), found)


def recognise(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``licenses`` and ``license_sentences`` to each document.

    ``license_sentences`` has the place (from 0, among all pieces between ``ENDS``) and the identifier
    of every known sentence, in order, also of those that are wrapped over lines, with comment marks
    or without; ``licenses`` the distinct licences whose rules match, sorted. Both are empty for texts
    without known sentences, and for NULL and empty texts. Copies of a text are matched once.
    """
    spark = docs.sparkSession
    packed = Packed(docs)
    text = packed.named(text)
    base = packed.df.withColumn("_key", text_key(text))
    # A text whose words do not have those of a known sentence in a row does not have it at all.
    words = F.concat(F.lit(" "), normalised(F.col(text)), F.lit(" "))
    likely = let(words, lambda t: F.exists(F.array(*[F.lit(f" {k} ") for k in KNOWN]), lambda k: F.contains(t, k)))
    sentences = F.explode(F.when(likely, known_sentences(F.col(text)))).alias("_s")
    known = spark.createDataFrame(list(KNOWN.items()), "_plain string, _name string")
    found = (base.where(F.col("_key").isNotNull()).select("_key", sentences)
             .select("_key", F.col("_s.place").alias("_place"), F.col("_s.plain").alias("_plain"))
             .join(F.broadcast(known), "_plain")  # the fixed table above
             .select("_key", "_place", "_name").distinct())
    grouped = found.groupBy("_key").agg(F.array_sort(F.collect_list(F.struct(
        F.col("_place").alias("place"), F.col("_name").alias("sentence")))).alias("_found"))
    matched = materialize(grouped.withColumn("_licenses", _matches(F.col("_found.sentence"))), "licenses")
    joined = base.join(matched, "_key", "left")
    return packed.unpack(joined, [
        F.coalesce("_licenses", F.array().cast("array<string>")),
        F.coalesce("_found", F.array().cast("array<struct<place:int,sentence:string>>"))],
        ["licenses", "license_sentences"])


def _matches(names: Column) -> Column:
    """The licences of the rules that match, applied in order to what earlier ones left."""
    rest = F.concat(F.lit("  "), F.array_join(names, "  "), F.lit("  "))
    state = F.struct(rest.alias("rest"), F.array().cast("array<string>").alias("found"))
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(" " + "  ".join(ids) + " ").alias("ids"))
                      for name, ids in RULES])
    last = F.aggregate(rules, state, lambda s, r: F.when(F.contains(s["rest"], r["ids"]), F.struct(
        F.replace(s["rest"], r["ids"], F.lit(" | ")).alias("rest"),
        F.array_append(s["found"], r["name"]).alias("found"))).otherwise(s))
    return F.array_sort(F.array_distinct(last["found"]))
