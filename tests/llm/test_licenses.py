import textwrap

from tablewarden.llm.licenses import RULES, SENTENCES, recognise


def found(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r["doc_id"]: (list(r["licenses"]), [tuple(s) for s in r["license_sentences"]]) for r in recognise(df).collect()}


def test_rules_in_order(spark):
    s = SENTENCES
    got = found(spark, [
        " ".join(s[x] for x in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
        " ".join(s[x] for x in ("bsd-grant", "bsd-source", "bsd-binary")),
        "Words. released UNDER the mit license!\n\nLicensed under CC BY-NC 4.0. More words.",
        s["apache-header"] + "\n" + s["apache-copy"] + "\nhttp://example.org/x\n" + s["apache-as-is"] + " " + s["apache-see"],
        "Nothing is licensed here.", s["mit-short"] + " " + s["mit-short"],
        "We write 'Released under the MIT License.' in a sentence.", s["bsd-source"], None, "", s["bsd-grant"] + "\n" + s["mit-short"] + "\n" + s["bsd-source"]])
    assert got[0][0] == ["BSD-3-Clause"] and got[1][0] == ["BSD-2-Clause"]
    assert got[2] == (["CC-BY-NC-4.0", "MIT"], [(1, "mit-short"), (2, "cc-by-nc")])
    assert got[3][0] == ["Apache-2.0"] and len(got[3][1]) == 4
    assert got[4] == ([], []) and got[5][0] == ["MIT"] and len(got[5][1]) == 2
    assert got[6] == ([], []) and got[7] == ([], [(0, "bsd-source")])
    assert got[8] == got[9] == ([], []) and got[10][0] == ["MIT"]


def test_sentences_wrapped_over_lines(spark):
    s = SENTENCES
    mit = "\n\n".join(["The MIT License (MIT)", "Copyright (c) 2020 Someone", s["mit-grant"], s["mit-notice"], s["mit-as-is"] + "  " + s["mit-liability"]])
    apache = s["apache-header"] + " " + s["apache-copy"] + "\n\n    http://example.org/x\n\n" + s["apache-as-is"] + " " + s["apache-see"]
    gpl = "This program is free software: " + " ".join(s[x] for x in ("gpl-free", "gpl-hope", "gpl-see"))

    def wrapped(text, width, mark="", end="\n"):
        lines = [x for p in text.split("\n\n") for x in [*textwrap.wrap(p, width, break_long_words=False), ""]]
        return end.join(mark + x for x in lines)
    texts = [wrapped(mit, 72), wrapped(mit, 78, "# "), wrapped(mit, 30, " * ", "\r\n"), wrapped(apache, 70, "// "), wrapped(apache, 44),
             wrapped(gpl, 75, "# "), wrapped(gpl, 8)]
    got = found(spark, texts + [
        "Licensed\nunder CC BY 4.0.", "Licensed\n\nunder CC BY 4.0.", "# Licensed\n#\n# under CC BY 4.0.", "Licensed.\nunder CC BY 4.0.",
        "SomeTool\n" + wrapped(s["isc-grant"], 60), "Licensed under\nCC BY-NC 4.0 terms."])
    names = ["mit-name", "mit-grant", "mit-notice", "mit-as-is", "mit-liability"]
    for i in range(3):
        assert got[i][0] == ["MIT"] and [n for _, n in got[i][1]] == names
    for i in (3, 4):
        assert got[i][0] == ["Apache-2.0"] and [n for _, n in got[i][1]] == ["apache-header", "apache-copy", "apache-as-is", "apache-see"]
    for i in (5, 6):
        assert got[i][0] == ["GPL-3.0-or-later"] and len(got[i][1]) == 3
    assert got[7] == (["CC-BY-4.0"], [(0, "cc-by")]) and got[8] == got[9] == got[10] == got[12] == ([], [])
    assert got[11] == (["ISC"], [(1, "isc-grant")])


def test_a_sentence_behind_very_many_marks(spark):
    got = found(spark, ["=" * 5000 + " " + SENTENCES["mit-short"], "Licensed" + " " * 3000 + "under CC BY 4.0."])
    assert got == {0: (["MIT"], [(0, "mit-short")]), 1: (["CC-BY-4.0"], [(0, "cc-by")])}


def test_every_rule_can_match(spark):
    got = found(spark, ["\n".join(SENTENCES[x] for x in ids) for _, ids in RULES])
    assert [got[i][0] for i in range(len(RULES))] == [[name] for name, _ in RULES]


def test_odd_documents_and_empty_tables(spark, odd, empty):
    rows = recognise(odd)
    assert len(rows.columns) == len({c.lower() for c in rows.columns})
    assert all(r["licenses"] == [] and r["license_sentences"] == [] for r in rows.collect())
    assert rows.count() == odd.count() and recognise(empty).count() == 0
