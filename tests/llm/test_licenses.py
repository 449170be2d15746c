import textwrap

import pytest

from oracle_compare import duck, duck_digest, spark_digest
from strata.llm import licenses as L
from strata.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"


def test_query_matches_oracle(spark):
    got = spark_digest(QUERIES["op7_license_scan"](spark, SF))
    assert got == duck_digest(duck(SF), ORACLE_SQL["op7_license_scan"])


@pytest.mark.parametrize("a, b", [
    ("Licensed under the Apache License, Version 2.0.", "LICENSED  under the apache licence -- version 2.0"),
    ("Copyright 2020 Someone\nReleased under the MIT License.", "released under the MIT\nlicense"),
    ("(c) x\n\u00a9 y\nwilful labour", "  willful; LABOR  "), ("", "Copyright (C) all"),
])
def test_equal_forms(spark, a, b):
    df = spark.createDataFrame([(a,), (b,)], "t string").select(L.canonical(L.F.col("t")).alias("c"))
    x, y = [r.c for r in df.collect()]
    assert x == y


def test_scan(spark):
    mit, apache = "Released under the MIT Licence!", "licensed under the APACHE License version 2.0"
    isc = next(t for k, t in L.KNOWN if k == "ISC")
    rows = [(1, mit, 0), (2, f"text\n{mit}\nmore\n{apache}\n{mit}", 0), (3, None, 0), (4, "", 0),
            (5, f"not {mit}", 0), (6, "Copyright (c) 1999 X\n\n" + isc.replace(". ", ".\n").lower(), 0),
            (7, f"{mit}\n", 0), (7, f"{mit}\n", 0), (None, apache, 0), (8, "w " * 60000 + "\n" + apache, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, license int")
    got = sorted((r.doc_id or 0, r.text_license, r.n_license_lines, r.licenses) for r in L.scan(df).collect())
    assert got == sorted([
        (1, "MIT", 1, "MIT"), (2, None, 3, "Apache-2.0,MIT"), (3, None, 0, ""), (4, None, 0, ""), (5, None, 0, ""),
        (6, "ISC", 0, "ISC"), (7, "MIT", 1, "MIT"), (7, "MIT", 1, "MIT"), (0, "Apache-2.0", 1, "Apache-2.0"),
        (8, None, 1, "Apache-2.0")], key=lambda r: r[0])
    assert L.scan(df.limit(0)).count() == 0


def test_known_texts_can_be_a_table(spark):
    known = spark.createDataFrame([("B", "Some terms."), ("A", "some TERMS"), ("C", None), ("D", "...")],
                                  "license string, text string")
    df = spark.createDataFrame([(1, "some terms"), (2, "!!")], "doc_id long, text string")
    got = {r.doc_id: r.text_license for r in L.scan(df, known).collect()}
    assert got == {1: "A", 2: None}
    none = L.scan(df, known.limit(0)).collect()
    assert len(none) == 2 and not any(r.licenses for r in none)


def test_wrapped_notices_and_entire_licences_inside_longer_texts(spark):
    text = dict(L.stored_texts()[::-1])  # of each licence the first, the stored file
    mpl = next(t for k, t in L.KNOWN if k == "MPL-2.0")
    apache = text["Apache-2.0"]
    wrapped = "\n".join(textwrap.wrap(mpl, 70))
    comment = "/*\n * Copyright (c) 2020 X\n *\n" + "".join(f" * {x}\n" for x in text["MIT"].splitlines()) + " */\nint x;"
    rows = [
        (1, f"# Title\n{wrapped}\ncode();", "MPL-2.0"), (2, comment, "MIT"),
        (3, "Some words.\n\n" + text["GPL-3.0-only"] + "\nmore words", "GPL-3.0-only"),
        (4, "x\n" + "\n".join(textwrap.wrap(" ".join(apache.split()), 61)) + "\ny", "Apache-2.0"),
        (5, "x\n" + apache.replace("[yyyy] [name of copyright owner]", "2020 Someone") + "\ny", "Apache-2.0"),
        (6, "text\nReleased under\nthe MIT License.\nmore\n" + text["BSD-3-Clause"], "BSD-3-Clause,MIT"),
        (7, "not Released under\nthe MIT License.\n", ""), (8, "Released under\nthe MIT License. Not so", ""),
        (9, "<p>" + " ".join(text["MIT"].split()) + "</p>", "MIT"),
        (10, text["MIT"].replace("publish, ", ""), ""), (11, text["LGPL-2.1-only"], "LGPL-2.1-only"),
        (12, "The ISC License\n\nCopyright 2020 X\n\n" + next(t for k, t in L.KNOWN if k == "ISC") + "\ncode", "ISC"),
        (13, "word " * 40_000 + "\n" + text["MPL-2.0"] + "\n" + "word " * 40_000, "MPL-2.0"),
        (14, "\n".join(["word"] * 13_103) + "\n" + wrapped, "MPL-2.0")]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {r.doc_id: r for r in L.scan(df).collect()}
    assert {i: r.licenses for i, r in got.items()} == {r[0]: r[2] for r in rows}
    assert got[1].n_license_lines == 0 and got[11].text_license == "LGPL-2.1-only" and got[3].text_license is None


def test_every_stored_text_is_found(spark):
    texts = L.stored_texts()
    df = spark.createDataFrame([(i, f"head\n{t}\ntail") for i, (_, t) in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in L.scan(df).collect()}
    assert got == {i: k for i, (k, _) in enumerate(texts)}
    assert {"MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-only", "GPL-3.0-only", "LGPL-2.1-only",
            "LGPL-3.0-only", "MPL-2.0", "ISC"} <= {k for k, _ in texts}
