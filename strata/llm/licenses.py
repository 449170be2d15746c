"""Licence texts found by canonical digest.

A text is reduced to a canonical form: copyright lines go, A-Z become a-z,
punctuation and white space become single blanks, and equivalent spellings one
of them. Its SHA-256 is hash-joined to the digests of known licence texts:
short notices, and the entire texts in ``license_texts``. The units are whole
documents, each of their lines, and runs of lines: wherever a line begins as a
known form does, as much text as that form has. A form of LOOSE words or more
may also begin and end within a line. Every unit is compared entire, never by a
part.

Runs are looked for in the texts that hold the first words of a known form;
each form is tried with and without the lines that name a copyright's holder,
so it does not matter how a text is wrapped. A licence that names its holder
in mid-text, or has other words between its lines, is found in its stored
wordings only.
"""

from __future__ import annotations

import hashlib
import json
import re
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import keep, lower_ascii, pick

# Licence notices by SPDX identifier.
KNOWN = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
                "If a copy of the MPL was not distributed with this file, You can obtain one at "
                "https://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
            "without fee is hereby granted, provided that the above copyright notice and this "
            "permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR "
            "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
            "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
            "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
            "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
            "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
]

# Titles that usually stand above a stored text without one.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "All rights reserved."),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "BSD License", "All rights reserved."),
    "ISC": ("ISC License", "The ISC License"), "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"),
    "Zlib": ("zlib License", "The zlib License"),
}

# Words that count as the same, in canonical form.
EQUIVALENT = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze",
    "artefact": "artifact", "authorisation": "authorization", "authorised": "authorized",
    "cancelled": "canceled", "capitalisations": "capitalizations", "catalogue": "catalog",
    "categorise": "categorize", "centre": "center", "emphasised": "emphasized", "favour": "favor",
    "favourite": "favorite", "fulfil": "fulfill", "initialise": "initialize", "judgement": "judgment",
    "labelling": "labeling", "labour": "labor", "licence": "license", "licenced": "licensed",
    "maximise": "maximize", "modelled": "modeled", "modelling": "modeling", "offence": "offense",
    "optimise": "optimize", "organisation": "organization", "organise": "organize",
    "practise": "practice", "programme": "program", "realise": "realize", "recognise": "recognize",
    "signalling": "signaling", "utilisation": "utilization", "whilst": "while", "wilful": "willful",
}

# a line that begins so names the holder of a copyright; it is in no canonical form
COPYRIGHT_LINE = r"(?i)^[\x20\t]*(copyright|\(c\)|\xA9)"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# the same behind the marks of a comment, for runs; and any such line in a text
HOLDER_LINE = r"(?i)^[\x20\t*#/;%|!<>-]*(copyright|\(c\)|\xA9)"
ANY_HOLDER = "(?imd)" + HOLDER_LINE[4:]

# a form of so many words is no part of another sentence: it may stand anywhere
LOOSE = 20
# first words of a form by which its places are looked up, at most
LEAD = 6
# characters searched for runs at once, besides the longest form
BLOCK = 1 << 16


def stored_texts() -> list[tuple[str, str]]:
    """``(license, text)`` of the stored licences. Each is known as it is,
    without what follows its terms, without what precedes them, with its usual
    titles and without numbers before its items."""
    out = []
    folder = resources.files("strata.llm") / "license_texts"
    for f in sorted(folder.iterdir(), key=lambda x: x.name):
        name, text = f.name.removesuffix(".txt").partition("+")[0], f.read_text(encoding="utf-8")
        texts = [text]
        if end := re.search(r"(?m)^ *END OF TERMS AND CONDITIONS *$", text):
            terms = re.search(r"(?m)^ *TERMS AND CONDITIONS", text)
            texts += [text[:end.end()], text[terms.start():end.end()]]
        if name.startswith("BSD-"):
            texts += [re.sub(r"(?m)^ *\d\. ", "", t) for t in texts]
            texts += [t.replace("COPYRIGHT\nHOLDER OR", "COPYRIGHT\nOWNER OR") for t in texts]
        titles = TITLES.get(name, ())
        out += [(name, t) for t in dict.fromkeys([*texts, *[f"{x}\n{t}" for x in titles for t in texts]])]
    isc = next(t for k, t in KNOWN if k == "ISC")
    bodies = [isc, isc.replace("and/or distribute", "and distribute")]
    return out + [("ISC", t) for t in [*bodies, *[f"{x}\n{t}" for x in TITLES["ISC"] for t in bodies]]]


def canonical(text: Column) -> Column:
    """The canonical form of one text; a null stays null."""
    return _form(F.array_join(F.filter(F.split(text, "\n", -1), lambda x: ~x.rlike(COPYRIGHT_LINE)), "\n"))


def _form(text: Column) -> Column:
    """The canonical form of a text, no line left out."""
    words = F.concat(F.lit(" "), F.regexp_replace(lower_ascii(text), SEPARATORS, " "), F.lit(" "))
    return F.trim(F.regexp_replace(_spelt(words), r"\x20+", " "))


def _without_holders(text: Column) -> Column:
    return F.array_join(F.filter(F.split(text, "\n", -1), lambda x: ~x.rlike(HOLDER_LINE)), "\n")


def _in_lines(text: Column) -> Column:
    """The canonical form with a line break, not a blank, between two lines,
    before the first and after the last: as many characters as the form has."""
    marked = F.regexp_replace(lower_ascii(text), SEPARATORS.replace(r"\x00-", r"\x00-\x09\x0B-"), " ")
    words = F.concat(F.lit(" "), F.replace(marked, F.lit("\n"), F.lit(" \n ")), F.lit(" "))
    lines = F.regexp_replace(F.regexp_replace(_spelt(words), r"\x20*\n[\x20\n]*", "\n"), r"\x20+", " ")
    return F.concat(F.lit("\n"), F.btrim(lines, F.lit(" \n")), F.lit("\n"))


def _spelt(words: Column) -> Column:
    """Words between blanks, equivalent ones replaced."""
    variants = F.create_map(*[F.lit(x) for pair in EQUIVALENT.items() for x in pair])
    some = r"\x20(" + "|".join(EQUIVALENT) + r")\x20"

    def spelt(w: Column) -> Column:
        changed = F.array_join(F.transform(F.split(w, " ", -1), lambda x: F.coalesce(
            F.element_at(variants, x), x)), " ")
        return F.when(w.rlike(some), changed).otherwise(w)

    # a lambda's argument is evaluated once, however often it is used
    return F.transform(F.array(words), spelt)[0]


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def known_digests(spark: SparkSession, known: DataFrame | None = None) -> DataFrame:
    """``(digest, license)`` of known texts, a table (license, text); by default
    the notices above and the stored texts. Of texts with one canonical form the
    first licence by name counts; texts that are null or have an empty form are
    left out."""
    src = _known(spark, known)
    return (src.where(canonical(F.col("text")) != "").groupBy(digest(F.col("text")).alias("digest"))
            .agg(F.min("license").alias("license")))


def _known(spark: SparkSession, known: DataFrame | None) -> DataFrame:
    return (pick(known, license="license", text="text") if known is not None
            else _table(spark, KNOWN + stored_texts(), "license string, text string"))


def _table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table from one literal."""
    kind = T.ArrayType(T._parse_datatype_string(schema))
    text = json.dumps([dict(zip(kind.elementType.names, r)) for r in rows])
    return spark.range(1, numPartitions=1).select(F.inline(F.from_json(F.lit(text), kind)))


def known_forms(spark: SparkSession, known: DataFrame | None = None) -> list[tuple[str, str, bool]]:
    """``(form, license, canonical)`` of known texts: their canonical forms, and
    (canonical false) their further ones for runs, with every line and without
    the lines of HOLDER_LINE. They come to the driver."""
    text = F.col("text")
    each = _known(spark, known).select("license", F.explode(F.array(*[
        F.struct(f.alias("form"), F.lit(c).alias("canonical"))
        for f, c in ((canonical(text), True), (_form(text), False), (_form(_without_holders(text)), False))
    ])).alias("f")).where("f.form <> '' and license is not null")
    rows = each.groupBy("f.form").agg(F.max("f.canonical"), F.min(F.when(F.col("f.canonical"), F.col("license"))),
                                      F.min("license")).collect()
    return sorted((r[0], r[2] if r[1] else r[3], r[1]) for r in rows)


def scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Per row: doc_id, canonical_sha256 (of the whole text), text_license
    (of the whole text, else null), n_license_lines (lines that are a known
    text), and licenses (of the whole text, its lines and its runs of lines:
    distinct, sorted, comma-joined; empty without any).

    A null text counts as empty: it has the digest of the empty form and no
    licence. Repeated rows get a row each. Lines and runs are looked for in
    the texts with a known form's first words, and in those with a line that
    names a holder."""
    spark = docs.sparkSession
    forms = known_forms(spark, known)
    leads = _leads([f for f, _, _ in forms])
    digests = F.broadcast(_table(spark, [(_sha(f), k) for f, k, c in forms if c],
                                 "digest string, license string"))
    src = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    key = [F.col("doc_id"), F.xxhash64("text").alias("h1"), F.hash("text").alias("h2")]
    text, named = F.col("text"), F.col("text").rlike(ANY_HOLDER)
    may = r"(?:^|\x20)(?:" + "|".join(leads) + r")(?:\x20|$)"
    seen = F.transform(F.array(_form(text)), lambda f: F.struct(
        F.sha2(F.when(named, canonical(text)).otherwise(f).cast("binary"), 256).alias("digest"),
        (named | f.rlike(may) if leads else F.lit(False)).alias("may")))[0]
    judged = keep(src.select(*key, "text", seen.alias("s")).select(
        "doc_id", "h1", "h2", F.col("s.digest").alias("canonical_sha256"),
        F.when(F.col("s.may"), text).alias("text")), "canonical")
    some = judged.where("text is not null").select("doc_id", "h1", "h2", "text")
    lines = some.select("doc_id", "h1", "h2", F.posexplode(F.split("text", "\n", -1)).alias("place", "line")).select(
        "doc_id", "h1", "h2", "place", digest(F.col("line")).alias("digest"))
    found = lines.join(digests, "digest").select("doc_id", "h1", "h2", "place", "license").distinct()
    found = (found.groupBy("doc_id", "h1", "h2", "license").agg(F.count("*").alias("n"))
             .union(_runs(some, forms, leads).withColumn("n", F.lit(0).cast("long"))))
    per = found.groupBy("doc_id", "h1", "h2").agg(F.sum("n").alias("n"), F.collect_set("license").alias("in_lines"))
    whole = judged.alias("r").join(digests.alias("k"), F.col("r.canonical_sha256") == F.col("k.digest"), "left")
    whole = whole.select("r.doc_id", "r.h1", "r.h2", "r.canonical_sha256", F.col("k.license").alias("text_license"))
    out = whole.alias("w").join(per.alias("p"), _same("w", "p"), "left")
    names = F.array_sort(F.array_distinct(F.filter(F.concat(
        F.coalesce("p.in_lines", F.array().cast("array<string>")), F.array("w.text_license")),
        lambda x: x.isNotNull())))
    return out.select("w.doc_id", "w.canonical_sha256", "w.text_license",
                      F.coalesce("p.n", F.lit(0)).cast("long").alias("n_license_lines"),
                      F.array_join(names, ",").alias("licenses"))


def _sha(form: str) -> str:
    return hashlib.sha256(form.encode()).hexdigest()


def _lead(form: str) -> str:
    return " ".join(form.split(" ")[:LEAD])


def _leads(forms: list[str]) -> dict[str, int]:
    """Characters of the longest form of each lead, the longest first: the
    first lead that a place begins with has the most text to look at."""
    longest: dict[str, int] = {}
    for f in forms:
        longest[_lead(f)] = max(longest.get(_lead(f), 0), len(f))
    return dict(sorted(longest.items(), key=lambda x: (-x[1], x[0])))


def _runs(some: DataFrame, forms: list[tuple[str, str, bool]], leads: dict[str, int]) -> DataFrame:
    """``(doc_id, h1, h2, license)``: licences whose forms are runs of the
    texts. Texts are searched in overlapping blocks, so the work grows with
    their length; a licence may be found in two of them and counts once."""
    spark = some.sparkSession
    schema = "lead string, chars int, loose boolean, digest string, license string"
    table = F.broadcast(_table(spark, [
        (_lead(f), len(f), f.count(" ") + 1 >= LOOSE, _sha(f), k) for f, k, _ in forms], schema))
    if not forms:
        return spark.createDataFrame([], some.select("doc_id", "h1", "h2", F.lit("").alias("license")).schema)
    text, over = F.col("text"), max(leads.values()) + 2
    streams = F.array_distinct(F.array(_in_lines(text), _in_lines(F.when(
        text.rlike(ANY_HOLDER), _without_holders(text)).otherwise(text))))
    blocks = F.flatten(F.transform(streams, lambda s: F.transform(
        F.sequence(F.lit(0), F.floor(F.length(s) / BLOCK).cast("int")),
        lambda k: F.substr(s, k * BLOCK + 1, F.lit(BLOCK + over)))))
    # a place's text with the character before and the one after it
    place = "(?s)(?=([\\x20\n](?:" + "|".join(
        f"{k.replace(' ', '[\\x20\n]')}(?=[\\x20\n]).{{0,{n + 1 - len(k)}}}" for k, n in leads.items()) + ")))"
    at = (some.select("doc_id", "h1", "h2", F.explode(blocks).alias("block"))
          .select("doc_id", "h1", "h2", F.explode(F.regexp_extract_all("block", F.lit(place), F.lit(1))).alias("t"))
          .select("doc_id", "h1", "h2", F.substr("t", F.lit(1), F.lit(1)).alias("before"),
                  F.substr("t", F.lit(2)).alias("lines"), F.translate(F.substr("t", F.lit(2)), "\n", " ").alias("t")))
    first = F.array_distinct(F.array(*[F.substring_index("t", " ", n) for n in range(1, LEAD + 1)]))
    tried = at.select("*", F.explode(first).alias("lead")).join(table, "lead")
    after = F.substr("lines", F.col("chars") + 1, F.lit(1))
    aligned = (F.col("before") == "\n") & (after == "\n")
    return (tried.where(aligned | (F.col("loose") & after.isin(" ", "\n")))
            .where(F.sha2(F.substr("t", F.lit(1), F.col("chars")).cast("binary"), 256) == F.col("digest"))
            .select("doc_id", "h1", "h2", "license").distinct())


def _same(a: str, b: str) -> Column:
    return (F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id"))
            & (F.col(f"{a}.h1") == F.col(f"{b}.h1")) & (F.col(f"{a}.h2") == F.col(f"{b}.h2")))
