"""Secrets in texts, with their ownership across the corpus.

Candidates are matches of a few patterns. Their values are hashed, and the
hashes aggregated over the whole corpus by distinct repositories and owners: a
value seen under many owners is a widely copied example, and so is one that two
owners hold in many repositories; one that stays with an owner, or with two in
few repositories, looks live. However often an owner repeats a value of their
own, it is theirs. Spans of the base patterns always stand; a span of the wider
pattern is added only where its value looks live.

All of it is DataFrame expressions. Positions come from the lengths of the
texts between matches, summed up in a window over one row's matches of one
kind. A value in a third of all rows is reduced to its distinct (owner,
repository) pairs on the map side before any shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import keep, pick


@dataclass(frozen=True)
class Kind:
    """``group`` of a match is the secret's value and needs ``least`` characters."""
    name: str
    pattern: str
    group: int
    least: int


# The base patterns. Runs shorter than a kind's least length are
# left out by the pattern itself where that finds the same matches.
ASSIGN = Kind("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                        r"([A-Za-z0-9+/_.=-]+)", 2, 6)
ACCESS = Kind("access", r"AKIA[A-Z0-9]{16,}", 0, 20)
HEX = Kind("hex", r"(?<![0-9a-f])[0-9a-f]{24,}", 0, 24)
BASE = (ASSIGN, ACCESS, HEX)

# the wider pattern of the method, and what makes such a value look random
OWNED = Kind("owned", r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}", 0, 20)
DISTINCT_CHARS = 10
# a value under so many owners or more is a copied example, and one of several
# owners in so many repositories or more
EXAMPLE_OWNERS = 3
EXAMPLE_REPOSITORIES = 5

KEY = ("doc_id", "h1", "h2")


def _same(a: str, b: str) -> Column:
    """A row's identity: its doc_id and two hashes of its text."""
    out = F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id"))
    for k in KEY[1:]:
        out = out & (F.col(f"{a}.{k}") == F.col(f"{b}.{k}"))
    return out


def _matches(kind: Kind) -> Column:
    """Array of (gap, size, value) of one kind's matches, null without any:
    gap is the length of the text between the match before and this one."""
    text, pattern = F.col("text"), F.lit(kind.pattern)
    gaps = F.transform(F.split(text, kind.pattern, -1), lambda x: F.length(x))
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    value = F.regexp_extract_all(text, pattern, F.lit(kind.group)) if kind.group else whole
    rows = F.zip_with(F.slice(gaps, F.lit(1), F.size(whole)), F.arrays_zip(whole.alias("m"), value.alias("v")),
                      lambda g, x: F.struct(g.cast("long").alias("gap"),
                                            F.length(x["m"]).cast("long").alias("size"),
                                            x["v"].alias("value")))
    return F.when(text.rlike(kind.pattern), rows)


def candidates(docs: DataFrame, owner: Column, repository: Column, id_col: str = "doc_id",
               text_col: str = "text", kinds: tuple[Kind, ...] = (*BASE, OWNED)) -> DataFrame:
    """``(doc_id, h1, h2, owner, repository, kind, start, end, value)``: the
    matches with long enough values, in code points, end exclusive. ``owner``
    and ``repository`` are expressions over the columns of ``docs``.

    Repeated rows (same doc_id and text) give their matches once for each
    owner and repository they have."""
    tagged = docs.select("*", owner.cast("string").alias("__owner"),
                         repository.cast("string").alias("__repository"))
    src = pick(tagged, doc_id=id_col, text=text_col, owner="__owner", repository="__repository")
    src = src.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h1"),
                     F.hash("text").alias("h2"), "owner", "repository", "text")
    found = F.filter(F.array(*[F.struct(F.lit(k.name).alias("kind"), _matches(k).alias("rows"))
                               for k in kinds]), lambda x: x["rows"].isNotNull())
    each = (src.select(*KEY, "owner", "repository", F.explode(found).alias("f"))
            .select(*KEY, "owner", "repository", "f.kind", F.posexplode("f.rows").alias("place", "r"))
            .dropDuplicates([*KEY, "owner", "repository", "kind", "place"]))
    upto = (Window.partitionBy(*KEY, "owner", "repository", "kind").orderBy("place")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    end = F.sum(F.col("r.gap") + F.col("r.size")).over(upto)
    least = F.coalesce(*[F.when(F.col("kind") == k.name, F.lit(k.least)) for k in kinds])
    random = (F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")
              & (F.size(F.array_distinct(F.split("value", ""))) >= DISTINCT_CHARS))
    return (each.select(*KEY, "owner", "repository", "kind", (end - F.col("r.size")).alias("start"),
                        end.alias("end"), F.col("r.value").alias("value"))
            .where(F.length("value") >= least)
            .where((F.col("kind") != OWNED.name) | random))


def ownership(found: DataFrame) -> DataFrame:
    """``(digest, n_owners, n_repositories)`` of every candidate value, over
    all rows; a repository is one owner's. Null owners count as one owner."""
    return (found.select(F.sha2("value", 256).alias("digest"), "owner", "repository").distinct()
            .groupBy("digest", "owner").agg(F.count("*").alias("n"))
            .groupBy("digest").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repositories")))


def findings(docs: DataFrame, owner: Column, repository: Column,
             example_owners: int = EXAMPLE_OWNERS, id_col: str = "doc_id",
             text_col: str = "text", overlapping: bool = False,
             example_repositories: int = EXAMPLE_REPOSITORIES) -> DataFrame:
    """``(doc_id, h1, h2, kind, start, end, digest, n_owners, n_repositories,
    live)``: all base spans, and the spans of the wider pattern that look live
    and, unless ``overlapping``, overlap no base span. live: under one owner, or
    under fewer than ``example_owners`` and in fewer repositories than
    ``example_repositories``."""
    found = keep(candidates(docs, owner, repository, id_col, text_col), "candidates")
    spread = (F.col("n_owners") > 1) & (F.col("n_repositories") >= example_repositories)
    known = ownership(found).withColumn("live", (F.col("n_owners") < example_owners) & ~spread)
    spans = (found.select(*KEY, "kind", "start", "end", F.sha2("value", 256).alias("digest")).distinct()
             .join(known, "digest"))
    base = F.col("kind") != OWNED.name
    if overlapping:
        return (spans.where(base | F.col("live"))
                .select(*KEY, "kind", "start", "end", "digest", "n_owners", "n_repositories", "live"))
    row = Window.partitionBy(*KEY).orderBy("start")
    before = F.max(F.when(base, F.col("end"))).over(
        row.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.min(F.when(base, F.col("start"))).over(
        row.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    clear = ((F.coalesce(before, F.lit(0)) <= F.col("start"))
             & (F.coalesce(after, F.col("end")) >= F.col("end")))
    return (spans.withColumn("clear", clear).where(base | (F.col("live") & F.col("clear")))
            .select(*KEY, "kind", "start", "end", "digest", "n_owners", "n_repositories", "live"))


def scan(docs: DataFrame, owner: Column, repository: Column, **options) -> DataFrame:
    """Per row of ``docs``: doc_id, h1, h2 and ``spans``, an array of (start,
    rank, end, kind, live, n_owners, n_repositories) by start and then the order
    of kinds; empty without any. Null and empty texts have none. Repeated rows get a row each."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    rank = F.coalesce(*[F.when(F.col("kind") == k.name, F.lit(i)) for i, k in enumerate((*BASE, OWNED))])
    spans = (findings(docs, owner, repository, **options)
             .groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct(
                 "start", rank.alias("rank"), "end", "kind", "live", "n_owners", "n_repositories"))).alias("spans")))
    rows = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h1"),
        F.hash("text").alias("h2"))
    none = F.array().cast("array<struct<start: bigint, rank: int, end: bigint, kind: string, live: boolean, "
                          "n_owners: bigint, n_repositories: bigint>>")
    return (rows.alias("r").join(spans.alias("s"), _same("r", "s"), "left")
            .select(*[f"r.{k}" for k in KEY], F.coalesce("s.spans", none).alias("spans")))


def redact(docs: DataFrame, owner: Column, repository: Column, mask: str = "[SECRET]",
           **options) -> DataFrame:
    """``docs`` with every span found replaced by ``mask`` and n_chars, where
    there is such a column, counted anew. Overlapping spans are masked as one,
    also a live wider span with the base spans in it. Every row stays."""
    names = list(docs.columns)
    at = names.index("text")
    spans = (findings(docs, owner, repository, overlapping=True, **options)
             .groupBy(*KEY).agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans")))
    flat = docs.toDF(*[f"c{i}" for i in range(len(names))])
    keyed = flat.select("*", F.col(f"c{names.index('doc_id')}").cast("long").alias("doc_id"),
                        F.xxhash64(f"c{at}").alias("h1"), F.hash(f"c{at}").alias("h2"))
    joined = keyed.alias("r").join(spans.alias("s"), _same("r", "s"), "left")
    text = F.col(f"r.c{at}")
    parts = F.aggregate(
        "s.spans", F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).cast("long").alias("to")),
        lambda acc, x: F.when(x["end"] <= acc["to"], acc).otherwise(F.struct(
            F.when(x["start"] < acc["to"], acc["out"]).otherwise(F.concat(acc["out"], F.array(
                F.substring(text, (acc["to"] + 1).cast("int"), (x["start"] - acc["to"]).cast("int")),
                F.lit(mask)))).alias("out"), x["end"].alias("to"))))
    masked = F.concat(F.array_join(parts["out"], ""),
                      F.substring(text, (parts["to"] + 1).cast("int"), F.length(text)))
    new = F.when(F.col("s.spans").isNull(), text).otherwise(masked)
    out = joined.select(*[new.alias(f"c{i}") if i == at else F.col(f"r.c{i}") for i in range(len(names))])
    if "n_chars" in names:
        n = names.index("n_chars")
        kind = docs.schema.fields[n].dataType
        out = out.withColumn(f"c{n}", F.when(F.col(f"c{at}").isNull(), F.col(f"c{n}"))
                             .otherwise(F.length(f"c{at}")).cast(kind))
    return out.toDF(*names)
