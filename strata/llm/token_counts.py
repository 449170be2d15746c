"""Exact token counts of a corpus, for every context limit at once.

Documents are encoded and aggregated by length, so all that is kept of the
corpus is its length histogram. Suffix sums over the histogram then answer, for
any limit L: documents and tokens of at least L, the total after truncation to
L, and quantiles.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import keep, pick, python_ready
from strata.llm.tokens import encoder

# lengths per bucket of the two-step suffix sums
BUCKET = 1024


def lengths(docs: DataFrame, vocabulary: str, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``(doc_id, length)`` per row; a null or empty text has length 0."""
    python_ready(docs.sparkSession, 256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            n = enc.count([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())],
                                             ["doc_id", "length"])

    src = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return src.mapInArrow(run, "doc_id long, length long")


def histogram(docs: DataFrame, vocabulary: str, **columns: str) -> DataFrame:
    """``(length, n_docs)`` over all rows."""
    return (lengths(docs, vocabulary, **columns).groupBy("length")
            .agg(F.count("*").alias("n_docs")))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """One row per length L that occurs, from a table ``(length, n_docs)``:

    - n_docs, n_tokens: documents of length L and their tokens,
    - docs_at_least, tokens_at_least: of length L and more,
    - truncated_total: tokens left after truncation to L,
    - share_upto: share of all documents with length <= L (its inverse is the
      quantile function).

    Sums go over buckets of lengths first and within buckets then, so no task
    gets more than a bucket or the list of buckets. An empty table gives an
    empty result."""
    # 0.. is a document of no tokens; the bucket list has max length / BUCKET rows
    h = hist.select("length", "n_docs", (F.col("length") * F.col("n_docs")).alias("n_tokens"),
                    F.floor(F.col("length") / BUCKET).alias("bucket"))
    buckets = h.groupBy("bucket").agg(F.sum("n_docs").alias("d"), F.sum("n_tokens").alias("t"))
    above = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding,
                                                         Window.unboundedFollowing)
    tops = buckets.select(
        "bucket", F.coalesce(F.sum("d").over(above), F.lit(0)).alias("d_above"),
        F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t_above"),
        F.sum("d").over(whole).alias("docs"), F.sum("t").over(whole).alias("tokens"))
    here = (Window.partitionBy("bucket").orderBy(F.desc("length"))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    j = h.join(tops, "bucket")
    d = F.col("d_above") + F.sum("n_docs").over(here)
    t = F.col("t_above") + F.sum("n_tokens").over(here)
    return j.select(
        "length", "n_docs", "n_tokens", d.alias("docs_at_least"), t.alias("tokens_at_least"),
        (F.col("tokens") - t + F.col("length") * d).alias("truncated_total"),
        ((F.col("docs") - d + F.col("n_docs")) / F.col("docs")).alias("share_upto"))


def token_counts(docs: DataFrame, vocabulary: str, **columns: str) -> DataFrame:
    """``suffix_sums`` of the documents' histogram."""
    return suffix_sums(keep(histogram(docs, vocabulary, **columns), "lengths"))


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """``(context, documents, tokens, truncated_total, docs_cut)`` for any list
    of context limits, from ``suffix_sums``: documents are cut if longer."""
    total = sums.agg(F.sum("n_docs").alias("documents"), F.sum("n_tokens").alias("tokens"))
    each = sums.select("length", "n_docs", "n_tokens", F.explode(
        F.array(*[F.lit(int(x)).cast("long") for x in limits])).alias("context"))
    longer: Column = F.col("length") > F.col("context")
    return (each.groupBy("context")
            .agg(F.sum(F.when(longer, F.col("n_docs") * F.col("context")).otherwise(F.col("n_tokens")))
                 .alias("truncated_total"),
                 F.sum(F.when(longer, F.col("n_docs")).otherwise(0)).alias("docs_cut"))
            .join(total).select("context", "documents", "tokens", "truncated_total", "docs_cut"))


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """``(share, length)``: the smallest length that at least this share of the
    documents does not exceed."""
    each = sums.select("length", "share_upto", F.explode(
        F.array(*[F.lit(float(s)) for s in shares])).alias("share"))
    return each.where("share_upto >= share").groupBy("share").agg(F.min("length").alias("length"))
