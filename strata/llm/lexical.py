"""Ranked lexical search by length-ordered buckets of impact vectors.

A document is a vector: for each term of the queries that it holds, the
integer that the term adds to its score (its impact). A query is the 0/1 vector
of its terms, so a score is an inner product and the ten best documents are a
top-k join of two sets of vectors:

* vectors are ordered by length and cut into buckets. By Cauchy-Schwarz no
  document of a bucket scores above sqrt(terms of the query) times the
  bucket's greatest length; a query whose ten best are all higher skips it;
* inside a bucket, bounds by coordinate: the greatest impact of each term in
  the bucket. Terms whose greatest impacts add up to less than the tenth score
  cannot lift a document alone, so only postings of the other terms (the focus)
  are walked; their sum plus the least of both bounds of the rest decides which
  documents survive;
* survivors are scored exactly, in 64-bit integers.

Lengths and bounds are doubles, widened by far more than their rounding, so
nothing that belongs to the result is pruned.

The longest vectors of the corpus are searched first, everywhere at once, and
give each query a score to start from for all the others. Documents stay in the
partitions in which they were read: a task orders its own. Queries are dealt
into blocks of a stated size, each brought to the driver and broadcast; what a
task returns is at most ``top`` rows a query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import by_size, discard, keep, pick, python_ready
from strata.llm.decontaminate import words_of
from strata.sources.local import config_frame

TOP = 10
# terms of the queries that one pass over the documents handles, about
BLOCK_TERMS = 200_000
# documents and terms of a bucket, at most (but for one longer document)
BUCKET_ROWS, BUCKET_TERMS = 4096, 1 << 20
# share of the documents that are searched first
HEAD = 1 / 16
# a double sum of positive addends is right to far less than this share
SLACK = 1e-9
# text that is cut into words at once, bytes
TEXT_BYTES = 8 << 20


def query_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(item_id, terms)``, a row per item: its distinct terms, sorted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(w.decode() for w in set(words_of(t)))
                     for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.string()))], ["item_id", "terms"])

    src = pick(items, item_id=id_col, text=text_col).withColumn("item_id", F.col("item_id").cast("long"))
    return src.mapInArrow(run, "item_id long, terms array<string>")


def _projected(docs: DataFrame, vocabulary) -> DataFrame:
    """``(doc_id, n, terms, tfs)``: all terms of a document with repeats, and
    which terms of the vocabulary it holds how often."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        width = max(1, len(number))
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0))
            for a, b in by_size(sizes, TEXT_BYTES):
                n, found = [], []
                for text in texts.slice(a, b - a).to_pylist():
                    words = words_of(text)
                    n.append(len(words))
                    mine = [number[w] for w in words if w in number]
                    found.append(np.array(mine, np.int64))
                row = np.repeat(np.arange(b - a), [len(x) for x in found])
                key, tf = np.unique(row * width + np.concatenate(found), return_counts=True)
                ends = np.searchsorted(key, np.arange(b - a + 1) * width).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n, pa.int64()),
                     pa.ListArray.from_arrays(ends, pa.array((key % width).astype(np.int32))),
                     pa.ListArray.from_arrays(ends, pa.array(tf.astype(np.int32)))],
                    ["doc_id", "n", "terms", "tfs"])

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column one after another, and where each row begins
    (with the end of the last)."""
    offsets = lists.offsets.to_numpy()
    return lists.flatten().to_numpy(), offsets - offsets[0]


def _document_counts(projected: DataFrame, width: int) -> dict[int, int]:
    """How many documents hold each term; counted per task in one vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(width, np.int64)
        for batch in batches:
            seen += np.bincount(_flat(batch.column(0))[0], minlength=width)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["term", "df"])

    counted = projected.select("terms").mapInArrow(run, "term long, df long")
    return {r.term: r.df for r in counted.groupBy("term").agg(F.sum("df").alias("df")).collect()}


def weight(n_docs: int, df: int) -> int:
    """A term's weight."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _vectors(projected: DataFrame, weights: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """``(doc_id, length, terms, impacts)`` of the documents that score at all."""
    sent = projected.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = sent.value
            n = batch.column(1).to_numpy()
            terms, ends = _flat(batch.column(2))
            tf = _flat(batch.column(3))[0].astype(np.int64)
            m = 100 - 90 + (90 * n * n_docs) // max(1, n_terms)
            impacts = w[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, np.diff(ends))))
            square = np.concatenate(([0.0], impacts.astype(float) ** 2))
            # sums by row; a difference of running sums would lose what is small
            row = np.repeat(np.arange(len(n)), np.diff(ends))
            length = np.sqrt(np.bincount(row, square[1:], len(n)))
            ends = pa.array(ends.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(length),
                 pa.ListArray.from_arrays(ends, pa.array(terms.astype(np.int32))),
                 pa.ListArray.from_arrays(ends, pa.array(impacts))],
                ["doc_id", "length", "terms", "impacts"])

    return (projected.mapInArrow(run, "doc_id long, length double, terms array<int>, impacts array<bigint>")
            .where("length > 0"))


class Best:
    """The best documents of a query so far: score, then ascending doc_id,
    documents without one last."""

    def __init__(self, top: int, least: int):
        self.top, self.least = top, least  # nothing below ``least`` is wanted
        self.score, self.unknown, self.doc = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, score: np.ndarray, unknown: np.ndarray, doc: np.ndarray) -> None:
        score = np.concatenate((self.score, score))
        unknown, doc = np.concatenate((self.unknown, unknown)), np.concatenate((self.doc, doc))
        if len(score) > 4 * self.top:  # all ties of the last place stay in
            edge = np.partition(score, len(score) - self.top)[len(score) - self.top]
            up = score >= edge
            score, unknown, doc = score[up], unknown[up], doc[up]
        order = np.lexsort((doc, unknown, -score))[:self.top]
        self.score, self.unknown, self.doc = score[order], unknown[order], doc[order]
        if len(order) == self.top:
            self.least = max(self.least, int(self.score[-1]))


def search_bucket(queries: list[np.ndarray], best: list[Best], doc: np.ndarray, unknown: np.ndarray,
                  length: np.ndarray, terms: np.ndarray, ends: np.ndarray, impacts: np.ndarray) -> dict:
    """Search one bucket for all queries; returns how many (query, document)
    pairs each step left."""
    rows = len(doc)
    order = np.argsort(terms, kind="stable")
    present, first = np.unique(terms[order], return_index=True)
    row = np.repeat(np.arange(rows), np.diff(ends))[order]
    impact = impacts[order]
    greatest = np.maximum.reduceat(impact, first) if len(first) else first
    first = np.append(first, len(impact))
    square = length * length * (1 + SLACK)
    longest = float(length.max()) * (1 + SLACK)
    left = {"pairs": rows * len(queries), "in_buckets": 0, "focus": 0, "rescored": 0}
    for query, held in zip(queries, best):
        if math.sqrt(len(query)) * longest < held.least:
            continue  # Cauchy-Schwarz: no document of this bucket
        left["in_buckets"] += rows
        at = np.searchsorted(present, query)
        at = at[(at < len(present)) & (present[np.minimum(at, len(present) - 1)] == query)]
        at = at[np.argsort(-greatest[at], kind="stable")]
        if not len(at):
            continue
        # the rest: as many of the least impacts as stay below the wanted score
        tail = np.append(np.cumsum(greatest[at][::-1])[::-1], 0)
        focus = int(np.argmax(tail < max(1, held.least)))
        partial, walked = np.zeros(rows, np.int64), np.zeros(rows)
        for k in at[:focus].tolist():
            mine = row[first[k]:first[k + 1]]
            add = impact[first[k]:first[k + 1]]
            partial[mine] += add
            walked[mine] += add.astype(float) ** 2
        touched = np.flatnonzero(partial > 0)
        left["focus"] += len(touched)
        open_terms = len(at) - focus
        if open_terms:
            rest = np.sqrt(open_terms * np.maximum(0, square[touched] - walked[touched] * (1 - SLACK)))
            bound = partial[touched] + np.minimum(rest * (1 + SLACK) + 1, float(tail[focus]))
            touched = touched[bound >= held.least]
        else:
            touched = touched[partial[touched] >= held.least]
        if not len(touched):
            continue
        left["rescored"] += len(touched)
        for k in at[focus:].tolist():
            partial[row[first[k]:first[k + 1]]] += impact[first[k]:first[k + 1]]
        score = partial[touched]
        up = score >= max(1, held.least)
        touched = touched[up]
        held.add(score[up], unknown[touched], doc[touched])
    return left


def _search(vectors: DataFrame, queries, start, top: int) -> DataFrame:
    """``(item, doc_id, score)``: each task's best documents of every query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = queries.value
        best = [Best(top, s) for s in start.value]
        held: list[pa.RecordBatch] = []
        rows = size = 0

        def flush() -> None:
            nonlocal held, rows, size
            if held:
                t = pa.Table.from_batches(held).combine_chunks()
                ids = t.column("doc_id").combine_chunks()
                terms, ends = _flat(t.column("terms").combine_chunks())
                search_bucket(
                    wanted, best, np.asarray(pc.fill_null(ids, 0)),
                    np.asarray(pc.cast(pc.is_null(ids), pa.int64())),
                    t.column("length").to_numpy(), terms, ends,
                    _flat(t.column("impacts").combine_chunks())[0])
            held, rows, size = [], 0, 0

        for batch in batches:
            many = np.diff(batch.column(2).offsets.to_numpy())
            for a, b in by_size(many, BUCKET_TERMS):
                if held and (rows + b - a > BUCKET_ROWS or size + int(many[a:b].sum()) > BUCKET_TERMS):
                    flush()
                held.append(batch.slice(a, b - a))
                rows, size = rows + b - a, size + int(many[a:b].sum())
        flush()
        for i, found in enumerate(best):
            if len(found.score):
                docs = pa.array(found.doc, pa.int64(), mask=found.unknown.astype(bool))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found.score), i)), docs, pa.array(found.score)],
                    ["item", "doc_id", "score"])

    # longest first: the order that the buckets are cut in
    return (vectors.sortWithinPartitions(F.desc("length"))
            .mapInArrow(run, "item long, doc_id long, score long"))


def _best_of(found: DataFrame, top: int) -> DataFrame:
    """The ``top`` best rows of each item with their rank; first by part of the
    documents, so that no item's candidates meet in one task before."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = Window.partitionBy("item", F.pmod(F.xxhash64("doc_id"), F.lit(16))).orderBy(*order)
    found = found.withColumn("r", F.row_number().over(part)).where(F.col("r") <= top).drop("r")
    return (found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
            .where(F.col("rank") <= top))


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS,
           id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           query_col: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``top`` best documents of each
    item with a score above 0 (all, if fewer), equal scores by ascending doc_id,
    documents without one last.

    Null and empty texts have no terms: such documents are never found and do
    not count, such items find nothing. Repeated rows of ``docs`` are documents
    of their own, repeated rows of ``items`` get a result each. A text is read
    whole; beside it a task holds one bucket. Empty tables give an empty
    result."""
    spark = docs.sparkSession
    python_ready(spark)
    src = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    asked = keep(query_terms(items, item_col, query_col), "queries")
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, -(-int(total) // block_terms))
    dealt = asked.where(F.size("terms") > 0).withColumn(
        "block", F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)))
    size = None
    out = config_frame(spark, [], "item_id long, rank int, doc_id long, score long")
    for block in range(blocks):
        rows = dealt.where(F.col("block") == block).select("item_id", "terms").collect()
        if not rows:
            continue
        words = sorted({t for r in rows for t in r.terms})
        number = {w.encode(): i for i, w in enumerate(words)}
        projected = keep(_projected(src, spark.sparkContext.broadcast(number)), "projected")
        if size is None:  # the same for every block
            n, n_terms = projected.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
            size = (n, n_terms or 0)
        df = _document_counts(projected, len(words))
        weights = np.array([weight(size[0], df.get(i, 0)) for i in range(len(words))], np.int64)
        vectors = keep(_vectors(projected, weights, *size), "vectors")
        discard(projected)
        cut = vectors.agg(F.percentile_approx("length", 1 - HEAD)).first()[0] or 0.0
        queries = spark.sparkContext.broadcast(
            [np.array(sorted(number[t.encode()] for t in r.terms), np.int64) for r in rows])

        def best(part: DataFrame, start: list[int], label: str) -> DataFrame:
            sent = spark.sparkContext.broadcast(start)
            return keep(_best_of(_search(part, queries, sent, top), top), label)

        head = best(vectors.where(F.col("length") > cut), [0] * len(rows), "head")
        known = {r.item: r.score for r in head.where(F.col("rank") == top).select("item", "score").collect()}
        rest = best(vectors.where(F.col("length") <= cut), [known.get(i, 0) for i in range(len(rows))], "rest")
        both = head.union(rest).select("item", "doc_id", "score")
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], "item long, item_id long")
        found = keep(_best_of(both, top).join(names, "item").select(
            "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"), "ranked")
        discard(vectors)
        out = out.union(found)
    return out
