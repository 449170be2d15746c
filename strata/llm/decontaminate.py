"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The benchmark's word windows are the patterns. Patterns of one length m share
tables with a block of two words (one for m = 1): ``shift`` says how far the
search may jump from a block that ends at the current word, m - block + 1
where no pattern holds the block, and 0 where a pattern ends with it. At a
shift of 0 the suffix bucket gives the patterns that end with the block, by
their first word; a direct comparison with the document's words confirms an
occurrence. So most positions of a clean document are never looked at.

The patterns are the stated query set. They are deduplicated in Spark and
dealt into shards of at most about ``shard_windows`` patterns, whose tables are
broadcast one by one, so what is broadcast never exceeds that bound however
large the benchmark is. With one shard the documents are searched in one pass.
With more, one pass per ``filter_windows`` patterns (eight bytes each) compares
the 64-bit hashes of a document's runs of words with those of the patterns, and
a shard then searches only the documents that hold a hash of its patterns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import keep, pick, python_ready

WINDOW = 13
SHARD_WINDOWS = 50_000
# hashes of patterns that are broadcast at once, at most about: 128 MB
FILTER_WINDOWS = 16_000_000
# of the hash of a run of words; any odd number does
_BASE = 0x9E3779B97F4A7C15

# The word class of the matching rule, as bytes. A-Z become a-z;
# digits, a-z and every byte of a non-ASCII character stay; the rest separates.
_CLASS = bytes(b + 32 if 0x41 <= b <= 0x5A else
               b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
               for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Words of one UTF-8 text; a null has none."""
    return text.translate(_CLASS).split() if text else []


def windows_of(words: list[bytes], size: int = WINDOW) -> set[bytes]:
    """All windows of ``size`` words; a shorter text is one window."""
    if not words:
        return set()
    return {b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))}


class WuManber:
    """Search tables for windows (space-joined words)."""

    def __init__(self, windows: list[bytes]):
        by_length: dict[int, list[tuple[bytes, ...]]] = {}
        once: dict[bytes, bytes] = {}  # windows overlap: hold each word once
        for w in windows:
            words = tuple(once.setdefault(x, x) for x in w.split(b" "))
            by_length.setdefault(len(words), []).append(words)
        self.tables = [(m, *self._tables(m, group)) for m, group in sorted(by_length.items())]

    @staticmethod
    def _tables(m: int, group: list[tuple[bytes, ...]]) -> tuple[int, dict, dict]:
        block = min(2, m)
        shift: dict[bytes, dict[bytes, int]] = {}  # last word -> word before -> jump
        suffix: dict[tuple[bytes, ...], dict[bytes, list[tuple[bytes, ...]]]] = {}
        for p in group:
            shift.setdefault(p[0], {})  # known, but ends no block: it may start a pattern
            for end in range(block, m + 1):
                last, before = p[end - 1], p[end - 2] if block == 2 else b""
                row = shift.setdefault(last, {})
                row[before] = min(row.get(before, m), m - end)
            suffix.setdefault(p[m - block:], {}).setdefault(p[0], []).append(p)
        return block, shift, suffix

    def find(self, words: list[bytes]) -> Iterator[tuple[int, int, bytes]]:
        """(start, end, window) of every occurrence."""
        n = len(words)
        for m, block, shift, suffix in self.tables:
            most, at = m - block + 1, m - 1
            while at < n:
                row = shift.get(words[at])
                if row is None:
                    at += m  # no pattern holds this word at all
                    continue
                jump = row.get(words[at - 1] if block == 2 else b"", most)
                if jump:
                    at += jump
                    continue
                start = at - m + 1
                for p in suffix[tuple(words[at - block + 1:at + 1])].get(words[start], ()):
                    if tuple(words[start:at + 1]) == p:
                        yield start, at + 1, b" ".join(p)
                at += 1


@lru_cache(maxsize=2)
def _search(key: int, windows: tuple[bytes, ...]) -> WuManber:
    return WuManber(list(windows))


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open spans."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW, id_col: str = "item_id",
                      text_col: str = "text") -> DataFrame:
    """``(window, item_id)``, distinct, over whole items."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(),
                                  batch.column(1).cast(pa.binary()).to_pylist()):
                found = sorted(windows_of(words_of(text), size))
                for i in range(0, len(found), 10_000):
                    part = [w.decode() for w in found[i:i + 10_000]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part), pa.array([item] * len(part), pa.int64())],
                        ["window", "item_id"])

    src = pick(benchmark, item_id=id_col, text=text_col)
    return (src.withColumn("item_id", F.col("item_id").cast("long"))
            .mapInArrow(run, "window string, item_id long").distinct())


@lru_cache(maxsize=1 << 18)
def _word_hash(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def run_hashes(words: list[bytes], sizes: list[int]) -> Iterator[np.ndarray]:
    """For each size the hashes of all runs of so many words, in order: sums of
    word hashes times powers of a base, modulo 2**64, shifted to power zero."""
    n = len(words)

    def powers(base: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[:1] = 1
        return np.cumprod(out, dtype=np.uint64)

    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(np.fromiter(map(_word_hash, words), np.uint64, n) * powers(_BASE), out=sums[1:])
    back = powers(pow(_BASE, -1, 1 << 64))
    for size in sizes:
        yield (sums[size:] - sums[:n + 1 - size]) * back[:n + 1 - size] if size <= n else sums[:0]


def _hashed(windows: DataFrame) -> DataFrame:
    """``(window, size, hash)``: the number of its words and their hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [w.encode().split(b" ") for w in batch.column(0).to_pylist()]
            hashes = [next(run_hashes(w, [len(w)]))[0] for w in split]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(w) for w in split], pa.int32()),
                 pa.array(np.array(hashes, np.uint64).view(np.int64))], ["window", "size", "hash"])

    return windows.select("window").distinct().mapInArrow(run, "window string, size int, hash long")


def _suspects(docs: DataFrame, known: np.ndarray, sizes: list[int], shards: int) -> DataFrame:
    """``docs`` with n_words and the shards of the patterns whose hashes occur;
    the text stays only where there are some."""
    sent = docs.sparkSession.sparkContext.broadcast(np.sort(known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for batch in batches:
            counts, found, texts = [], [], []
            for text in batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist():
                words = words_of(text)
                hits: set[int] = set()
                for hashes in run_hashes(words, sizes):
                    signed = hashes.view(np.int64)
                    at = np.searchsorted(table, signed)
                    signed, at = signed[at < len(table)], at[at < len(table)]
                    hits.update(np.mod(signed[table[at] == signed], shards).tolist())
                counts.append(len(words))
                found.append(sorted(hits))
                texts.append(text if hits else None)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(counts, pa.int64()), pa.array(found, pa.list_(pa.int64())),
                 pa.array(texts, pa.binary()).cast(pa.string())],
                [*batch.schema.names[:-1], "n_words", "shards", "text"])

    return docs.mapInArrow(run, "doc_id long, h1 long, h2 int, n_words long, shards array<long>, text string")


def _hits(docs: DataFrame, windows: list[str], shard: int, size_hint: str) -> DataFrame:
    """Per row: doc_id, n_words, hit spans and the windows that occur."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(tuple(w.encode() for w in windows))
    schema = f"{size_hint} n_words long, spans array<struct<a: long, b: long>>, found array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _search(shard, sent.value)
        for batch in batches:
            counts, spans, found = [], [], []
            for text in batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist():
                words = words_of(text)
                hits = list(search.find(words))
                counts.append(len(words))
                spans.append([{"a": a, "b": b} for a, b in _merge([h[:2] for h in hits])])
                found.append(sorted({h[2].decode() for h in hits}))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(counts, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
                 pa.array(found, pa.list_(pa.string()))],
                [*batch.schema.names[:-1], "n_words", "spans", "found"])

    return docs.mapInArrow(run, schema)


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW,
                  per_hit: int = 20, shard_windows: int = SHARD_WINDOWS,
                  id_col: str = "doc_id", text_col: str = "text",
                  filter_windows: int = FILTER_WINDOWS) -> DataFrame:
    """Per row of ``docs``: doc_id, h1, h2 (hashes of its text), n_words, n_hit
    (words inside any occurrence of a window), items (sorted ids of the items
    with an occurring window) and contaminated (n_hit > 0 and
    per_hit * n_hit >= n_words).

    Null and empty texts have no words and are clean. Rows of one doc_id with
    different texts (or a null doc_id) are judged each for itself; repeated
    rows get a row each. Items of null id count their words as hit but are not
    listed. An empty benchmark makes every document clean; an empty table
    gives an empty result."""
    spark = docs.sparkSession
    python_ready(spark)
    table = keep(benchmark_windows(benchmark, size), "windows")
    total = table.select("window").distinct().count()
    shards = max(1, -(-total // shard_windows))
    src = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    # a row's identity across shards: its id and two hashes of its text
    keyed = src.select("doc_id", F.xxhash64("text").alias("h1"), F.hash("text").alias("h2"), "text")
    hint = "doc_id long, h1 long, h2 int,"
    if shards == 1:
        rows = _hits(keyed, [r.window for r in table.select("window").distinct().collect()], 0, hint)
    else:
        dealt = keep(_hashed(table).withColumn("shard", F.pmod("hash", F.lit(shards))), "dealt")
        sizes = sorted(r["size"] for r in dealt.select("size").distinct().collect())
        passes = min(shards, -(-total // filter_windows))
        seen = [keep(_suspects(keyed, dealt.where(F.col("shard") % passes == p).select("hash").toArrow()
                               .column(0).to_numpy(), sizes, shards), f"suspects-{p}")
                for p in range(passes)]
        parts = [keep(_hits(seen[s % passes].where(F.array_contains("shards", F.lit(s).cast("long")))
                            .select("doc_id", "h1", "h2", "text"),
                            [r.window for r in dealt.where(F.col("shard") == s).select("window").collect()],
                            s, hint), f"hits-{s}") for s in range(shards)]
        every = seen[0].select("doc_id", "h1", "h2", "n_words")
        some = parts[0]
        for p in parts[1:]:
            some = some.union(p)
        some = (some.where("size(found) > 0").groupBy("doc_id", "h1", "h2")
                .agg(F.flatten(F.collect_set("spans")).alias("spans"),
                     F.array_distinct(F.flatten(F.collect_set("found"))).alias("found")))
        same = (F.col("e.doc_id").eqNullSafe(F.col("s.doc_id"))
                & (F.col("e.h1") == F.col("s.h1")) & (F.col("e.h2") == F.col("s.h2")))
        rows = every.alias("e").join(some.alias("s"), same, "left").select(
            "e.doc_id", "e.h1", "e.h2", "e.n_words", "s.spans", "s.found")
    covered = F.aggregate(  # spans sorted by start: count what lies beyond the last end
        F.array_sort(F.coalesce("spans", F.array())),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("long"), x["b"] - F.greatest(x["a"], acc["to"]))).alias("n"),
            F.greatest(acc["to"], x["b"]).alias("to")), lambda acc: acc["n"])
    rows = keep(rows.select("doc_id", "h1", "h2", "n_words", covered.alias("n_hit"), "found"), "hits")
    # items only for the rows with hits: their windows are joined to the items
    marked = (rows.where("size(found) > 0").select("doc_id", "h1", "h2", F.explode("found").alias("window"))
              .distinct().join(table, "window")
              .select("doc_id", "h1", "h2", "item_id").distinct()
              .groupBy("doc_id", "h1", "h2").agg(F.sort_array(F.collect_list("item_id")).alias("items")))
    clean = rows.where("n_hit = 0").select(
        "doc_id", "h1", "h2", "n_words", "n_hit", F.array().cast("array<bigint>").alias("items"))
    same = (F.col("r.doc_id").eqNullSafe(F.col("m.doc_id"))
            & (F.col("r.h1") == F.col("m.h1")) & (F.col("r.h2") == F.col("m.h2")))
    hit = rows.where("n_hit > 0").alias("r").join(marked.alias("m"), same, "left").select(
        "r.doc_id", "r.h1", "r.h2", "r.n_words", "r.n_hit",
        F.coalesce("m.items", F.array().cast("array<bigint>")).alias("items"))
    return clean.union(hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (per_hit * F.col("n_hit") >= F.col("n_words")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The clean rows of ``docs``, columns as they are. Rows are told apart by
    doc_id and text, so a clean row stays also where another of its doc_id, or
    another without one, is contaminated."""
    key, text = (f"c{docs.columns.index(k)}" for k in ("doc_id", "text"))
    bad = keep(contamination(docs, benchmark).where("contaminated").select("doc_id", "h1", "h2").distinct(), "bad")
    flat = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    same = (F.col(key).eqNullSafe(F.col("doc_id")) & (F.xxhash64(text) == F.col("h1"))
            & (F.hash(text) == F.col("h2")))
    return flat.join(bad, same, "left_anti").toDF(*docs.columns)
