"""Alignment of two tokenizers' tokens over the same bytes.

Tokenizer A (byte-level BPE, ``tokenizer.json``) encodes a blank and the text,
tokenizer B (a SentencePiece model, which adds that blank itself) the text.
Byte offsets where tokens of both end cut the tokens into groups; a token of A
and one of B are linked where their byte ranges overlap.

Neither tokenizer joins what stands on both sides of a blank that follows a
word's or an ASCII mark's character: A's splitting rule cuts there, and no
piece of B holds a blank inside (checked when the model is loaded). So a text
is cut there and each different part is encoded and aligned once per worker.

Counting the pairs over the corpus, by the identity-map fast path: an array
gives for each id of A the id of B with the same bytes. A group of one token
each with that pair of ids is counted in a vector of A's vocabulary, one per
task; only the pairs of other groups are counted by a shuffle, added up by task
before. The count of a pair is what both ways have of it.

Afterwards each document's pairs are looked up: in sorted arrays that are
broadcast while the pairs are at most ``pair_limit``, by a join beyond that.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import by_size, discard, keep, pick, python_ready
from strata.llm.tokens import BatchEncoder

# text that is aligned at once, bytes
TEXT_BYTES = 4 << 20
# different parts a worker remembers; beyond it the memory starts anew
PARTS_MOST = 300_000
# pairs that are broadcast, 24 bytes each
PAIR_LIMIT = 2_000_000
# pairs a task adds up before it hands them on
PAIRS_HELD = 2_000_000
# a pair of ids as one number: a * 2^20 + b
_SHIFT = 20
_CUT = re.compile(r"(?<=[\w!-~]) ")
_ENDS_WELL = re.compile(r"[\w!-~]\Z")


def byte_level() -> dict[str, int]:
    """The byte of each character that a byte-level vocabulary is written in:
    printable bytes stand for themselves, the others for 256, 257 and so on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


class Aligner:
    """Both tokenizers, and what is known of the parts seen so far."""

    def __init__(self, path_a: str, path_b: str):
        self.a = BatchEncoder(path_a)
        self.a.slow.encode_special_tokens = True  # their strings are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        back, vocab = byte_level(), self.a.slow.get_vocab()
        self.bytes_a = [b""] * (1 + max(vocab.values()))
        for token, i in vocab.items():
            self.bytes_a[i] = (bytes(back[c] for c in token) if all(c in back for c in token)
                               else token.encode())
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.len_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # a part may stand alone if no piece holds a blank after something else
        self.cuts = not any(re.search("[^▁]▁", p) for p in pieces)
        same = {}
        for i, x in enumerate(self.bytes_b):  # of equal ones a written piece is the identity
            if not self.b.is_byte(i) or x not in same:
                same[x] = i
        self.identity = np.array([same.get(x, -1) for x in self.bytes_a], np.int64)
        self.blank = self.b.piece_to_id("▁")
        self._forget()

    def _forget(self) -> None:
        self.part: dict[str, int] = {}
        self.last: dict[str, int] = {}  # last parts of texts that end otherwise
        self.shown: list[str] = []
        self.numbers = np.zeros((0, 4), np.int64)  # tokens of A, of B, groups, is it the same text
        self.own = np.zeros(0, np.int64)  # ids of A of identity groups
        self.own_end = np.zeros(1, np.int64)
        self.pairs = np.zeros(0, np.int64)  # pairs of the other groups
        self.pairs_end = np.zeros(1, np.int64)

    def _learn(self, parts: list[str]) -> None:
        """Encode and align new parts (each without the blank before it)."""
        data = [(" " + p).encode() for p in parts]
        ids_a = self.a.encode([" " + p for p in parts])
        # a blank alone cannot be asked of B, which takes an empty text as nothing
        ids_b = [x if p else [self.blank] for p, x in zip(parts, self.b.encode(parts, num_threads=1))]
        good = np.array([b"".join([self.bytes_b[i] for i in b]) == d and
                         b"".join([self.bytes_a[i] for i in a.tolist()]) == d
                         for a, b, d in zip(ids_a, ids_b, data)], bool)
        right = np.flatnonzero(good)
        a = np.concatenate([np.zeros(0, np.int64), *[ids_a[i] for i in right]]).astype(np.int64)
        b = np.array([x for i in right for x in ids_b[i]], np.int64)
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        part_end = np.cumsum([len(data[i]) for i in right]) if len(right) else end_a
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        last_a, last_b = np.searchsorted(end_a, both), np.searchsorted(end_b, both)
        part = np.searchsorted(part_end, both)  # of each group
        plain = ((np.diff(last_a, prepend=-1) == 1) & (np.diff(last_b, prepend=-1) == 1)
                 & (self.identity[a[last_a]] == b[last_b]))
        # each stretch between neighbouring ends of either is one link
        ends = np.union1d(end_a, end_b)
        group = np.searchsorted(both, ends)
        other = ~plain[group]
        pairs = (a[np.searchsorted(end_a, ends[other])] << _SHIFT) + b[np.searchsorted(end_b, ends[other])]

        def spread(counts: np.ndarray) -> np.ndarray:
            """Counts of the right parts, with 0 for the others."""
            out = np.zeros(len(parts), np.int64)
            out[right] = counts
            return out

        k = len(right)
        n_groups = np.bincount(part, minlength=k)
        self.numbers = np.concatenate([self.numbers, np.stack([
            spread([len(ids_a[i]) for i in right]), spread([len(ids_b[i]) for i in right]),
            spread(n_groups), good.astype(np.int64)], axis=1)])
        for name, values, counts in (("own", a[last_a[plain]], np.bincount(part[plain], minlength=k)),
                                     ("pairs", pairs, np.bincount(part[group][other], minlength=k))):
            upto = getattr(self, name + "_end")
            setattr(self, name, np.concatenate([getattr(self, name), values]))
            setattr(self, name + "_end", np.concatenate([upto, upto[-1] + np.cumsum(spread(counts))]))
        ta, tb = list(map(str, a.tolist())), list(map(str, b.tolist()))
        shown, i, j = [], 0, 0
        for x, y in zip((last_a + 1).tolist(), (last_b + 1).tolist()):
            shown.append(f"{ta[i]}|{tb[j]}" if x - i == y - j == 1 else
                         f"{','.join(ta[i:x])}|{','.join(tb[j:y])}")
            i, j = x, y
        at = 0
        for n in spread(n_groups).tolist():
            self.shown.append(";".join(shown[at:at + n]))
            at += n

    def _split(self, text: str) -> tuple[list[str], str]:
        """The parts of a text but the last, and the last."""
        if not self.cuts:
            return [], text
        parts = text.split(" ")
        if any(p not in self.part for p in parts[:-1]):
            parts = _CUT.split(text)  # blanks in a row, or new words
        return parts[:-1], parts[-1]

    def places(self, texts: list[str]) -> list[list[int]]:
        """The numbers of each text's parts."""
        if len(self.shown) > PARTS_MOST:
            self._forget()
        split = [self._split(t) for t in texts]
        fresh, ending = [], []
        for body, end in split:
            for p in body:
                if p not in self.part:
                    self.part[p] = len(self.shown) + len(fresh)
                    fresh.append(p)
            if _ENDS_WELL.search(end):
                if end not in self.part:
                    self.part[end] = len(self.shown) + len(fresh)
                    fresh.append(end)
            elif end not in self.last:
                self.last[end] = -1
                ending.append(end)
        for k, p in enumerate(ending):
            self.last[p] = len(self.shown) + len(fresh) + k
        if fresh or ending:
            self._learn(fresh + ending)
        part = self.part
        return [[part[p] for p in body] + [part[end] if _ENDS_WELL.search(end) else self.last[end]]
                for body, end in split]


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One per worker and pair of vocabularies."""
    return Aligner(path_a, path_b)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after another."""
    upto = np.cumsum(sizes)
    return np.repeat(starts - (upto - sizes), sizes) + np.arange(int(upto[-1]) if len(upto) else 0)


def _sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sums of the stretches between cuts, in integers."""
    upto = np.concatenate([np.zeros((1, *values.shape[1:]), np.int64), np.cumsum(values, axis=0)])
    return upto[cuts[1:]] - upto[cuts[:-1]]


ROWS = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "own array<int>, own_n array<int>, pairs array<bigint>, pairs_n array<int>")


def _align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document: counts, the digest of its groups, and which pairs it holds
    how often: ids of A of identity groups (own), pairs of the others."""
    names = [x.split()[0] for x in ROWS.split(", ")]

    def tally(place: np.ndarray, doc: np.ndarray, values: np.ndarray, ends: np.ndarray, rows: int):
        """Distinct values per document, with their counts."""
        sizes = ends[place + 1] - ends[place]
        key = np.sort((np.repeat(doc, sizes) << 2 * _SHIFT) + values[_ranges(ends[place], sizes)])
        first = np.flatnonzero(np.diff(key, prepend=-1))
        key, times = key[first], np.diff(np.append(first, len(key)))
        cut = np.searchsorted(key, np.arange(rows + 1) << 2 * _SHIFT).astype(np.int32)
        return cut, key & ((1 << 2 * _SHIFT) - 1), times.astype(np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(path_a, path_b)
        for batch in batches:
            sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(1)), 0))
            for lo, hi in by_size(sizes, TEXT_BYTES):
                texts = batch.column(1).slice(lo, hi - lo).to_pylist()
                rows = len(texts)
                full = [i for i, t in enumerate(texts) if t]
                places = al.places([texts[i] for i in full])
                flat = np.array([p for x in places for p in x], np.int64)
                doc = np.repeat(np.array(full, np.int64), [len(x) for x in places])
                same = np.ones(rows, bool)
                same[doc[al.numbers[flat, 3] == 0]] = False  # joined tokens are another text
                many = np.zeros(rows, np.int64)
                many[full] = [len(x) for x in places]
                counts = _sums(al.numbers[flat, :3], np.concatenate(([0], np.cumsum(many))))
                counts[~same] = 0
                digests = [""] * rows
                for i, x in zip(full, places):
                    if same[i]:
                        digests[i] = hashlib.sha256(";".join([al.shown[p] for p in x]).encode()).hexdigest()
                kept = same[doc]
                flat, doc = flat[kept], doc[kept]
                own, own_v, own_n = tally(flat, doc, al.own, al.own_end, rows)
                pairs, pairs_v, pairs_n = tally(flat, doc, al.pairs, al.pairs_end, rows)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), *[pa.array(counts[:, k]) for k in range(3)],
                    pa.array(counts[:, 0] + counts[:, 1] - counts[:, 2]), pa.array(digests, pa.string()),
                    pa.ListArray.from_arrays(own, pa.array(own_v.astype(np.int32))),
                    pa.ListArray.from_arrays(own, pa.array(own_n)),
                    pa.ListArray.from_arrays(pairs, pa.array(pairs_v)),
                    pa.ListArray.from_arrays(pairs, pa.array(pairs_n))], names)

    return docs.mapInArrow(run, ROWS)


def _counts(aligned: DataFrame, width: int) -> DataFrame:
    """``(own, key, n)``: corpus-wide counts of identity groups by id of A
    (own = 1) and of the other pairs, added up by task before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(width, np.int64)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def summed() -> pa.RecordBatch:
            nonlocal held, size
            key, n = (np.concatenate([h[k] for h in held]) if held else np.zeros(0, np.int64) for k in (0, 1))
            key, inverse = np.unique(key, return_inverse=True)
            total = np.bincount(inverse, n, len(key)).astype(np.int64)
            held, size = [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(key), np.int32)), pa.array(key), pa.array(total)], ["own", "key", "n"])

        for batch in batches:
            own, own_n, key, n = [c.flatten().to_numpy() for c in batch.columns]
            vector += np.bincount(own, own_n, width).astype(np.int64)
            held.append((key, n.astype(np.int64)))
            size += len(key)
            if size > PAIRS_HELD:
                yield summed()
        yield summed()
        at = np.flatnonzero(vector)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ones(len(at), np.int32)), pa.array(at), pa.array(vector[at])], ["own", "key", "n"])

    held = aligned.select("own", "own_n", "pairs", "pairs_n").mapInArrow(run, "own int, key long, n long")
    return held.groupBy("own", "key").agg(F.sum("n").alias("n"))


def pair_counts(counted: DataFrame, identity: np.ndarray) -> DataFrame:
    """``(key, n, best)`` of each pair: in how many links it stands, and whether
    no pair of its id of B stands in more."""
    spark = counted.sparkSession
    known = spark.createDataFrame(
        [(a, (a << _SHIFT) + b) for a, b in enumerate(identity.tolist()) if b >= 0], "a long, pair long")
    own = counted.where("own = 1").join(F.broadcast(known), F.col("key") == F.col("a")).select(
        F.col("pair").alias("key"), "n")
    pairs = own.union(counted.where("own = 0").select("key", "n")).groupBy("key").agg(F.sum("n").alias("n"))
    pairs = pairs.withColumn("b", F.col("key").bitwiseAND(F.lit((1 << _SHIFT) - 1)))
    most = pairs.groupBy("b").agg(F.max("n").alias("most"))  # at most B's vocabulary
    return pairs.join(F.broadcast(most), "b").select("key", "n", (F.col("n") == F.col("most")).alias("best"))


def _by_arrays(aligned: DataFrame, pairs: DataFrame, identity: np.ndarray) -> DataFrame:
    """n_best and count_sum of each document, by sorted arrays in every task."""
    table = pairs.toArrow().sort_by("key")
    sent = aligned.sparkSession.sparkContext.broadcast(
        (*[table.column(c).to_numpy() for c in ("key", "n", "best")], identity))
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, best, same = sent.value
        for batch in batches:
            out = np.zeros((2, batch.num_rows), np.int64)
            for values, times, to_key in ((6, 7, lambda a: (a.astype(np.int64) << _SHIFT) + same[a]),
                                          (8, 9, lambda k: k)):
                cuts = batch.column(values).offsets.to_numpy()
                at = np.searchsorted(key, to_key(batch.column(values).flatten().to_numpy()))
                many = batch.column(times).flatten().to_numpy().astype(np.int64)
                out[0] += _sums(many * best[at], cuts - cuts[0])
                out[1] += _sums(many * n[at], cuts - cuts[0])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(out[0]), pa.array(out[1]), batch.column(5)],
                [*columns, "n_best", "count_sum", "groups_sha256"])

    return aligned.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, "
                                   "n_best long, count_sum long, groups_sha256 string")


def _by_join(aligned: DataFrame, pairs: DataFrame, identity: np.ndarray) -> DataFrame:
    """The same by a join; rows are told apart by a number. A pair that a third
    of the documents hold is split by adaptive execution."""
    spark = aligned.sparkSession
    rows = keep(aligned.withColumn("row", F.monotonically_increasing_id()), "numbered")
    known = spark.createDataFrame(
        [(a, (a << _SHIFT) + b) for a, b in enumerate(identity.tolist()) if b >= 0], "a int, pair long")
    own = (rows.select("row", F.explode(F.arrays_zip("own", "own_n")).alias("x"))
           .join(F.broadcast(known), F.col("x.own") == F.col("a"))
           .select("row", F.col("pair").alias("key"), F.col("x.own_n").alias("times")))
    held = own.union(rows.select("row", F.explode(F.arrays_zip("pairs", "pairs_n")).alias("x"))
                     .select("row", "x.pairs", "x.pairs_n"))
    sums = (held.join(pairs, "key").groupBy("row")
            .agg(F.sum(F.col("times") * F.col("best").cast("long")).alias("n_best"),
                 F.sum(F.col("times") * F.col("n")).alias("count_sum")))
    return rows.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")


def align(docs: DataFrame, path_a: str, path_b: str, pair_limit: int = PAIR_LIMIT,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best (links
    whose pair has the highest count of its id of B, ties included), count_sum
    (the counts of its links' pairs added up) and groups_sha256 (lower-case hex
    of ``a1,a2|b1;a3|b2,b3``).

    A text that is null or empty, or whose joined tokens of A or of B are not
    the blank and the text, has no tokens: zeros and an empty string. Repeated
    rows and rows without a doc_id are documents like any other and count each
    time. A long text is held whole, with its tokens. An empty table gives an
    empty result."""
    spark = docs.sparkSession
    python_ready(spark)
    src = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    al = aligner(path_a, path_b)
    aligned = keep(_align(src, path_a, path_b), "aligned")
    counted = keep(_counts(aligned, len(al.identity)), "counted")
    pairs = keep(pair_counts(counted, al.identity), "pairs")
    small = pairs.count() <= pair_limit
    out = keep((_by_arrays if small else _by_join)(aligned, pairs, al.identity), "alignment")
    for done in (aligned, counted, pairs):
        discard(done)
    return out
