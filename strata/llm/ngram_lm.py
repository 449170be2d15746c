"""Interpolated modified Kneser-Ney language model.

Counted in Spark, level by level, from the n-grams of the whole corpus:

* words are told apart by 64-bit hashes; a word's number is its place in the
  sorted hashes of all words;
* a task adds up the n-grams of its documents and sends them to shards as
  packed arrays (contexts once, with run lengths), not as rows. A shard holds
  whole contexts, but a context all of whose words are so frequent that it could
  outgrow a shard is dealt over all of them by its last word;
* a shard writes its n-grams as sorted hash arrays, counts beside, and hands on
  what the next level needs: one for each distinct n-gram to its suffix (the
  continuation counts), and the sums over each context.

The arrays are files in the cluster's shared folder under names that no other
attempt uses; only files that a committed task reports are ever read. Workers
map them into memory (a store that is no mounted folder is copied to an
unlinked temporary file first), and the pages they touch are shared by all
workers of a machine. Discounts come from the counts of counts of each level.

The lowest level is interpolated with the uniform distribution over the words
seen and one for all others, so every text has a probability above 0.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import by_size, delete_path, discard, keep, pick, python_ready, shared_path, uri_of

ORDER = 2
# text of the training corpus that a shard stands for, bytes
SHARD_BYTES = 24 << 20
# tokens that a task adds up before it sends them on
BUFFER = 3_000_000
# text that is scored at once, bytes; lookups of at most so many tokens at once
TEXT_BYTES, SLICE = 4 << 20, 1 << 20
# added to every count of the unigram model that scores are held against
ADD = 0.1

# A-Z become a-z; blanks and the characters 9 to 13 separate.
_CLASS = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_END, _START = (xxhash.xxh64_intdigest(x) for x in (b"", b" "))  # no word is either


def words_of(text: bytes | None) -> list[bytes]:
    """Words of one UTF-8 text; a null has none."""
    return text.translate(_CLASS).split() if text else []


def token_hashes(texts: list[bytes | None], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the texts' tokens, ``pad`` starts before each text and one end
    after it; and how many tokens (the end among them) each text has."""
    flat: list[int] = []
    many = []
    start = [_START] * pad
    for text in texts:
        words = words_of(text)
        flat += start
        flat += map(xxhash.xxh64_intdigest, words)
        flat.append(_END)
        many.append(len(words) + 1)
    return np.array(flat, np.uint64), np.array(many, np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_key(columns: list[np.ndarray], rows: int) -> np.ndarray:
    """64-bit hashes of rows of word numbers."""
    key = np.zeros(rows, np.uint64)
    for c in columns:
        key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + c.astype(np.uint64) + np.uint64(1))
    return key


def shard_of(columns: list[np.ndarray], shards: int, hot: np.ndarray) -> np.ndarray:
    """The shard of each n-gram: by its context, or by all of it if every word
    of the context is hot (as in an empty context)."""
    rows = len(columns[-1])
    spread = np.ones(rows, bool)
    for c in columns[:-1]:
        spread &= np.isin(c, hot)
    key = np.where(spread, gram_key(columns, rows), gram_key(columns[:-1], rows))
    return (key % np.uint64(shards)).astype(np.int64)


def range_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """The shard of a word, in the order of the hashes."""
    return (((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


def combine(columns: list[np.ndarray], n: np.ndarray | None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows, sorted, with their counts added up (each 1 if not given)."""
    rows = len(columns[-1])
    if not rows:
        return columns, np.zeros(0, np.int64)
    if len(columns) == 1 or len(columns) == 2 and max(c.max() for c in columns) < 1 << 32:
        key = columns[-1].astype(np.uint64)
        if len(columns) == 2:
            key |= columns[0].astype(np.uint64) << np.uint64(32)
        if n is None:
            key.sort()
        else:
            order = np.argsort(key)
            key, n = key[order], n[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        key = key[first]
        out = [key] if len(columns) == 1 else [key >> np.uint64(32), key & np.uint64(0xFFFFFFFF)]
        out = [x.astype(c.dtype) for x, c in zip(out, columns)]
    else:
        order = np.lexsort(columns[::-1])
        columns = [c[order] for c in columns]
        n = None if n is None else n[order]
        new = np.zeros(rows, bool)
        new[0] = True
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        first = np.flatnonzero(new)
        out = [c[first] for c in columns]
    if n is None:
        return out, np.diff(np.append(first, rows))
    return out, np.add.reduceat(n.astype(np.int64), first)


def _runs(context: list[np.ndarray], rows: int) -> np.ndarray:
    """Where each context begins in sorted rows."""
    new = np.zeros(rows, bool)
    new[:1] = True
    for c in context:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


# What tasks send: packed n-grams of one shard (contexts once, run lengths, last
# words, counts), sums of contexts (four numbers each), or a file they wrote.
_PACKED = ("kind string, shard int, context binary, runs binary, last binary, n binary, "
           "path string, entries long, types string, once long, twice long, thrice long, four long, total long")
_NAMES = [x.split()[0] for x in _PACKED.split(", ")]
_TYPES = [pa.string(), pa.int32(), *[pa.binary()] * 4, pa.string(), pa.int64(), pa.string(), *[pa.int64()] * 5]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], _NAMES)


def _packed(columns: list[np.ndarray], n: np.ndarray, shard: np.ndarray) -> Iterator[tuple]:
    """Rows of sorted, distinct n-grams, one for each shard."""
    order = np.argsort(shard, kind="stable")
    shard, n = shard[order], n[order]
    columns = [c[order] for c in columns]
    cuts = np.append(_runs([shard], len(shard)), len(shard)).tolist()
    for a, b in zip(cuts[:-1], cuts[1:]):
        context = [c[a:b] for c in columns[:-1]]
        at = _runs(context, b - a) if context else np.zeros(0, np.int64)
        yield ("grams", int(shard[a]), np.array([c[at] for c in context]).tobytes(),
               np.diff(np.append(at, b - a)).astype(np.uint32).tobytes() if context else b"",
               columns[-1][a:b].tobytes(), n[a:b].astype(np.uint32).tobytes(), *[None] * 8)


def _unpacked(batches: Iterator[pa.RecordBatch], level: int, kind: np.dtype) -> tuple[list[np.ndarray], np.ndarray]:
    """All n-grams of a partition, not yet added up."""
    parts: list[list[np.ndarray]] = [[] for _ in range(level)]
    counts = []
    for batch in batches:
        for context, runs, last, n in zip(*[batch.column(i).to_pylist() for i in range(2, 6)]):
            parts[-1].append(np.frombuffer(last, kind))
            counts.append(np.frombuffer(n, np.uint32))
            if level > 1:
                times = np.frombuffer(runs, np.uint32)
                for p, c in zip(parts, np.frombuffer(context, kind).reshape(level - 1, -1)):
                    p.append(np.repeat(c, times))
    none = np.zeros(0, kind)
    return [np.concatenate([none, *p]) for p in parts], np.concatenate([np.zeros(0, np.uint32), *counts])


def _write(folder: str, key: np.ndarray, columns: list[np.ndarray]) -> tuple[str, int, str]:
    """Sorted keys and their columns as one file under a name of its own; its
    name, entries and the columns' types."""
    order = np.argsort(key)
    columns = [c[order].astype(np.min_scalar_type(int(c.max()))) for c in columns]
    fs, root = pafs.FileSystem.from_uri(folder)
    name = uuid.uuid4().hex
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/{name}", compression=None) as out:
        for x in (key[order], *columns):
            out.write(x.tobytes())
    return name, len(key), ",".join(c.dtype.str for c in columns)


@lru_cache(maxsize=4096)
def _mapped(uri: str) -> np.ndarray:
    """The bytes of a file, mapped into memory."""
    fs, path = pafs.FileSystem.from_uri(uri)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, np.uint8, "r")
    with tempfile.TemporaryFile() as copy, fs.open_input_stream(path, compression=None) as source:
        while block := source.read(1 << 20):
            copy.write(block)
        copy.flush()
        return np.memmap(copy, np.uint8, "r")  # stays mapped though the file has no name


@dataclass(frozen=True)
class Table:
    """A sharded sorted hash array with columns of numbers beside it."""

    folder: str
    files: dict[int, tuple[str, int, str]] = field(repr=False)  # by shard: name, entries, types

    def shard(self, s: int) -> tuple[np.ndarray, list[np.ndarray]]:
        name, n, types = self.files[s]
        data = _mapped(f"{self.folder}/{name}")
        columns, at = [], 8 * n
        for t in types.split(","):
            kind = np.dtype(t)
            columns.append(data[at:at + n * kind.itemsize].view(kind))
            at += n * kind.itemsize
        return data[:8 * n].view(np.uint64), columns

    def lookup(self, keys: np.ndarray, shards: np.ndarray, width: int,
               offsets: np.ndarray | None = None) -> np.ndarray:
        """The columns of each key, ``width`` rows of int64, 0 where it is not
        there; with ``offsets`` (by shard) one more row, the key's place or -1."""
        known, first, back = np.unique(keys, return_index=True, return_inverse=True)
        shards = shards[first]
        order = np.argsort(shards, kind="stable")  # by shard, sorted within
        out = np.zeros((width + (offsets is not None), len(known)), np.int64)
        if offsets is not None:
            out[-1] = -1
        cuts = np.append(_runs([shards[order]], len(order)), len(order)).tolist()
        for a, b in zip(cuts[:-1], cuts[1:]):
            s = int(shards[order[a]])
            if s not in self.files:
                continue
            mine = order[a:b]
            key, columns = self.shard(s)
            at = np.searchsorted(key, known[mine])
            at[at == len(key)] = 0
            hit = key[at] == known[mine]
            mine, at = mine[hit], at[hit]
            for k, c in enumerate(columns):
                out[k, mine] = c[at]
            if offsets is not None:
                out[-1, mine] = at + offsets[s]
        return out[:, back]


@dataclass(frozen=True)
class Level:
    """What a level needs beside its tables: discounts of counts 1, 2 and more."""

    grams: Table
    contexts: Table | None
    discounts: tuple[float, float, float]
    total: int  # of all counts, and how many of them are 1, 2 and more
    shares: tuple[int, int, int]


@dataclass(frozen=True)
class Model:
    folder: str
    order: int
    shards: int
    words: Table
    offsets: np.ndarray = field(repr=False)
    tokens: int = 0  # N
    distinct: int = 0  # V
    hot: np.ndarray = field(default=None, repr=False)
    levels: tuple[Level, ...] = ()  # from 1 to the order

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and number of each token; starts have the number V, and other
        words that training has not seen V + 1."""
        count, place = self.words.lookup(hashes, range_of(hashes, self.shards), 1, self.offsets)
        unseen = np.where(hashes == np.uint64(_START), self.distinct, self.distinct + 1)
        return count, np.where(place < 0, unseen, place).astype(self.kind)

    @property
    def kind(self) -> np.dtype:
        return np.dtype(np.uint32 if self.distinct + 1 < 1 << 32 else np.uint64)


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Of counts 1, 2 and 3 or more, from how many n-grams have 1, 2, 3 and 4.
    Where a small corpus lacks one of these counts, or gives a discount outside
    of 0 to its count, 0.5, 1 and 1.5 stand in; so some mass is always left."""
    if min(n1, n2, n3, n4) > 0:
        y = n1 / (n1 + 2 * n2)
        out = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
        if all(0 < d <= i for i, d in enumerate(out, 1)):
            return out
    return 0.5, 1.0, 1.5


def _tables(rows: DataFrame, folder: str) -> tuple[Table, list]:
    """The files that committed tasks wrote."""
    found = rows.where("kind = 'file'").select(
        "shard", "path", "entries", "types", "once", "twice", "thrice", "four", "total").collect()
    return Table(folder, {r.shard: (r.path, r.entries, r.types) for r in found}), found


def _count_words(train: DataFrame, shards: int, folder: str) -> tuple[Table, np.ndarray, int, int]:
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            columns, n = combine([np.concatenate(held)], None)
            held.clear()
            return _batch(list(_packed(columns, n, range_of(columns[0], shards))))

        for texts in _texts(batches):
            held.append(token_hashes(texts, 0)[0])
            size += len(held[-1])
            if size >= BUFFER:
                yield flush()
                size = 0
        if held:
            yield flush()

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, n = combine(*_unpacked(batches, 1, np.dtype(np.uint64)))
        if len(n):
            file = _write(folder, columns[0], [n])
            yield _batch([("file", int(range_of(columns[0][:1], shards)[0]), *[None] * 4, *file,
                           *[0] * 4, int(n.sum()))])

    rows = keep(_dealt(train.mapInArrow(gather, _PACKED), shards).mapInArrow(store, _PACKED), "lm-words")
    table, found = _tables(rows, folder)
    discard(rows)
    sizes = np.zeros(shards + 1, np.int64)
    for r in found:
        sizes[r.shard + 1] = r.entries
    return table, np.cumsum(sizes)[:-1], sum(r.total for r in found), int(sizes.sum())


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes | None]]:
    """The first column's texts, a few megabytes at once."""
    for batch in batches:
        column = batch.column(0).cast(pa.binary())
        sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0))
        for a, b in by_size(sizes, TEXT_BYTES):
            yield column.slice(a, b - a).to_pylist()


def _dealt(rows: DataFrame, shards: int) -> DataFrame:
    """One partition for each shard."""
    return rows.repartitionById(shards, F.col("shard"))


def _hot_words(spark: SparkSession, model: Model) -> np.ndarray:
    """Numbers of the words that stand for over a quarter of a shard's share,
    so at most four for each shard, and of the start."""
    floor = model.tokens / (4 * model.shards)
    files = spark.createDataFrame([(s,) for s in sorted(model.words.files)], "shard int")

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in batch.column(0).to_pylist():
                at = np.flatnonzero(model.words.shard(s)[1][0] > floor)
                yield pa.RecordBatch.from_arrays([pa.array(at + model.offsets[s])], ["word"])

    found = files.mapInArrow(frequent, "word long").collect() if model.words.files else []
    return np.array(sorted(r.word for r in found) + [model.distinct], np.int64)


def _gather_grams(train: DataFrame, model: Model, sent) -> DataFrame:
    """Packed n-grams of the highest level."""
    order = model.order

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            _, ids = model.numbers(np.concatenate(held))
            held.clear()
            at = np.flatnonzero(ids != model.distinct)  # starts are context only
            columns, n = combine([ids[at - order + 1 + k] for k in range(order)], None)
            return _batch(list(_packed(columns, n, shard_of(columns, model.shards, model.hot))))

        for texts in _texts(batches):
            held.append(token_hashes(texts, order - 1)[0])
            size += len(held[-1])
            if size >= BUFFER:
                yield flush()
                size = 0
        if held:
            yield flush()

    return train.mapInArrow(gather, _PACKED)


def _store_level(grams: DataFrame, level: int, model: Model, sent) -> DataFrame:
    """Add up a level's n-grams and write them; hand on the sums of their
    contexts and one for each n-gram to its suffix."""
    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        columns, n = combine(*_unpacked(batches, level, model.kind))
        if not len(n):
            return
        shard = int(shard_of([c[:1] for c in columns], model.shards, model.hot)[0])
        file = _write(f"{model.folder}/grams-{level}", gram_key(columns, len(n)), [n])
        least = np.bincount(np.minimum(n, 5), minlength=6)
        yield _batch([("file", shard, *[None] * 4, *file, *least[1:5].tolist(), int(n.sum()))])
        if level == 1:
            return
        at = _runs(columns[:-1], len(n))
        context = [c[at] for c in columns[:-1]]
        sums = np.stack([np.add.reduceat(x.astype(np.int64), at) for x in (n, n == 1, n == 2, n > 2)])
        target = (gram_key(context, len(at)) % np.uint64(model.shards)).astype(np.int64)
        order = np.argsort(target, kind="stable")
        cuts = np.append(_runs([target[order]], len(order)), len(order)).tolist()
        yield _batch([("contexts", int(target[order[a]]),
                       np.array([c[order[a:b]] for c in context]).tobytes(), None, None,
                       sums[:, order[a:b]].tobytes(), *[None] * 8) for a, b in zip(cuts[:-1], cuts[1:])])
        suffix, n = combine(columns[1:], None)
        yield _batch(list(_packed(suffix, n, shard_of(suffix, model.shards, model.hot))))

    return keep(_dealt(grams, model.shards).mapInArrow(store, _PACKED), f"lm-level-{level}")


def _store_contexts(rows: DataFrame, level: int, model: Model, sent) -> DataFrame:
    """Add up the sums of each context (a hot one has a part in every shard)."""
    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        context, sums = [], []
        for batch in batches:
            for c, n in zip(batch.column(2).to_pylist(), batch.column(5).to_pylist()):
                context.append(np.frombuffer(c, model.kind).reshape(level - 1, -1))
                sums.append(np.frombuffer(n, np.int64).reshape(4, -1))
        if not context:
            return
        context, sums = np.concatenate(context, axis=1), np.concatenate(sums, axis=1)
        order = np.lexsort(context[::-1])
        context, sums = context[:, order], sums[:, order]
        at = _runs(list(context), len(order))
        key = gram_key(list(context[:, at]), len(at))
        file = _write(f"{model.folder}/contexts-{level}", key, list(np.add.reduceat(sums, at, axis=1)))
        yield _batch([("file", int(key[0] % np.uint64(model.shards)), *[None] * 4, *file, *[0] * 5)])

    return keep(_dealt(rows, model.shards).mapInArrow(store, _PACKED), f"lm-contexts-{level}")


def fit(train: DataFrame, order: int = ORDER, shard_bytes: int = SHARD_BYTES,
        text_col: str = "text") -> Model:
    """The model of all rows of ``train``. Null and empty texts are an end
    alone; repeated rows count each time. Of an empty table the model knows no
    word and gives each text probability 1. Its files stay in the shared folder
    until ``forget``."""
    spark = train.sparkSession
    python_ready(spark)
    src = pick(train, text=text_col).withColumn("text", F.col("text").cast("string"))
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(spark.sparkContext.defaultParallelism, -(-int(size) // shard_bytes))
    path = shared_path(spark, "lm")
    folder = uri_of(spark, path)
    words, offsets, tokens, distinct = _count_words(src, shards, f"{folder}/words")
    model = Model(path, order, shards, words, offsets, tokens, distinct)
    hot = _hot_words(spark, model)

    def of(levels: tuple[Level, ...]) -> Model:
        return Model(folder, order, shards, words, offsets, tokens, distinct, hot, levels)

    sent = spark.sparkContext.broadcast(of(()))
    grams, levels = _gather_grams(src, of(()), sent), []
    done: list[DataFrame] = []
    for level in range(order, 0, -1):
        rows = _store_level(grams, level, model, sent)
        table, found = _tables(rows, f"{folder}/grams-{level}")
        contexts = None
        if level > 1:
            sums = _store_contexts(rows.where("kind = 'contexts'"), level, model, sent)
            contexts = _tables(sums, f"{folder}/contexts-{level}")[0]
            done.append(sums)
        n = [sum(r[k] for r in found) for k in ("once", "twice", "thrice", "four", "entries", "total")]
        levels.insert(0, Level(table, contexts, discounts(*n[:4]), n[5], (n[0], n[1], n[4] - n[0] - n[1])))
        grams = rows.where("kind = 'grams'")
        done.append(rows)
    for rows in done:
        discard(rows)
    return of(tuple(levels))


def forget(spark: SparkSession, model: Model) -> None:
    """Delete the model's files."""
    delete_path(spark, model.folder)


def log_probabilities(model: Model, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """log10 of the model's probability of the tokens at the given places."""
    p = np.full(len(at), 1 / (model.distinct + 1))
    for k, level in enumerate(model.levels, 1):
        columns = [ids[at - k + 1 + i] for i in range(k)]
        d = np.array([0.0, *level.discounts])
        n = level.grams.lookup(gram_key(columns, len(at)), shard_of(columns, model.shards, model.hot), 1)[0]
        if k == 1:
            total, shares = level.total, level.shares
            if not total:
                continue
            total = np.full(len(at), float(total))
        else:
            key = gram_key(columns[:-1], len(at))
            total, *shares = level.contexts.lookup(key, (key % np.uint64(model.shards)).astype(np.int64), 4)
            total = total.astype(float)
        left = d[1] * shares[0] + d[2] * shares[1] + d[3] * shares[2]
        with np.errstate(divide="ignore", invalid="ignore"):
            mine = (n - d[np.minimum(n, 3)] + left * p) / total
        p = np.where(total > 0, mine, p)  # a context never seen leaves the lower level's
    return np.log10(p)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens (words and the end), n_known (seen in
    training), base_score (log10 probability by the unigram model with 0.1
    added to each count) and score (by the model).

    A null or empty text is its end alone. Rows are scored each for itself,
    repeated ones and those without a doc_id too. Long texts are read whole and
    looked up in slices. An empty table gives an empty result."""
    spark = docs.sparkSession
    python_ready(spark)
    sent = spark.sparkContext.broadcast(model)
    src = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        pad = model.order - 1
        for batch in batches:
            done = 0
            for texts in _texts(iter([batch])):
                hashes, many = token_hashes(texts, pad)
                rows = len(texts)
                doc = np.repeat(np.arange(rows), many)
                at = np.arange(len(doc)) + (doc + 1) * pad
                out = np.zeros((3, rows))
                for a in range(0, len(at), SLICE):
                    mine, place = doc[a:a + SLICE], at[a:a + SLICE]
                    low = place[0] - pad
                    count, ids = model.numbers(hashes[low:place[-1] + 1])
                    count = count[place - low]
                    base = np.log10((count + ADD) / (model.tokens + ADD * (model.distinct + 1)))
                    for k, x in enumerate((count > 0, base, log_probabilities(model, ids, place - low))):
                        out[k] += np.bincount(mine, x, rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(done, rows), pa.array(many), pa.array(out[0].astype(np.int64)),
                     pa.array(out[1]), pa.array(out[2])],
                    ["doc_id", "n_tokens", "n_known", "base_score", "score"])
                done += rows

    return src.mapInArrow(run, "doc_id long, n_tokens long, n_known long, base_score double, score double")


def held_out_scores(docs: DataFrame, order: int = ORDER, parts: int = 10, id_col: str = "doc_id",
                    text_col: str = "text", **options) -> DataFrame:
    """Scores of all documents by a model of those whose crc32 of the doc_id as
    text is not a multiple of ``parts``: ``score``'s columns, held_out (is the
    remainder 0; true without a doc_id) and train_tokens."""
    spark = docs.sparkSession
    src = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts, F.lit(0)) == 0
    model = fit(src.where(~held_out), order, **options)
    out = keep(score(src, model).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score"), "lm-scores")
    forget(spark, model)
    return out
