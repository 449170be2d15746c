"""Order-preserving packing of documents into training sequences.

A document's tokens and a separator follow those of the one before. A dynamic
program chooses where sequences end: at a document's end for nothing, at a
sentence's end for a small truncation penalty, elsewhere (where no sentence
ends for long, and in the last tokens of a segment) for a larger one. A
sequence costs the tokens it is padded by. With f(j) the least cost up to cut
j at position p_j,

    f(j) = penalty(j) + size - p_j + min over p_j - size <= p_i of f(i) + p_i

whose minimum over a sliding range a monotone queue gives in constant time per
cut. A length that is a power of two needs no padding: the few cuts that far
back are tried besides.

Documents stay in the order and in the partitions in which they are read, so
nothing is shuffled; each partition is packed in segments of about
``segment`` tokens, which bounds a task's memory. A segment ends with a
document, and its last sequences are cut to powers of two, so it leaves no
padding of its own.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import pick, python_ready
from strata.llm.tokens import encoder

SIZE = 1024
SEPARATOR = 0
SEGMENT = 1 << 20
SENTENCE_CUT = 2.0
TOKEN_CUT = 8.0
SEQUENCE_COST = 4.0
LEAST_POWER = 128
# no cut is further from the next than this
REACH = 16


def candidates(ids: np.ndarray, doc_ends: np.ndarray, sentence_end: np.ndarray, size: int = SIZE,
               sentence_cut: float = SENTENCE_CUT, token_cut: float = TOKEN_CUT,
               reach: int = REACH) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a sequence may end (0 and the end included), and the
    penalty of each."""
    n = len(ids)
    allowed = sentence_end[ids]
    cost = np.where(allowed, sentence_cut, token_cut)
    allowed[max(0, n - size):] = True
    allowed[doc_ends - 1] = True
    cost[doc_ends - 1] = 0.0
    at = np.flatnonzero(allowed) + 1
    gaps = np.diff(at, prepend=0)
    far = np.flatnonzero(gaps > reach)
    if len(far):  # fill long stretches without a sentence's end
        fill = [np.arange(at[k] - gaps[k] + reach, at[k], reach) for k in far]
        at = np.sort(np.concatenate([at, *fill]))
    return np.concatenate(([0], at)), np.concatenate(([0.0], cost[at - 1]))


def choose_cuts(pos: np.ndarray, penalty: np.ndarray, size: int = SIZE,
                sequence_cost: float = SEQUENCE_COST, least_power: int = LEAST_POWER) -> list[int]:
    """Indices into ``pos`` of the ends of the sequences of least total cost."""
    n = len(pos)
    exact: dict[int, list[int]] = {}  # cut -> cuts a power of two before it
    power = 1
    while power < size:
        # small powers only for the tail, where every position may be cut
        lo = 0 if power >= least_power else int(np.searchsorted(pos, pos[-1] - size))
        want = pos[lo:] - power
        at = np.searchsorted(pos, want)
        ok = np.flatnonzero((want >= 0) & (pos[np.minimum(at, n - 1)] == want))
        for j, i in zip((ok + lo).tolist(), at[ok].tolist()):
            exact.setdefault(j, []).append(i)
        power *= 2
    p, pen = pos.tolist(), penalty.tolist()
    f, back = [0.0] * n, [0] * n
    queue: deque[tuple[float, int]] = deque()
    for j in range(1, n):
        i = j - 1
        value = f[i] + p[i]
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, i))
        at = p[j]
        while p[queue[0][1]] < at - size:
            queue.popleft()
        least, arg = queue[0]
        least += size - at
        for i in exact.get(j, ()):
            if f[i] < least:
                least, arg = f[i], i
        f[j] = least + pen[j] + sequence_cost
        back[j] = arg
    cuts, j = [], n - 1
    while j:
        cuts.append(j)
        j = back[j]
    return cuts[::-1]


def pack_segment(docs: list[tuple[int | None, np.ndarray]], sentence_end: np.ndarray, size: int = SIZE,
                 **costs: float) -> list[tuple]:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence, offset)
    of one segment; docs are (doc_id, ids with the separator)."""
    ids = np.concatenate([d[1] for d in docs])
    lengths = np.array([len(d[1]) for d in docs])
    ends = np.cumsum(lengths)
    pos, penalty = candidates(ids, ends, sentence_end, size, **costs)
    windows = pos[np.concatenate(([0], choose_cuts(pos, penalty, size)))]
    starts = ends - lengths
    cut = np.union1d(starts, windows)  # ends with the segment's end
    begin, length = cut[:-1], np.diff(cut)
    doc = np.searchsorted(ends, begin, side="right")
    seq = np.searchsorted(windows, begin, side="right") - 1
    data = ids.astype("<u4").tobytes()
    return [(docs[d][0], a - s, n, zlib.crc32(data[4 * a:4 * (a + n)]), t, w, a - o)
            for d, a, s, n, t, w, o in zip(
                doc.tolist(), begin.tolist(), starts[doc].tolist(), length.tolist(),
                lengths[doc].tolist(), seq.tolist(), windows[seq].tolist())]


SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def pack(docs: DataFrame, vocabulary: str, size: int = SIZE, separator: int = SEPARATOR,
         segment: int = SEGMENT, sentence_cut: float = SENTENCE_CUT, token_cut: float = TOKEN_CUT,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start (the document's ids before it), length,
    ids_crc32 (of the ids as little-endian unsigned 32-bit), doc_tokens (with
    the separator), sequence_id, offset (in the sequence, gapless from 0).

    Pieces of a document follow each other; each id lies in one piece. A
    sequence is padded to ``size`` unless its length is a power of two. A null
    or empty text is its separator alone. Repeated rows and rows with a null
    doc_id are packed like any other. An empty table gives an empty result."""
    python_ready(docs.sparkSession, 256)
    costs = {"sentence_cut": sentence_cut, "token_cut": token_cut}
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        ends = enc.sentence_ends()
        first = TaskContext.get().partitionId() << 40
        held, n = [], 0

        def flush() -> pa.RecordBatch:
            nonlocal held, n, first
            rows = pack_segment(held, ends, size, **costs)
            columns = [list(c) for c in zip(*rows)]
            last = columns[5][-1] + 1
            columns[5] = [first + w for w in columns[5]]
            held, n, first = [], 0, first + last
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        for batch in batches:
            keys = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for k, ids in zip(keys, enc.encode(texts)):
                held.append((k, np.append(ids, np.uint32(separator))))
                n += len(ids) + 1
                if n >= segment:
                    yield flush()
        if held:
            yield flush()

    src = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return src.mapInArrow(run, SCHEMA)
