"""Toxicity scores by a small convolutional text classifier.

A text is a sequence of words. A word's embedding is the sum of two hashed
ones, of the word and of its beginning, so that inflected forms share what they
begin with. Filters of several widths slide over the sequence, each filter's
maximum over the whole text (max pooling) enters a logistic output. The model
learns from all labelled rows that it may see: beyond the size of one shard the
tasks train on their shards of them and their weights are averaged after each
pass. Scores are then calibrated on rows left out of the fit, and a threshold is
chosen per language there. Only words enter a score.

Scoring streams over the texts: long ones go through the filters in blocks, so
a task's memory does not depend on the length of a text.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import discard, keep, pick, python_ready

# Texts and words that one process trains on. No more labelled rows than that are
# fitted in one place, more of them in shards of about that size.
SHARD_TEXTS = 6000
SHARD_WORDS = 4_000_000
# shards at most (they grow beyond that), passes over them, rows of a training step
MAX_SHARDS = 256
ROUNDS = 4
BATCH = 64
# a step ends at this many words too
STEP_WORDS = 1 << 19
# embeddings that travel together when the shards' changes are averaged, and the
# number of the other weights beside the two tables
CHUNK = 512
OTHERS = 2
# scores are counted in this many bins when thresholds are chosen from shards
BINS = 1 << 12
# If a caller bounds the words, texts of more than this share of them come after
# all others, so they take no room from them.
LONG_SHARE = 1 / 50

WORD_BUCKETS = 1 << 17
BEGIN_BUCKETS = 1 << 15
BEGIN_BYTES = 4
DIM = 12
WIDTHS = (1, 2, 3)
FILTERS = 8
# steps of the fit, about; an epoch is a pass over the training texts
STEPS = 1500
EPOCHS = (12, 48)
# share of the words that a training step leaves out of its texts
DROPOUT = 0.5
# words in fewer training texts have no embedding of their own
LEAST_TEXTS = 3
# words handed to the filters at once
BLOCK = 1 << 15

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x61, 0x7B), *range(0x80, 0x100), *range(0x30, 0x3A), 0x27]] = True
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


# first and second bytes of the UTF-8 characters of scripts without blanks (kana,
# Chinese, Thai, Lao, Myanmar, Khmer): each character is a word of its own
_UNSPACED = np.zeros(1 << 16, bool)
for _first, _low, _high in ((0xE0, 0xB8, 0xBB), (0xE1, 0x80, 0x82), (0xE1, 0x9E, 0x9F), (0xE3, 0x81, 0x83),
                            (0xE3, 0x90, 0xBF), *[(b, 0x80, 0xBF) for b in range(0xE4, 0xEA)],
                            (0xEF, 0xA4, 0xAB), (0xF0, 0xA0, 0xB3)):
    _UNSPACED[_first << 8 | _low:(_first << 8 | _high) + 1] = True


def _edges(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words start and end."""
    inside = _LETTER[raw]
    edge = np.flatnonzero(np.diff(inside, prepend=False))
    start, end = edge[::2], edge[1::2]
    lead = np.flatnonzero(raw[:-1] >= 0xE0)
    lead = lead[_UNSPACED[raw[lead].astype(np.int32) << 8 | raw[lead + 1]]]
    if not len(lead):
        return start, end
    after = lead + np.where(raw[lead] >= 0xF0, 4, 3)
    first = np.unique(np.concatenate([start, lead, after[inside[np.minimum(after, len(raw) - 1)]]]))
    # a word ends where the next one starts, or where its run of letters ends
    run = end[np.searchsorted(end, first, side="right")]
    return first, np.minimum(run, np.append(first[1:], len(raw)))


def word_buckets(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word bucket, beginning's bucket) of every word of the UTF-8 texts one
    after another, and how many words each text has. All bytes of a word enter
    its bucket; in scripts without blanks a character is a word."""
    data = b" ".join([(t or b"").translate(_LOWER) for t in texts]) + b" " * 17
    raw = np.frombuffer(data, np.uint8)
    start, end = _edges(raw)
    upto = np.cumsum([len(t or b"") + 1 for t in texts])
    counts = np.diff(np.searchsorted(start, upto), prepend=0)
    size = (end - start).astype(np.int64)
    if not len(start):
        return np.zeros(0, np.int32), np.zeros(0, np.int32), counts
    windows = np.lib.stride_tricks.sliding_window_view(raw, 16)
    both = windows[start].view(np.uint64)
    mask = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    low, high = both[:, 0], both[:, 1] & mask[np.clip(size - 8, 0, 8)]
    begin = low & mask[np.minimum(size, BEGIN_BYTES)]
    low = low & mask[np.minimum(size, 8)]
    with np.errstate(over="ignore"):
        h = (low ^ (low >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ high ^ size.astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
        k, more = 16, np.flatnonzero(size > 16)
        while len(more):  # the further blocks of long words
            part = windows[start[more] + k].view(np.uint64)
            rest = size[more] - k
            low = part[:, 0] & mask[np.minimum(rest, 8)]
            high = part[:, 1] & mask[np.clip(rest - 8, 0, 8)]
            mixed = ((h[more] ^ (h[more] >> np.uint64(29))) + low) * np.uint64(0x9E3779B97F4A7C15)
            h[more] = ((mixed ^ (mixed >> np.uint64(32))) + high) * np.uint64(0xC2B2AE3D27D4EB4F)
            k, more = k + 16, more[rest > 16]
        g = (begin ^ (begin >> np.uint64(17))) * np.uint64(0x9E3779B97F4A7C15)
    return ((h >> np.uint64(40)).astype(np.int32) % WORD_BUCKETS,
            (g >> np.uint64(40)).astype(np.int32) % BEGIN_BUCKETS, counts)


@dataclass
class Cnn:
    """Weights; ``conv[k]`` is (width, DIM, FILTERS). ``scale`` and ``shift``
    calibrate the output, ``thresholds`` are the languages' own."""
    words: np.ndarray
    begins: np.ndarray
    conv: list[np.ndarray]
    conv_bias: list[np.ndarray]
    out: np.ndarray
    bias: float
    scale: float = 1.0
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5

    @classmethod
    def new(cls, seed: int = 11) -> Cnn:
        rng = np.random.default_rng(seed)
        normal = lambda sd, *s: rng.normal(0, sd, s).astype(np.float32)
        return cls(normal(0.05, WORD_BUCKETS, DIM), normal(0.05, BEGIN_BUCKETS, DIM),
                   [normal(0.3, w, DIM, FILTERS) for w in WIDTHS],
                   [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
                   normal(0.15, len(WIDTHS) * FILTERS), -1.0)

    def pooled(self, word: np.ndarray, begin: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Max-pooled filter outputs of each text (0 where no window fits)."""
        top = np.full((len(counts), len(WIDTHS) * FILTERS), -np.inf, np.float32)
        ends = np.cumsum(counts)
        reach = max(WIDTHS) - 1
        weights = np.hstack([c[k] for c in self.conv for k in range(c.shape[0])])
        for a in range(0, len(word), BLOCK):
            b = min(a + BLOCK + reach, len(word))
            x = self.words[word[a:b]] + self.begins[begin[a:b]]
            z = x @ weights
            own = min(BLOCK, len(word) - a)
            doc = np.searchsorted(ends, np.arange(a, a + own), side="right")
            left = ends[doc] - np.arange(a, a + own)  # words to the text's end
            docs, first = np.unique(doc, return_index=True)
            column = 0
            for i, width in enumerate(WIDTHS):
                y = np.full((own, FILTERS), -np.inf, np.float32)
                m = min(own, b - a - width + 1)
                if m > 0:
                    y[:m] = z[:m, column:column + FILTERS]
                    for k in range(1, width):
                        y[:m] += z[k:k + m, column + k * FILTERS:column + (k + 1) * FILTERS]
                if width > 1:
                    y[left < width] = -np.inf
                column += width * FILTERS
                best = np.maximum.reduceat(y, first, axis=0)
                s = slice(i * FILTERS, (i + 1) * FILTERS)
                top[docs, s] = np.maximum(top[docs, s], best)
        bias = np.concatenate(self.conv_bias)
        return np.where(np.isfinite(top), np.maximum(top + bias, 0), 0)

    def raw(self, word: np.ndarray, begin: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.pooled(word, begin, counts).astype(np.float64) @ self.out + self.bias

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        z = self.raw(*word_buckets(texts))
        return 1 / (1 + np.exp(-np.clip(self.scale * z + self.shift, -30, 30)))


def _step(model: Cnn, state: dict, word, begin, counts, label, weight, rate: float) -> None:
    """One Adam step on a mini-batch. Only the windows that won the pooling
    carry gradient, so the way back costs little."""
    starts = np.cumsum(counts) - counts
    x = model.words[word] + model.begins[begin]
    n, f = len(counts), FILTERS
    pool = np.zeros((n, len(WIDTHS) * f), np.float32)
    arg = np.zeros((n, len(WIDTHS) * f), np.int64)
    doc = np.repeat(np.arange(n), counts)
    left = np.repeat(starts + counts, counts) - np.arange(len(word))
    for i, width in enumerate(WIDTHS):
        y = np.full((len(word), f), -np.inf, np.float32)
        m = len(word) - width + 1
        if m > 0:
            y[:m] = sum(x[k:k + m] @ model.conv[i][k] for k in range(width))
        y[left < width] = -np.inf
        some = np.flatnonzero(counts)
        best = np.maximum.reduceat(y, starts[some], axis=0) if len(some) else np.zeros((0, f))
        s = slice(i * f, (i + 1) * f)
        pool[some, s] = np.where(np.isfinite(best), np.maximum(best + model.conv_bias[i], 0), 0)
        full = np.full((n, f), np.inf, np.float32)
        full[some] = best
        rows, cols = np.nonzero((y == full[doc]) & np.isfinite(y))
        arg[doc[rows][::-1], i * f + cols[::-1]] = rows[::-1]  # the first of equal ones
    p = 1 / (1 + np.exp(-np.clip(pool @ model.out + model.bias, -30, 30)))
    d = ((p - label) * weight / weight.sum()).astype(np.float32)
    grads = {"out": pool.T @ d + 1e-4 * model.out, "bias": np.array([d.sum()])}
    up = d[:, None] * model.out[None, :] * (pool > 0)
    gx: list[tuple[np.ndarray, np.ndarray]] = []
    for i, width in enumerate(WIDTHS):
        g = up[:, i * f:(i + 1) * f]
        a = arg[:, i * f:(i + 1) * f]
        grads[f"bias{i}"] = g.sum(0)
        gw = np.zeros_like(model.conv[i])
        for j in range(f):
            hit = np.flatnonzero(g[:, j])
            for k in range(width):
                at = a[hit, j] + k
                gw[k, :, j] = x[at].T @ g[hit, j]
                gx.append((at, g[hit, j][:, None] * model.conv[i][k, :, j][None, :]))
        grads[f"conv{i}"] = gw
    at = np.concatenate([t[0] for t in gx])
    gv = np.concatenate([t[1] for t in gx])
    state["t"] += 1
    t = state["t"]

    def adam(key, value, grad, rows=None):
        m, v = state.setdefault(key, (np.zeros_like(value), np.zeros_like(value)))
        r = slice(None) if rows is None else rows
        m[r] = 0.9 * m[r] + 0.1 * grad
        v[r] = 0.99 * v[r] + 0.01 * grad ** 2
        value[r] -= rate * (m[r] / (1 - 0.9 ** t)) / (np.sqrt(v[r] / (1 - 0.99 ** t)) + 1e-7)

    for key, table, bucket in (("words", model.words, word), ("begins", model.begins, begin)):
        trained = state[key][bucket[at]]
        rows, back = np.unique(bucket[at[trained]], return_inverse=True)
        grad = np.zeros((len(rows), DIM), np.float32)
        np.add.at(grad, back, gv[trained])
        adam(f"{key} moments", table, grad, rows)
    for i in range(len(WIDTHS)):
        adam(f"conv{i}", model.conv[i], grads[f"conv{i}"])
        adam(f"bias{i}", model.conv_bias[i], grads[f"bias{i}"])
    adam("out", model.out, grads["out"])
    b = np.array([model.bias])
    adam("bias", b, grads["bias"])
    model.bias = float(b[0])


def fit(texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, langs: list[str | None],
        seed: int = 11, threshold: float = 0.5) -> Cnn:
    """A model of labelled texts (their buckets). Four fifths train it; on the
    others the output is calibrated (a logistic curve of the raw score) and
    each language's threshold chosen by F1, where it has enough labels. With
    labels of one kind only, the score is their smoothed share everywhere."""
    rng = np.random.default_rng(seed)
    model = Cnn.new(seed)
    model.threshold = threshold
    n, ones = len(labels), int(labels.sum()) if len(labels) else 0
    if not ones or ones == n:
        return _constant(n, ones, threshold)
    order = rng.permutation(n)
    held = np.zeros(n, bool)
    for kind in (0, 1):  # a fifth of either label
        some = order[labels[order] == kind]
        held[some[:len(some) // 5]] = True
    train, rest = np.flatnonzero(~held), np.flatnonzero(held)
    weight = np.where(labels == 1, min(8.0, (n - ones) / ones) ** 0.5, 1.0)
    lengths = np.array([len(t[0]) for t in texts])
    if not len(rest) or labels[rest].min() == labels[rest].max():
        rest = np.arange(n)  # too few labels to leave any out
    model.words[_rare([texts[i][0] for i in train], WORD_BUCKETS)] = 0
    model.begins[_rare([texts[i][1] for i in train], BEGIN_BUCKETS)] = 0
    y = labels[rest].astype(np.float64)
    state: dict = {"t": 0, "words": model.words.any(axis=1), "begins": model.begins.any(axis=1)}
    size = int(np.clip(len(train) // 30, 8, 64))
    epochs = int(np.clip(STEPS * size // max(1, len(train)), *EPOCHS))
    best = (np.inf, None)
    for epoch in range(epochs):
        shuffled = rng.permutation(train)
        rate = 0.02 * (1 - epoch / epochs) + 0.001
        for a in range(0, len(shuffled), size):
            some = shuffled[a:a + size]
            word, begin = (np.concatenate([texts[i][k] for i in some]) for k in (0, 1))
            left = rng.random(len(word)) >= DROPOUT
            counts = np.bincount(np.repeat(np.arange(len(some)), lengths[some])[left], minlength=len(some))
            if left.any():
                _step(model, state, word[left], begin[left], counts, labels[some].astype(np.float32),
                      weight[some].astype(np.float32), rate)
        z = _raw(model, texts, rest)
        loss = (np.logaddexp(0, z) - y * z).mean()
        if loss < best[0]:  # the epoch that does best on the rows left out is kept
            best = (loss, copy.deepcopy(model))
    model = best[1] or model
    z = _raw(model, texts, rest)
    # Platt's targets keep the curve finite where the classes are separated
    pos, neg = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps, damped
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - target) * z).sum() + 1e-3 * (a - 1), (p - target).sum()])
        h = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-9]])
        move = np.clip(np.linalg.solve(h, g), -1, 1)
        a, b = max(1e-3, a - move[0]), b - move[1]
        if np.abs(move).max() < 1e-8:
            break
    model.scale, model.shift = float(a), float(b)
    score = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
    model.threshold = _best(score, y, threshold)
    lang = np.array([str(langs[i]) for i in rest])
    for k in np.unique(lang):
        own = lang == k
        if y[own].sum() >= 5 and (1 - y[own]).sum() >= 5:
            model.thresholds[str(k)] = _best(score[own], y[own], model.threshold)
    return model


def _constant(n: int, ones: int, threshold: float) -> Cnn:
    """The model of labels of one kind only."""
    model = Cnn.new()
    model.threshold = threshold
    model.out[:] = 0
    model.bias = float(np.log((ones + 0.5) / (n - ones + 0.5))) if n else -3.0
    return model


def _rare(buckets: list[np.ndarray], n: int) -> np.ndarray:
    """Which buckets occur in fewer than LEAST_TEXTS texts."""
    count = np.zeros(n, np.int64)
    for b in buckets:
        count[np.unique(b)] += 1
    return count < LEAST_TEXTS


def _raw(model: Cnn, texts: list[tuple[np.ndarray, np.ndarray]], some: np.ndarray) -> np.ndarray:
    """Raw scores of some texts."""
    return model.raw(np.concatenate([texts[i][0] for i in some]), np.concatenate([texts[i][1] for i in some]),
                     np.array([len(texts[i][0]) for i in some]))


def _best(score: np.ndarray, y: np.ndarray, near: float) -> float:
    """Threshold of the best F1, the middle of the gap it lies in; of equally
    good ones the one nearest to ``near``."""
    values = np.unique(score)
    cuts = np.concatenate([(values[:-1] + values[1:]) / 2, [near]])
    f1 = np.array([2 * ((score >= c) & (y == 1)).sum() / max(1, (score >= c).sum() + y.sum()) for c in cuts])
    best = cuts[f1 >= f1.max() - 1e-12]
    return float(best[np.argmin(np.abs(best - near))])


def held_out(doc_id: Column) -> Column:
    """Rows whose labels no model may see."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def _fitting(sizes: list[tuple[int, int, int]], max_words: int) -> set[int]:
    """Ids of the texts (id, label, words) that hold ``max_words`` words
    together. A text that does not fit is left out alone. The first text of
    either label that fits half the words comes first, then the texts of up to
    LONG_SHARE of the words, then longer ones, each in the order given."""
    firsts = [next((t for t in sizes if t[1] == kind and 2 * t[2] <= max_words), None) for kind in (0, 1)]
    short = [t for t in sizes if t[2] <= LONG_SHARE * max_words]
    firsts = [next((t for t in short if t[1] == kind), first) for kind, first in enumerate(firsts)]
    out: set[int] = set()
    left = max_words
    for i, _, n in [*filter(None, firsts), *short, *sizes]:
        if i not in out and n <= left:
            out.add(i)
            left -= n
    return out


def _shard_weights(model: Cnn) -> list[np.ndarray]:
    return [model.words, model.begins, *model.conv, *model.conv_bias, model.out, np.array([model.bias])]


def _pass(model: Cnn, rows: Iterator[tuple], weights: tuple[float, float], trained: tuple, rate: float,
          seed: int) -> tuple[int, list[np.ndarray]]:
    """Texts of a shard that trained and the weights after it, less those before."""
    rng = np.random.default_rng(seed)
    before = _shard_weights(copy.deepcopy(model))
    state: dict = {"t": 0, "words": trained[0], "begins": trained[1]}
    n, some, size = 0, [], 0

    def step():
        word, begin = (np.concatenate([t[k] for t in some]) for k in (0, 1))
        label = np.array([t[2] for t in some], np.float32)
        left = rng.random(len(word)) >= DROPOUT
        own = np.repeat(np.arange(len(some)), [len(t[0]) for t in some])
        if left.any():
            _step(model, state, word[left], begin[left], np.bincount(own[left], minlength=len(some)), label,
                  np.where(label == 1, *weights).astype(np.float32), rate)

    for word, begin, toxic in rows:
        if some and (len(some) == BATCH or size + len(word) > STEP_WORDS):
            step()
            some, size = [], 0
        some.append((word, begin, toxic))
        n, size = n + 1, size + len(word)
    if some:
        step()
    return n, [x - y for x, y in zip(_shard_weights(model), before)]


def _chunks(what: int, at: np.ndarray, values: np.ndarray) -> Iterator[tuple]:
    """The rows ``at`` (ascending) of table ``what``, by chunk: ((what, chunk), (at, values))."""
    cuts = np.flatnonzero(np.diff(at // CHUNK)) + 1
    for some, own in zip(np.split(at, cuts), np.split(values, cuts)):
        if len(some):
            yield (what, int(some[0]) // CHUNK), (some.astype(np.int32), own)


def _folded(shards: RDD, run, fold) -> dict:
    """``run(shard, its rows)`` yields keys and values; ``fold(key, values)``, the
    values in the shards' order, makes one of them in a task. The driver gets
    these alone, so what it gets does not grow with the shards."""
    def task(shard, rows):
        return ((key, (shard, value)) for key, value in run(shard, rows))

    def one(item):
        return item[0], fold(item[0], [v for _, v in sorted(item[1], key=lambda t: t[0])])

    return dict(shards.mapPartitionsWithIndex(task).groupByKey(shards.getNumPartitions()).map(one).collect())


def _common(key: tuple, values: list[tuple]) -> np.ndarray:
    """Rows of a chunk that ``LEAST_TEXTS`` texts or more have, from the shards' counts."""
    total = np.zeros(CHUNK, np.int64)
    for at, count in values:
        total[at % CHUNK] += count
    return np.flatnonzero(total >= LEAST_TEXTS) + key[1] * CHUNK


def _mean_move(key: tuple, values: list[tuple]):
    """The shards' mean changes: of a chunk of embeddings (rows, changes), each by
    the shards that changed it; of the other weights by their texts."""
    if key[0] == OTHERS:
        n = max(1, sum(count for count, _ in values))
        return [sum(count * m.astype(np.float64) for (count, _), m in zip(values, own)) / n
                for own in zip(*(moves for _, moves in values))]
    total, touched = np.zeros((CHUNK, DIM)), np.zeros(CHUNK, np.int64)
    for at, move in values:
        total[at % CHUNK] += move
        touched[at % CHUNK] += 1
    some = np.flatnonzero(touched)
    return some + key[1] * CHUNK, (total[some] / touched[some][:, None]).astype(np.float32)


def _moved(model: Cnn, moves: dict) -> Cnn:
    """``model`` moved by the shards' mean changes."""
    out = copy.deepcopy(model)
    others = moves.pop((OTHERS, 0))
    for (what, _), (at, move) in moves.items():
        (out.words, out.begins)[what][at] += move
    new = [(w + m).astype(w.dtype) for w, m in zip(_shard_weights(model)[2:], others)]
    k = len(WIDTHS)
    out.conv, out.conv_bias, out.out, out.bias = new[:k], new[k:2 * k], new[2 * k], float(new[-1][0])
    return out


def _texts(rows: Iterator, held: int) -> Iterator[tuple]:
    """(words, beginnings, label, lang) of the coded texts of one part."""
    for r in rows:
        if r.held == held:
            both = np.frombuffer(r.w, "<u4")
            yield (both // BEGIN_BUCKETS).astype(np.int32), (both % BEGIN_BUCKETS).astype(np.int32), r.toxic, r.lang


def fit_shards(coded: DataFrame, n: int, ones: int, seed: int = 11, threshold: float = 0.5) -> Cnn:
    """:func:`fit` over the partitions of ``coded`` (columns of ``_coded``), each
    a shard in a fixed order. A pass trains every shard from the same weights and
    averages what they became. All rows count for rare words, all left-out rows
    (of ``held``) for calibration; thresholds are searched among ``BINS`` scores."""
    spark = coded.sparkSession
    shards = coded.rdd  # one RDD, so every pass reads the same shuffle files
    model = Cnn.new(seed)
    weights = (min(8.0, (n - ones) / ones) ** 0.5, 1.0)

    def texts_with(_, rows):
        count = [np.zeros(WORD_BUCKETS, np.int64), np.zeros(BEGIN_BUCKETS, np.int64)]
        for word, begin, _, _ in _texts(rows, 0):
            count[0][np.unique(word)] += 1
            count[1][np.unique(begin)] += 1
        for what, own in enumerate(count):
            at = np.flatnonzero(own)
            yield from _chunks(what, at, own[at])

    trained = np.zeros(WORD_BUCKETS, bool), np.zeros(BEGIN_BUCKETS, bool)
    for (what, _), at in _folded(shards, texts_with, _common).items():
        trained[what][at] = True
    for table, mask in zip((model.words, model.begins), trained):
        table[~mask] = 0

    def loss_of(sent):
        def run(rows):
            total, texts = 0.0, 0
            for word, begin, toxic, _ in _texts(rows, 1):
                z = sent.value.raw(word, begin, np.array([len(word)]))[0]
                total, texts = total + float(np.logaddexp(0, z) - toxic * z), texts + 1
            yield total, texts
        return run

    best = (np.inf, model)
    for turn in range(ROUNDS):
        sent = spark.sparkContext.broadcast((model, trained))
        rate = 0.02 * (1 - turn / ROUNDS) + 0.001

        def one(shard, rows, sent=sent, rate=rate, turn=turn):
            start, masks = sent.value
            texts = ((w, b, t) for w, b, t, _ in _texts(rows, 0))
            count, moves = _pass(copy.deepcopy(start), texts, weights, masks, rate, seed + 1000 * turn + shard)
            for what, move in enumerate(moves[:2]):
                at = np.flatnonzero(move.any(axis=1))
                yield from _chunks(what, at, move[at])
            yield (OTHERS, 0), (count, moves[2:])

        model = _moved(model, _folded(shards, one, _mean_move))
        sent.destroy()
        sent = spark.sparkContext.broadcast(model)
        loss = np.array(shards.mapPartitions(loss_of(sent)).collect()).sum(axis=0)  # two numbers a shard
        if loss[0] / max(1, loss[1]) < best[0]:
            best = (loss[0] / max(1, loss[1]), model)
        sent.destroy()
    model = best[1]
    sent = spark.sparkContext.broadcast(model)

    def outputs(rows):
        for word, begin, toxic, lang in _texts(rows, 1):
            yield float(sent.value.raw(word, begin, np.array([len(word)]))[0]), toxic, str(lang)

    scored = keep(spark.createDataFrame(shards.mapPartitions(outputs), "z double, y int, lang string"), "train-scores")
    sent.destroy()
    try:
        return _calibrated(model, scored, threshold)
    finally:
        discard(scored)


def _calibrated(model: Cnn, scored: DataFrame, threshold: float) -> Cnn:
    """``model`` with scale, shift and thresholds from the raw scores ``z`` of the left-out rows."""
    pos, neg = scored.agg(F.coalesce(F.sum("y"), F.lit(0)), F.coalesce(F.sum(1 - F.col("y")), F.lit(0))).first()
    if not pos or not neg:
        return model
    # Platt's targets, as in ``fit``; each Newton step is an aggregate over all left-out rows
    target = F.when(F.col("y") == 1, (pos + 1) / (pos + 2)).otherwise(1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), a * F.col("z") + b))))
        w = F.greatest(p * (1 - p), F.lit(1e-9))
        z = F.col("z")
        g0, g1, h0, h1, h2 = scored.agg(F.sum((p - target) * z), F.sum(p - target), F.sum(w * z * z),
                                        F.sum(w * z), F.sum(w)).first()
        move = np.clip(np.linalg.solve([[h0 + 1e-3, h1], [h1, h2 + 1e-9]], [g0 + 1e-3 * (a - 1), g1]), -1, 1)
        a, b = max(1e-3, a - float(move[0])), b - float(move[1])
        if np.abs(move).max() < 1e-6:
            break
    model.scale, model.shift = a, b
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), a * F.col("z") + b))))
    counts = (scored.groupBy("lang", F.floor(score * BINS).cast("int").alias("bin"))
              .agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")).collect())  # BINS rows a language
    of = {}
    for r in counts:
        for key in (None, r.lang):
            both = of.setdefault(key, np.zeros((BINS + 1, 2), np.int64))
            both[r.bin] += r.pos, r.neg
    model.threshold = _best_bin(of.pop(None), threshold)
    for lang, both in of.items():
        if both.sum(axis=0).min() >= 5:
            model.thresholds[lang] = _best_bin(both, model.threshold)
    return model


def _best_bin(counts: np.ndarray, near: float) -> float:
    """:func:`_best` from the (positive, negative) scores counted in each bin."""
    above = counts[::-1].cumsum(axis=0)[::-1]  # rows that a cut at a bin's lower edge flags
    f1 = 2 * above[:, 0] / np.maximum(1, above.sum(axis=1) + counts[:, 0].sum())
    best = np.flatnonzero(f1 >= f1.max() - 1e-12) / BINS
    return float(best[np.argmin(np.abs(best - near))])


def _coded(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The labelled documents, one per doc_id, as word buckets ``w`` (a word's and
    its beginning's in one number): doc_id, toxic, lang, n (words), w."""
    src = pick(docs, doc_id="doc_id", text="text", lang="lang")
    # copies are combined before they travel, the join and the coding follow in place:
    # each text is shuffled once. The labels grow with the corpus: never broadcast
    texts = src.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "lang")).alias("t"))
    rows = texts.join(chosen.hint("merge"), "doc_id").select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") > 0).cast("int").alias("toxic"),
        "t.lang", "t.text")

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, begin, counts = word_buckets(batch.column(3).cast(pa.binary()).to_pylist())
            both = (word.astype("<u4") * np.uint32(BEGIN_BUCKETS) + begin.astype("<u4")).astype("<u4")
            at = np.cumsum(counts) - counts
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(counts, pa.int64()),
                 pa.array([both[a:a + n].tobytes() for a, n in zip(at, counts)], pa.binary())],
                ["doc_id", "toxic", "lang", "n", "w"])

    return rows.mapInArrow(buckets, "doc_id long, toxic int, lang string, n long, w binary")


def train(docs: DataFrame, labels: DataFrame, max_train: int | None = None,
          max_words: int | None = None, threshold: float = 0.5) -> Cnn:
    """A model from all labelled documents outside the held-out part, whole texts.
    Up to ``SHARD_TEXTS`` texts of ``SHARD_WORDS`` words in all are fitted in one
    place, more of them in shards (:func:`fit_shards`). Null labels and ids are
    left out, and a doc_id with labels of both kinds counts as toxic.

    A caller may bound the fit to the ``max_train`` documents with the smallest
    hashes of doc_id, or to ``max_words`` words (see ``_fitting``). Such a choice of
    one kind only, where the labelled documents have both, raises ValueError: that
    model tells nothing apart. Where they have one kind only, all score alike."""
    spark = docs.sparkSession
    python_ready(spark)
    usable = (pick(labels, doc_id="doc_id", toxic="toxic").where("doc_id is not null and toxic is not null")
              .where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    chosen = usable
    if max_train is not None:
        chosen = keep(usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train), "train-labels")
    kept = coded = keep(_coded(docs, chosen), "train-texts")
    try:
        if max_words is not None:
            sizes = coded.select(F.xxhash64("doc_id").alias("h"), "doc_id", "toxic", "n").collect()
            fits = _fitting([(r.doc_id, r.toxic, r.n) for r in sorted(sizes)], max_words)
            ids = spark.createDataFrame([(i,) for i in sorted(fits)], "doc_id long")
            coded = coded.join(F.broadcast(ids), "doc_id", "left_semi")
        n, ones, words = coded.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0)),
                                   F.coalesce(F.sum("n"), F.lit(0))).first()
        if (max_train is not None or max_words is not None) and ones in (0, n):
            kinds = usable.join(pick(docs, doc_id="doc_id"), "doc_id", "left_semi").select(F.col("toxic") > 0).distinct()
            if kinds.count() == 2:
                raise ValueError(f"the training sample of {n} texts lacks one of the two labels; "
                                 f"raise max_train ({max_train}) or max_words ({max_words})")
        if ones in (0, n):  # nothing to tell apart: the smoothed share of either label
            return _constant(n, ones, threshold)
        if n <= SHARD_TEXTS and words <= SHARD_WORDS:
            got = coded.collect()
            got.sort(key=lambda r: r.doc_id)
            both = [np.frombuffer(r.w, "<u4") for r in got]
            texts = [((x // BEGIN_BUCKETS).astype(np.int32), (x % BEGIN_BUCKETS).astype(np.int32)) for x in both]
            return fit(texts, np.array([r.toxic for r in got]), [r.lang for r in got], threshold=threshold)
        shards = min(MAX_SHARDS, max(2, -(-n // SHARD_TEXTS), -(-words // SHARD_WORDS)))
        order = F.xxhash64("doc_id", F.lit(11))
        coded = (coded.select("toxic", "lang", "w", (F.pmod(order, F.lit(5)) == 0).cast("int").alias("held"),
                              "doc_id", order.alias("order"))
                 .repartition(shards, "doc_id").sortWithinPartitions("order", "doc_id"))
        return fit_shards(coded, n, ones, threshold=threshold)
    finally:
        discard(kept)


def add_scores(docs: DataFrame, model: Cnn, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text (a null counts as empty) as
    its last column; the other columns keep their names and places."""
    spark = docs.sparkSession
    python_ready(spark)
    sent = spark.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)
    flat = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    schema = T.StructType([*flat.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cnn = sent.value
        for batch in batches:
            scores = cnn.score(batch.column(place).cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)],
                                             [*batch.schema.names, "score"])

    return flat.mapInArrow(run, schema).toDF(*docs.columns, name)


def decision_threshold(model: Cnn, lang: Column) -> Column:
    """The calibrated threshold of a row's language, else that of all."""
    out = F.lit(model.threshold)
    for k, v in sorted(model.thresholds.items()):
        out = F.when(lang == k, F.lit(v)).otherwise(out)
    return out


def score_documents(docs: DataFrame, labels: DataFrame, cut: float = 0.7, **options) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted (score >= ``cut``), and by
    the language's own threshold ``flagged``. Null and empty texts are scored
    as texts without words; repeated rows get a row each; an empty table gives
    an empty result."""
    model = train(docs, labels, threshold=cut, **options)
    src = pick(docs, doc_id="doc_id", lang="lang", text="text")
    scored = add_scores(src, model)
    return scored.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= cut).cast("int").alias("predicted"),
        (F.col("score") >= decision_threshold(model, F.col("lang"))).alias("flagged"))


def drop_toxic(docs: DataFrame, labels: DataFrame, cut: float = 0.7, **options) -> DataFrame:
    """``docs`` without the rows that their language's threshold flags."""
    model = train(docs, labels, threshold=cut, **options)
    names = docs.columns
    scored = add_scores(docs, model).toDF(*[f"c{i}" for i in range(len(names))], "s")
    flagged = F.col("s") >= decision_threshold(model, F.col(f"c{names.index('lang')}"))
    return scored.where(~flagged).drop("s").toDF(*names)
