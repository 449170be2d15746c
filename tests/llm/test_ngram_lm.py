"""The language model against one counted with dictionaries."""
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from strata.llm import ngram_lm as M
from strata.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
END, START = "</s>", "<s>"


def tokens(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [END]


class Plain:
    """Modified Kneser-Ney by the book, over tuples of words."""

    def __init__(self, texts, order):
        self.order = order
        self.raw = Counter(t for x in texts for t in tokens(x))
        counts = Counter()
        for x in texts:
            seq = [START] * (order - 1) + tokens(x)
            counts.update(tuple(seq[i - order + 1:i + 1]) for i in range(order - 1, len(seq)))
        self.levels = []
        for _ in range(order):
            d = M.discounts(*[sum(c == i for c in counts.values()) for i in range(1, 5)])
            contexts = {g: (sum(held), sum(d[min(c, 3) - 1] for c in held))
                        for g, held in self.by_context(counts).items()}
            self.levels.insert(0, (counts, d, contexts))
            counts = Counter(g[1:] for g in counts)

    @staticmethod
    def by_context(counts):
        out = defaultdict(list)
        for g, c in counts.items():
            out[g[:-1]].append(c)
        return out

    def p(self, word, context):
        p = 1 / (len(self.raw) + 1)
        for k, (counts, d, contexts) in enumerate(self.levels):
            ctx = tuple(context[len(context) - k:])
            held = contexts.get(ctx)
            if held:
                c = counts.get(ctx + (word,), 0)
                total, left = held
                p = (c - (d[min(c, 3) - 1] if c else 0) + left * p) / total
        return p

    def scores(self, text):
        seq = [START] * (self.order - 1) + tokens(text)
        at = range(self.order - 1, len(seq))
        n = sum(self.raw.values())
        base = sum(math.log10((self.raw[seq[i]] + 0.1) / (n + 0.1 * (len(self.raw) + 1))) for i in at)
        return (len(at), sum(self.raw[seq[i]] > 0 for i in at), base,
                sum(math.log10(self.p(seq[i], seq[i - self.order + 1:i])) for i in at))


def corpus():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)] + ["Été", "ÉTÉ", "日本", "The", "the", "x\x1fy", "a b"]
    text = lambda n: rng.choice([" ", "\n", "\t ", "\x0b"]).join(
        rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=n))
    docs = [text(rng.choice([1, 4, 30])) for _ in range(150)]
    docs += [docs[5]] * 60 + [None, "", "  ", "the " * 3000]
    return docs + ["entirely new words here", "the unseen w1"]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_brute_force(spark, monkeypatch, order):
    texts = corpus()
    plain = Plain(texts[:-2], order)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, score string")
    train = df.where(f"doc_id < {len(texts) - 2}").repartition(5)
    model = M.fit(train, order=order)
    assert (model.tokens, model.distinct) == (sum(plain.raw.values()), len(plain.raw))
    got = {r.doc_id: r for r in M.score(df, model).collect()}
    for i, t in enumerate(texts):
        want = plain.scores(t)
        r = got[i]
        assert (r.n_tokens, r.n_known) == want[:2]
        assert r.base_score == pytest.approx(want[2], rel=1e-9)
        assert r.score == pytest.approx(want[3], rel=1e-9)
    M.forget(spark, model)


@pytest.mark.parametrize("order", [2, 3])
def test_probabilities_add_up_to_one(order):
    plain = Plain(corpus(), order)
    for context in ([START] * 2, ["the", "the"], ["w1", "never"], ["w2", "w0"]):
        total = sum(plain.p(w, context) for w in [*plain.raw, "seen nowhere"])
        assert total == pytest.approx(1)


def test_hot_contexts_are_dealt_over_the_shards():
    hot = np.array([3])
    last = np.arange(1000, dtype=np.uint32)
    frequent, other = np.full(1000, 3, np.uint32), np.full(1000, 4, np.uint32)
    assert len(set(M.shard_of([frequent, last], 8, hot).tolist())) == 8
    assert len(set(M.shard_of([other, last], 8, hot).tolist())) == 1
    assert len(set(M.shard_of([other, frequent, last], 8, hot).tolist())) == 1


def test_small_buffers_and_slices_change_nothing(spark):
    texts = corpus()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {r.doc_id: r for r in M.held_out_scores(df.coalesce(1)).collect()}
    got = {r.doc_id: r for r in M.held_out_scores(df.repartition(17), shard_bytes=2000).collect()}
    for i, r in want.items():
        assert got[i][:5] == r[:5]
        assert got[i].score == pytest.approx(r.score, rel=1e-9)
        assert r.held_out == (zlib.crc32(str(i).encode()) % 10 == 0)


def test_query(spark):
    rows = QUERIES["op13_language_model"](spark, SF).collect()
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    plain = Plain([t for i, t in docs if zlib.crc32(str(i).encode()) % 10], M.ORDER)
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(docs)
    for i, t in docs:
        n, known, base, score = plain.scores(t)
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, sum(plain.raw.values()))
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(score, rel=1e-9)
    held = [r for r in rows if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_empty_tables_and_ids(spark):
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None)], "doc_id long, text string")
    rows = M.held_out_scores(df).collect()
    assert [r.held_out for r in rows if r.doc_id is None] == [True, True]
    assert M.held_out_scores(df.limit(0)).count() == 0
    none = M.fit(df.limit(0))
    assert {r.score for r in M.score(df, none).collect()} == {0.0}
