"""Ranked search against SQL and against scoring every pair."""
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from oracle_compare import duck, duck_digest, spark_digest

from strata.llm import lexical as L
from strata.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, top=10):
    """[(item place, rank, doc_id, score)] over all pairs."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(bool(b) for _, b in bags)
    total = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for place, (item, text) in enumerate(items):
        scored = []
        for doc, bag in bags:
            n = sum(bag.values())
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10**9 * bag[t] // (1000 * bag[t] + 8 * (10 + 90 * n * n_docs // total)))
                        for t in set(terms(text)) if bag[t])
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, r, None if none else doc, -s)
                for r, (s, none, doc) in enumerate(sorted(scored)[:top], 1)]
    return out


def shown(rows):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in rows), key=str)


def test_query_matches_oracle(spark):
    got = spark_digest(QUERIES["op11_lexical_search"](spark, SF))
    assert got == duck_digest(duck(SF), ORACLE_SQL["op11_lexical_search"])


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["Été", "日本", "x1"]
    def text(n):
        return " ".join(rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=n))
    docs = [(i, text(rng.choice([1, 5, 30, 200]))) for i in range(300)]
    docs += [(300 + i, docs[7][1]) for i in range(100)]  # a large group of copies, all of equal score
    docs += [(7, docs[7][1]), (None, docs[3][1]), (None, None), (500, ""), (501, "-- !!"), (5, text(40))]
    items = [(i, text(rng.choice([1, 4, 20]))) for i in range(25)]
    items += [(3, items[3][1]), (90, None), (91, "nowhere to be found"), (92, docs[7][1].upper())]
    return docs, items


@pytest.mark.parametrize("block_terms,rows", [(L.BLOCK_TERMS, 4096), (40, 16)])
def test_brute_force(spark, corpus, monkeypatch, block_terms, rows):
    docs, items = corpus
    monkeypatch.setattr(L, "BUCKET_ROWS", rows)
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, score string")
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    got = L.search(d.repartition(5), q, block_terms=block_terms).collect()
    assert shown(got) == sorted(brute(docs, items), key=str)


def test_result_does_not_depend_on_partitions(spark, corpus):
    docs, items = corpus
    d = spark.createDataFrame(docs, "doc_id long, text string")
    q = spark.createDataFrame(items, "item_id long, text string")
    assert shown(L.search(d.coalesce(1), q, top=3).collect()) == shown(L.search(d.repartition(40), q, top=3).collect())


def test_empty_tables(spark, corpus):
    d = spark.createDataFrame(corpus[0], "doc_id long, text string")
    q = spark.createDataFrame(corpus[1], "item_id long, text string")
    assert L.search(d.limit(0), q).count() == 0
    assert L.search(d, q.limit(0)).count() == 0


def test_bounds_prune():
    """With a score to beat, short vectors are skipped by length, and most
    others by the greatest impacts of their terms; nothing else changes."""
    rng = np.random.default_rng(3)
    rows = 2000
    held = [np.sort(rng.choice(200, 20, replace=False)) for _ in range(rows)]
    impacts = [rng.integers(1, 1000, 20) * (1 + 50 * (t < 10)) for t in held]
    ends = np.arange(rows + 1) * 20
    flat, impact = np.concatenate(held), np.concatenate(impacts)
    length = np.sqrt((impact.astype(float) ** 2).reshape(rows, 20).sum(1))
    queries = [np.arange(0, 40), np.arange(150, 190)]
    exact = [np.array([p[np.isin(t, q)].sum() for t, p in zip(held, impacts)]) for q in queries]
    best = [L.Best(10, int(np.sort(e)[-10])) for e in exact]
    left = L.search_bucket(queries, best, np.arange(rows), np.zeros(rows, np.int64), length, flat, ends, impact)
    for b, e in zip(best, exact):
        assert b.score.tolist() == np.sort(e)[::-1][:10].tolist()
    assert left["rescored"] < left["focus"] <= left["in_buckets"] == 2 * rows
    short = [L.Best(10, int(7 * length.max() ** 1) + 10**9) for _ in queries]
    left = L.search_bucket(queries, short, np.arange(rows), np.zeros(rows, np.int64), length, flat, ends, impact)
    assert left["in_buckets"] == 0
