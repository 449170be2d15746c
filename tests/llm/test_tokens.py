"""Encoding, token counts and packing against the tokenizer itself."""
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strata.llm import packing, token_counts
from strata.llm.queries import QUERIES
from strata.llm.tokens import BatchEncoder

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def slow():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def fast():
    return BatchEncoder(PATH)


def ids(slow, text):
    return slow.encode(text or "", add_special_tokens=False).ids


def test_encoder_takes_the_fast_way(fast):
    assert fast.bpe is not None


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(
    st.sampled_from(list(" \n\t'sredvmlt19.,!?aAé\xa0\x85 \x00")), st.characters(codec="utf-8")),
    max_size=40), max_size=6))
def test_any_text(slow, fast, texts):
    got = fast.encode(texts)
    assert [g.tolist() for g in got] == [ids(slow, t) for t in texts]
    assert fast.count(texts).tolist() == [len(ids(slow, t)) for t in texts]


def test_special_and_odd_texts(slow, fast):
    texts = ["", "a<|endoftext|>b", "  lead", "trail  ", "we'll he's 'sam ''s don't!'t", "\n\n x\n",
             "word" * 50, "\U0001f600 hi", "x" * 17, " " * 40, "日本語 text", "it 's", "", "a\r\n b"]
    assert [g.tolist() for g in fast.encode(texts)] == [ids(slow, t) for t in texts]


def test_every_code_point_of_the_basic_plane(slow, fast):
    texts = [f"a{chr(c)}b {chr(c)} 1{chr(c)}{chr(c)}\n{chr(c)}'s" for c in range(1, 0xD800, 3)]
    got = fast.encode(texts)
    for g, e in zip(got, slow.encode_batch(texts, add_special_tokens=False)):
        assert g.tolist() == e.ids


def test_the_cache_may_start_anew(slow, monkeypatch):
    monkeypatch.setattr("strata.llm.tokens._CACHE_MOST", 20)
    enc, rnd = BatchEncoder(PATH), random.Random(1)
    for _ in range(8):
        texts = [" ".join(rnd.choice("ab cd efg") * rnd.randint(1, 9) for _ in range(20)) for _ in range(5)]
        assert [g.tolist() for g in enc.encode(texts)] == [ids(slow, t) for t in texts]


# --- token counts --------------------------------------------------------------

def test_counts_match_brute_force(spark, slow):
    rows = {r.length: r for r in QUERIES["op3_token_counts"](spark, SF).collect()}
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    n = [len(ids(slow, t)) for t in texts]
    assert set(rows) == set(n)
    for length, r in rows.items():
        assert r.n_docs == n.count(length) and r.n_tokens == length * n.count(length)
        assert r.docs_at_least == sum(x >= length for x in n)
        assert r.tokens_at_least == sum(x for x in n if x >= length)
        assert r.truncated_total == sum(min(x, length) for x in n)
        assert r.share_upto == pytest.approx(sum(x <= length for x in n) / len(n))


def test_counts_for_any_limit(spark):
    rnd = random.Random(3)
    n = [rnd.choice([0, 0, 1, 5, 900, 1023, 1024, 1025, 5000, rnd.randint(0, 9000)]) for _ in range(400)]
    hist = spark.createDataFrame([(x, n.count(x)) for x in set(n)], "length long, n_docs long")
    sums = token_counts.suffix_sums(hist).cache()
    limits = [0, 1, 7, 1000, 1024, 4096, 10**6]
    got = {r.context: r for r in token_counts.at_limits(sums, limits).collect()}
    for x in limits:
        assert got[x].truncated_total == sum(min(v, x) for v in n)
        assert got[x].docs_cut == sum(v > x for v in n)
        assert (got[x].documents, got[x].tokens) == (len(n), sum(n))
    got = {r.share: r.length for r in token_counts.quantiles(sums, [0.1, 0.5, 0.9, 1.0]).collect()}
    for s, v in got.items():
        assert v == sorted(n)[max(0, int(np.ceil(s * len(n) - 1e-9)) - 1)]


def test_count_edge_cases(spark):
    df = spark.createDataFrame([(1, None, 1), (2, "", 2), (None, "a b", 3), (1, "a b", 4)],
                               "doc_id long, text string, length int")
    rows = {r.length: r.n_docs for r in token_counts.token_counts(df, PATH).collect()}
    assert rows == {0: 2, 2: 2}
    assert token_counts.token_counts(df.limit(0), PATH).count() == 0


# --- packing ---------------------------------------------------------------------

def check_packing(rows, docs, slow, size=1024):
    """Every id in one piece, sequences gapless and within size; the padding."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(docs)
    for d, text in docs.items():
        want = ids(slow, text) + [0]
        at = 0
        for r in sorted(by_doc[d], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(want)
            part = np.array(want[at:at + r.length], "<u4")
            assert r.ids_crc32 == zlib.crc32(part.tobytes())
            at += r.length
        assert at == len(want)
    padding = tokens = 0
    for rows in by_seq.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
        tokens += at
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding / tokens


def test_packing_query(spark, slow):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op8_packing"](spark, SF).collect()
    assert check_packing(rows, docs, slow) < 0.01


def test_packing_edge_cases(spark, slow):
    docs = {1: None, 2: "", 3: "a", 4: "word " * 9000, 5: "Kurz. Satz! Noch? " * 300, 6: "\n\n"}
    df = spark.createDataFrame([(k, v, 0) for k, v in docs.items()], "doc_id long, text string, start int")
    check_packing(packing.pack(df.coalesce(1), PATH).collect(), docs, slow)
    small = packing.pack(df.coalesce(1), PATH, size=64, segment=500).collect()
    check_packing(small, docs, slow, 64)
    assert packing.pack(df.limit(0), PATH).count() == 0
    twice = spark.createDataFrame([(7, "x y"), (7, "x y"), (None, "x y")], "doc_id long, text string")
    rows = packing.pack(twice, PATH).collect()
    assert sorted((r.doc_id or 0, r.doc_tokens) for r in rows if not r.start) == [(0, 3), (7, 3), (7, 3)]
    assert sum(r.length for r in rows) == 9


@pytest.mark.parametrize("seed", range(20))
def test_cuts_are_optimal(seed):
    """The monotone queue finds the cost of the plain quadratic program."""
    rnd, size = random.Random(seed), 32
    pos = [0]
    for _ in range(60):
        pos.append(pos[-1] + rnd.randint(1, 9))
    pen = [0.0] + [rnd.choice([0.0, 2.0, 8.0]) for _ in pos[1:]]
    f = [0.0] + [float("inf")] * (len(pos) - 1)

    def cost(i, j):
        n = pos[j] - pos[i]
        tail = pos[j] >= pos[int(np.searchsorted(pos, pos[-1] - size))] and True
        free = n in (4, 8, 16) or (n in (1, 2) and tail and j >= np.searchsorted(pos, pos[-1] - size))
        return (0 if free else size - n) + pen[j] + 1.5

    for j in range(1, len(pos)):
        f[j] = min(f[i] + cost(i, j) for i in range(j) if pos[j] - pos[i] <= size)
    cuts = packing.choose_cuts(np.array(pos), np.array(pen), size, sequence_cost=1.5, least_power=4)
    got = sum(cost(i, j) for i, j in zip([0, *cuts], cuts))
    assert cuts[-1] == len(pos) - 1 and got == pytest.approx(f[-1])
