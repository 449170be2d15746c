"""Alignment against whole-text encodings and pairs counted one by one."""
import hashlib
import random
from collections import Counter

import duckdb
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strata.llm import alignment as A
from strata.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PATH_A, PATH_B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(PATH_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATH_B)


def tokens(both, text):
    """[(id, begin, end)] of A and of B over the bytes, or nothing."""
    a, b = both
    if not text:
        return [], []
    back, out = A.byte_level(), []
    pieces = [(i, bytes(back[c] for c in a.id_to_token(i)))
              for i in a.encode(" " + text, add_special_tokens=False).ids]
    other = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
              else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    for found in (pieces, other):
        if b"".join(x for _, x in found) != (" " + text).encode():
            return [], []
        at, spans = 0, []
        for i, x in found:
            spans.append((i, at, at + len(x)))
            at += len(x)
        out.append(spans)
    return out


def aligned(both, text):
    """(n_a, n_b, groups, links) by comparing every token with every other."""
    a, b = tokens(both, text)
    groups = [([], [])]
    cuts = {e for _, _, e in a} & {e for _, _, e in b}
    for cut in sorted(cuts):
        low = max([c for c in cuts if c < cut], default=0)
        groups.append(([i for i, s, e in a if low <= s < cut], [i for i, s, e in b if low <= s < cut]))
    shown = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups[1:])
    links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
    return len(a), len(b), len(groups) - 1, links, hashlib.sha256(shown.encode()).hexdigest() if a else ""


def brute(both, docs):
    rows = [(i, *aligned(both, t)) for i, t in docs]
    count = Counter(p for r in rows for p in r[4])
    most = Counter()
    for (_, j), n in count.items():
        most[j] = max(most[j], n)
    return [(i, na, nb, g, len(links), sum(count[p] == most[p[1]] for p in links),
             sum(count[p] for p in links), h) for i, na, nb, g, links, h in rows]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
TEXTS = ["", None, " ", "  ", "a", "foo  bar ", "trail\n", "\n lead", "a▁b", "<|endoftext|> is <s> plain",
         "日本語 の text", "tab\t x", "naïve Été\xa0end", "x" * 300, "don't stop!  'tis", "\U0001f600 ok \U0001f600",
         "\x00 nul \x00", "ﬁ ① ½", "aaa aa a", "end. Of\r\n line", "123 4567 89.0"]


def shown(rows):
    return sorted((tuple(r[c] for c in COLUMNS) for r in rows), key=str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(
    st.sampled_from(list(" \n\t'sredvmlt19.,!?aAé\xa0\x85▁ \x00_-")), st.characters(codec="utf-8")),
    max_size=30), max_size=5))
def test_parts_are_the_whole_text(both, texts):
    al = A.aligner(PATH_A, PATH_B)
    texts = [t for t in texts if t]
    for text, places in zip(texts, al.places(texts)):
        n_a, n_b, n_groups, links, digest = aligned(both, text)
        numbers = al.numbers[places]
        if not numbers[:, 3].all():
            assert n_a == 0
            continue
        assert numbers[:, :3].sum(0).tolist() == [n_a, n_b, n_groups]
        assert hashlib.sha256(";".join(al.shown[p] for p in places).encode()).hexdigest() == digest
        got = [(k >> 20, k & (1 << 20) - 1) for p in places for k in
               al.pairs[al.pairs_end[p]:al.pairs_end[p + 1]].tolist()]
        got += [(a, int(al.identity[a])) for p in places for a in al.own[al.own_end[p]:al.own_end[p + 1]].tolist()]
        assert Counter(got) == Counter(links)


@pytest.mark.parametrize("limit,most", [(A.PAIR_LIMIT, A.PARTS_MOST), (0, 3)])
def test_brute_force(spark, both, monkeypatch, limit, most):
    rng = random.Random(2)
    words = [t for t in TEXTS if t]
    docs = list(enumerate(TEXTS)) + [(100 + i, " ".join(rng.choices(words, k=8))) for i in range(40)]
    docs += [(None, "twice"), (None, "twice"), (1, "other text")] + [(500, "copy of this")] * 60
    monkeypatch.setattr(A, "PARTS_MOST", most)
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, n_a int").repartition(5)
    got = shown(A.align(df, PATH_A, PATH_B, pair_limit=limit).collect())
    assert got == sorted(brute(both, docs), key=str)


def test_query_against_brute_force(spark, both):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' WHERE length(text) < 3000").fetchall()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert shown(A.align(df, PATH_A, PATH_B).collect()) == sorted(brute(both, docs), key=str)
    whole = QUERIES["op12_tokenizer_alignment"](spark, SF)
    assert whole.columns == COLUMNS
    rows = whole.collect()
    assert len(rows) == duckdb.sql(f"SELECT count(*) FROM '{SF}/documents.parquet'").fetchall()[0][0]
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    a, b = both
    for r in rows:
        if r.n_a:
            assert r.n_a == len(a.encode(" " + texts[r.doc_id], add_special_tokens=False).ids)
            assert r.n_b == len(b.encode(texts[r.doc_id]))
            assert r.n_links == r.n_a + r.n_b - r.n_groups


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert A.align(df, PATH_A, PATH_B).count() == 0
