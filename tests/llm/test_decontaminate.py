import hashlib
import random
import re

import pytest

from oracle_compare import duck, duck_digest, spark_digest
from strata.llm import decontaminate as D
from strata.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, bench, size=13, per_hit=20):
    words = lambda t: WORD.findall((t or "").translate(LOWER))
    wins = {}
    for item, text in bench:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            wins.setdefault(tuple(w[i:i + size]), set()).add(item)
    out = []
    for d, text in docs:
        w, hit, items = words(text), set(), set()
        for m in {len(k) for k in wins}:
            for i in range(len(w) - m + 1):
                found = wins.get(tuple(w[i:i + m]))
                if found:
                    hit |= set(range(i, i + m))
                    items |= found
        out.append((d, len(w), len(hit), sorted(x for x in items if x is not None),
                    bool(hit) and per_hit * len(hit) >= len(w)))
    return out


def rows(df):
    return [(r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in df.collect()]


def key(r):
    return (r[0] is None, r[0] or 0, *map(str, r[1:]))


def test_query_matches_oracle(spark):
    got = spark_digest(QUERIES["op1_decontamination"](spark, SF))
    assert got == duck_digest(duck(SF), ORACLE_SQL["op1_decontamination"])


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("shard_windows", [7, 10_000])
def test_small_alphabet_matches_brute_force(spark, seed, shard_windows):
    """Few words, so that windows overlap, repeat and share suffixes; items
    shorter than a window included; several shards give the same rows."""
    rnd = random.Random(seed)
    say = lambda n: " ".join(rnd.choice("a b c".split()) for _ in range(n))
    bench = [(i, say(rnd.choice([1, 2, 3, 5, 6, 9]))) for i in range(2, 12)][seed:]
    docs = [(i, say(rnd.randint(0, 60))) for i in range(60)]
    got = rows(D.contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                               spark.createDataFrame(bench, "item_id long, text string"),
                               size=5, shard_windows=shard_windows))
    assert sorted(got, key=key) == sorted(brute(docs, bench, 5), key=key)


@pytest.mark.parametrize("filter_windows", [3, 12, 10_000])
def test_several_shards_search_only_suspects(spark, monkeypatch, filter_windows):
    """One filter pass over all documents (or several), then each shard reads
    just the documents that hold one of its windows' hashes."""
    rnd = random.Random(5)
    say = lambda n: " ".join(rnd.choice("abcdefghijklmnop") + rnd.choice("é12") for _ in range(n))
    bench = [(i, say(rnd.choice([4, 9, 14]))) for i in range(12)]
    docs = [(i, say(80) + (" " + bench[i % 12][1] if i % 10 == 0 else "")) for i in range(200)] + [(200, None), (201, "")]
    searched = []
    hits = D._hits
    monkeypatch.setattr(D, "_hits", lambda df, *a: searched.append(df.count()) or hits(df, *a))
    got = rows(D.contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                               spark.createDataFrame(bench, "item_id long, text string"),
                               size=6, shard_windows=10, filter_windows=filter_windows))
    assert sorted(got, key=key) == sorted(brute(docs, bench, 6), key=key)
    assert len(searched) > 3 and 0 < max(searched) <= 20  # those with a passage


def test_hashes_of_runs_are_those_of_the_runs_alone():
    words = [b"w%d" % (i * i % 17) for i in range(500)]
    for size, got in zip([1, 5, 13, 501], D.run_hashes(words, [1, 5, 13, 501])):
        want = [next(D.run_hashes(words[i:i + size], [size]))[0] for i in range(500 - size + 1)]
        assert got.tolist() == want
    assert [len(x) for x in D.run_hashes([], [1, 2])] == [0, 0]


def test_edge_cases(spark):
    long = "w1 w2 " * 40000 + "eins zwei drei vier"
    docs = [(1, None, 0), (2, "", 0), (3, "Eins, ZWEI! drei; vier?", 0), (3, "nothing here", 1),
            (None, "eins zwei drei vier", 0), (5, long, 0), (6, "eins zwei drei vier", 0),
            (6, "eins zwei drei vier", 0), (7, "Éins zwei drei vier", 0)]
    bench = [(10, "eins zwei drei vier"), (2, "drei vier"), (11, None), (12, "..."), (None, "éins")]
    df = spark.createDataFrame(docs, "doc_id long, text string, found int")
    bf = spark.createDataFrame(bench, "item_id long, text string")
    want = brute([d[:2] for d in docs], bench)
    assert sorted(rows(D.contamination(df, bf)), key=key) == sorted(want, key=key)
    kept = D.drop_contaminated(df, bf)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.found) for r in kept.collect()) == [(1, 0), (2, 0), (3, 1), (5, 0)]
    assert D.contamination(df.limit(0), bf).count() == 0
    none = D.contamination(df, bf.limit(0)).collect()
    assert len(none) == len(docs) and not any(r.contaminated or r.n_hit for r in none)


def test_search_skips_positions():
    """The shift tables let a clean text be read at about one word in m."""
    class Counted(list):
        reads = 0

        def __getitem__(self, i):
            if isinstance(i, int):
                Counted.reads += 1
            return super().__getitem__(i)

    search = D.WuManber([b" ".join(b"p%d" % i for i in range(13))])
    assert not list(search.find(Counted([b"x"] * 13_000)))
    assert Counted.reads <= 1_001


def test_items_digest(spark):
    r = {x.doc_id: x for x in QUERIES["op1_decontamination"](spark, "/root/testdata/sf0.001").collect()}
    assert any(x.n_items for x in r.values())
    clean = next(x for x in r.values() if not x.n_items)
    assert clean.items_sha256 == hashlib.sha256(b"").hexdigest()
