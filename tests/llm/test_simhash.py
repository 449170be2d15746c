import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import simhash

SF = "/root/testdata/sf0.01"


def brute_fp(text, size=3):
    words = (text or "").encode().lower().split()
    sh = [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    ones = [0] * 64
    for s in sh:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(sh)) if sh else 0


def brute_components(fps, distance=2):
    """Smallest id reachable; fps: [(id, fingerprint)]."""
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    v = np.array([f for _, f in fps], np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(v[i + 1:] ^ v[i]) <= distance):
            parent[find(i)] = find(i + 1 + int(j))
    least = {}
    for i, (d, _) in enumerate(fps):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(fps))]


def test_query_matches_brute_force(spark):
    from strata.llm.queries import QUERIES
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op10_simhash"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    fps = [(d.doc_id, brute_fp(d.text)) for d in docs]
    want = {d: (f"{f:016x}", c) for (d, f), c in zip(fps, brute_components(fps))}
    assert got == want


def test_hash_is_sparks_xxhash64(spark):
    text = "Eins zwei\tdrei"
    h = spark.range(1).select(F.xxhash64(F.lit("eins zwei drei")).alias("h")).first().h
    assert simhash._hashes(text.encode(), 3) == [h % 2**64]


@pytest.mark.parametrize("distance", [0, 1, 2])
@pytest.mark.parametrize("max_bucket", [1, 4, 1000])
def test_links_connect_as_all_pairs_do(spark, distance, max_bucket):
    """Dense groups, so that small bucket bounds force the exact way."""
    rng = np.random.default_rng(5)
    base = [int(x) for x in rng.integers(0, 2**63, 12)]
    vals = {b ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 5), False))
            for b in base for _ in range(30)}
    signed = sorted(v - 2**64 if v >> 63 else v for v in vals)
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    if distance:
        from strata.llm.components import components
        e = simhash.links(df, distance, max_bucket)
        bad = e.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > distance).count()
        assert bad == 0
        root = {r.node: r.root for r in components(e, "a", "b").collect()}
    else:
        root = {}
    got = [root.get(s, s) for s in signed]
    want = brute_components([(s, s % 2**64) for s in signed], distance)
    assert got == want


def test_thresholds_cover_every_split():
    """allocate() returns thresholds that obey the generalised pigeonhole rule."""
    for units in (1, 2, 3, 4):
        cost, t = simhash.allocate([[0, 5, 1, 9, 9], [0, 2, 7, 9, 9], [0, 9, 9, 9, 9]], units)
        assert sum(x + 1 for x in t) == units
    assert simhash.allocate([[0, 5, 1, 9], [0, 2, 7, 9]], 3) == (3.0, [1, 0])


def test_edge_cases(spark):
    rows = [(5, None, 1), (4, "", 2), (3, "  \n", 3), (7, "a b", 4), (6, "A b", 5), (7, "a b", 6),
            (None, "a  B", 7), (9, "x " * 70000 + "y", 8), (8, "X " * 70000 + "Y", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.component_id)
                 for r in simhash.near_duplicates(df).collect())
    assert got == [(False, 3, 3), (False, 4, 3), (False, 5, 3), (False, 6, 6), (False, 7, 6),
                   (False, 7, 6), (False, 8, 8), (False, 9, 8), (True, 0, 6)]
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r.fp for r in kept.collect()) == [3, 5, 7, 9]
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    assert simhash.keep_first(df.limit(0)).count() == 0
    twice = simhash.keep_first(spark.createDataFrame([(1, "q r s"), (1, "q r s")], "doc_id long, text string"))
    assert twice.count() == 1


def test_keep_first_tells_rows_apart_by_text(spark):
    """Unrelated texts under one doc_id all stay, copies without an id do not,
    and any split of the rows gives the same ones."""
    rows = [(1, "alpha beta gamma delta", "a"), (1, "one two three four five", "b"),
            (2, "alpha beta gamma delta", "c"), (None, "six seven eight nine", "d"),
            (None, "six seven eight nine", "e"), (None, "ten eleven twelve", "f"),
            (3, "same id same text", "g"), (3, "same id same text", "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = None
    for parts in (1, 3, 8):
        got = sorted(map(str, simhash.keep_first(df.repartition(parts)).collect()))
        assert want is None or got == want
        want = got
    kept = [(r.doc_id, r.text) for r in simhash.keep_first(df).collect()]
    assert sorted(kept, key=str) == sorted([
        (1, "alpha beta gamma delta"), (1, "one two three four five"), (None, "six seven eight nine"),
        (None, "ten eleven twelve"), (3, "same id same text")], key=str)


def test_long_text_votes_in_blocks():
    text = " ".join(str(i * 7919 % 100003) for i in range(70000))
    h = simhash._hashes(text.encode(), 3)
    assert simhash._long_vote(h) == brute_fp(text)
    assert int(simhash.batch_fingerprints([text.encode(), None, b"a"], 3)[0]) == brute_fp(text)
