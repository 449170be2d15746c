import numpy as np
import pytest

from oracle_compare import duck, duck_digest, spark_digest
from strata.llm import embedding_dedup as E
from strata.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"


def brute(rows, threshold=0.95):
    """rows: (id, vector or None). (id, n_links, component) per row."""
    n = len(rows)
    ok = [v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v)
          for _, v in rows]
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * n
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1]), np.array(rows[j][1])
                if a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    parent[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return [(k, links[i], least.get(find(i))) for i, (k, _) in enumerate(rows)]


def key(r):
    return (r[0] is None, r[0] or 0, r[1], r[2] or 0)


def test_query_matches_oracle(spark):
    got = spark_digest(QUERIES["op2_embedding_dedup"](spark, SF))
    assert got == duck_digest(duck(SF), ORACLE_SQL["op2_embedding_dedup"])


@pytest.mark.parametrize("block_rows", [7, 40, 1000])
def test_blocks_do_not_matter(spark, block_rows, monkeypatch):
    """Chains of near vectors, copies and several dimensions, in any tiling."""
    monkeypatch.setattr(E, "PART_ROWS", 16)
    rng = np.random.default_rng(2)
    rows = []
    for c in range(8):
        d = 6 if c % 2 else 5
        v = rng.normal(size=d)
        for _ in range(12):
            rows.append((len(rows), [float(x) for x in v]))
            v = v + rng.normal(size=d) * rng.choice([0.0, 0.1, 0.3, 0.6])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in E.near_duplicates(df, block_rows=block_rows).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [5e200, 0.0]), (3, [3e-200, 1e-210]), (4, None), (5, []), (6, [0.0, -0.0]),
            (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]), (10, [1.0]), (11, [1.0, 0.0, 0.0]),
            (12, [0.0, 1.0]), (12, [0.0, 1.0]), (None, [0.0, 2.0]), (14, [-1.0, 0.0]), (15, [0.95, 0.3122])]
    df = spark.createDataFrame([(k, v, 1) for k, v in rows], "vec_id long, embedding array<double>, c int")
    got = [tuple(r) for r in E.near_duplicates(df).collect()]
    scaled = [(k, v if v is None or None in v or not any(v) else [x / max(map(abs, v)) for x in v])
              for k, v in rows]
    assert sorted(got, key=key) == sorted(brute(scaled), key=key)
    assert E.near_duplicates(df.limit(0)).count() == 0


def test_bounds_hold():
    """No pair's exact cosine exceeds its bound, whatever the vectors."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 24)) ** 5
    x[:50] = x[0] + rng.normal(size=(50, 24)) * 1e-3
    unit = x / np.sqrt((x ** 2).sum(1))[:, None]
    q = E.quantise(unit)
    left, right = E.bound_rows(*q)[0], E.bound_rows(*q)[1]
    assert (left @ right.T + E.SLACK / 2 >= unit @ unit.T).all()
    assert np.abs(q[0]).max() <= 127 and q[0].dtype == np.int8


@pytest.mark.parametrize("d", [3, 1040, 1041, 4096])
def test_no_link_is_missed_in_any_dimension(d):
    """Integer products are exact, and pairs whose cosine lies around the
    threshold are found just as plain double precision finds them."""
    rng = np.random.default_rng(d)
    base = rng.normal(size=(40, d))
    base[0] = 1.0  # the largest sums of codes
    away = rng.normal(size=(40, d))
    away -= (away * base).sum(1)[:, None] / (base ** 2).sum(1)[:, None] * base
    unit, side = (v / np.sqrt((v ** 2).sum(1))[:, None] for v in (base, away))
    cos = 0.95 + np.concatenate([np.zeros(10), rng.normal(size=15) * 1e-13, rng.normal(size=15) * 1e-4])
    x = np.vstack([unit, cos[:, None] * unit + np.sqrt(1 - cos ** 2)[:, None] * side])
    q = E.quantise(x / np.sqrt((x ** 2).sum(1))[:, None])
    assert (E.code_products(q[0], q[0]) == q[0].astype(np.int64) @ q[0].T.astype(np.int64)).all()
    length = np.sqrt((x ** 2).sum(1))
    want = {(a, b) for a in range(80) for b in range(a + 1, 80)
            if np.einsum("i,i", x[a], x[b]) / (length[a] * length[b]) >= 0.95}
    found = {(a, b) for a, b in zip(*(v.tolist() for v in E.candidates(q, q, 0.95))) if a < b}
    assert want <= found
    if d > 3:
        assert len(found) <= 40  # and few others


@pytest.mark.parametrize("kind", ["float", "double"])
def test_both_precisions(spark, kind):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(6, 8)).repeat(10, axis=0) + rng.normal(size=(60, 8)) * 0.15
    rows = [(k, [float(np.float32(c)) for c in x]) for k, x in enumerate(v)] + [(60, None)]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    got = [tuple(r) for r in E.near_duplicates(df, block_rows=16).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
