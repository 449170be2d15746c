"""Near-duplicate embeddings by int8 tile products with rigorous bounds.

Every different vector is scaled to length 1 and quantised to int8 codes q with
a step s, so that x = s q + e and |e| is known. For two vectors

    x . y <= (s q) . (t r) + |e| |t r| + |s q| |f| + |e| |f|
          <= (s q) . (t r) + |e| + |f| + 3 |e| |f|

as |s q| <= 1 + |e|. The integer products q . r of a tile are exact, so what
is left to allow for is the rounding of a few operations in double precision and
of the confirming cosine itself, which grows with the dimension (``slack``). Only
pairs whose bound reaches the threshold are computed in double precision from
the original vectors; no pair at or above it can be missed.

The vectors are dealt into blocks, and a tile is a pair of blocks. A tile task
holds two blocks and small products of their parts; it returns per vector the
number of its links and one link of a spanning forest, never the pairs. Equal
vectors are one class with a count, so a group of copies is one row. The vectors
travel to their tiles once each, in the precision of their column, and are
quantised there: candidate pairs of a dense group would outweigh them by far.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import keep, pick, python_ready
from strata.llm.components import components

THRESHOLD = 0.95
BLOCK_ROWS = 8192
PART_ROWS = 2048
# rounding in double precision that a bound allows for, for each 1,000 dimensions
SLACK = 1e-12
# sums of so many products of two codes stay integers below 2^24, exact in float32
EXACT_DIMS = (1 << 24) // (127 * 127)


def slack(dimensions: int) -> float:
    """Covers the rounding of unit length, bound and confirming cosine, each
    below (dimensions + 8) units of 2^-53."""
    return SLACK * max(1.0, dimensions / 1000)


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, steps and error lengths of unit vectors (float64 rows)."""
    step = np.abs(unit).max(axis=1, initial=0) / 127
    step[step == 0] = 1
    codes = np.rint(unit / step[:, None]).astype(np.int8)
    error = np.sqrt(((unit - codes * step[:, None]) ** 2).sum(axis=1))
    return codes, step, error * (1 + 1e-9) + 1e-12


def bound_rows(codes: np.ndarray, step: np.ndarray, error: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose products (left with right) are the pairs' upper bounds. Given
    codes of no dimension, the products are the error terms alone."""
    x = codes * step[:, None]
    e = error[:, None]
    one = np.ones_like(e)
    return np.hstack([x, e, one, 3 * e]), np.hstack([x, one, e, e])


def code_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact integer products of all pairs of int8 codes. They are taken by
    float32 products of at most ``EXACT_DIMS`` dimensions, in which every partial
    sum is an exact integer whatever the order of summation."""
    d = left.shape[1]
    if d <= EXACT_DIMS:
        return left.astype(np.float32) @ right.astype(np.float32).T
    total = np.zeros((len(left), len(right)), np.float64)
    for k in range(0, d, EXACT_DIMS):
        total += code_products(left[:, k:k + EXACT_DIMS], right[:, k:k + EXACT_DIMS])
    return total


def candidates(left, right, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose upper bound reaches ``threshold``; left and right are
    (codes, steps, errors) of unit vectors. A cut per row, with the other side's
    greatest step and error, spares most pairs their own bound."""
    (q, s, e), (r, t, f) = left, right
    reach = threshold - slack(q.shape[1])
    product = code_products(q, r)
    least = reach - (e + f.max() + 3 * e * f.max())
    cut = np.where(least > 0, np.floor(least / (s * t.max()) * (1 - 1e-12)), -np.inf)
    a, b = np.nonzero(product >= cut.astype(product.dtype)[:, None])
    terms_a, terms_b = bound_rows(q[:, :0], s, e)[0], bound_rows(r[:, :0], t, f)[1]
    bound = product[a, b] * (s[a] * t[b]) + np.einsum("ij,ij->i", terms_a[a], terms_b[b])
    at = bound >= reach
    return a[at], b[at]


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node reachable over the links (a, b) among n nodes."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, a, least)
        np.minimum.at(after, b, least)
        after = after[after]
        if (after == label).all():
            return label
        label = after


def tile_links(left: np.ndarray, right: np.ndarray | None, weight_left: np.ndarray,
               weight_right: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of one tile: per vector (left ones, then right ones) how many
    vectors it links to here, and the root of its component. ``right`` is None
    for a block with itself. Rows of left and right are original vectors."""
    own = right is None
    if own:
        right, weight_right = left, weight_left
    na, nb = len(left), len(right)
    base = 0 if own else na
    length_a = np.sqrt((left ** 2).sum(axis=1))
    length_b = np.sqrt((right ** 2).sum(axis=1))
    codes_a = quantise(left / length_a[:, None])
    codes_b = codes_a if own else quantise(right / length_b[:, None])
    n_links = np.zeros(na if own else na + nb, np.int64)
    forest_a, forest_b = [], []
    for i in range(0, na, PART_ROWS):
        for j in range(i if own else 0, nb, PART_ROWS):
            a, b = candidates([v[i:i + PART_ROWS] for v in codes_a],
                              [v[j:j + PART_ROWS] for v in codes_b], threshold)
            a, b = a + i, b + j
            if own:
                a, b = a[a < b], b[a < b]
            ok = np.zeros(len(a), bool)
            for k in range(0, len(a), 1 << 16):
                x, y = a[k:k + (1 << 16)], b[k:k + (1 << 16)]
                dot = np.einsum("ij,ij->i", left[x], right[y])
                ok[k:k + (1 << 16)] = dot / (length_a[x] * length_b[y]) >= threshold
            a, b = a[ok], b[ok]
            if not len(a):
                continue
            n_links += np.bincount(a, weight_right[b], len(n_links)).astype(np.int64)
            n_links += np.bincount(b + base, weight_left[a], len(n_links)).astype(np.int64)
            # of each part's links keep a forest
            ends, at = np.unique(np.concatenate([a, b + base]), return_inverse=True)
            root = ends[_roots(at[:len(a)], at[len(a):], len(ends))]
            forest_a.append(ends[root != ends])
            forest_b.append(root[root != ends])
    if not forest_a:
        return n_links, np.arange(len(n_links))
    return n_links, _roots(np.concatenate(forest_a), np.concatenate(forest_b), len(n_links))


def _classes(vectors: DataFrame) -> DataFrame:
    """Different usable vectors: (x, first_id, n)."""
    ok = (F.col("x").isNotNull() & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v)
                                            & (F.abs(v) != float("inf")))
          & F.exists("x", lambda v: v != 0))
    return (vectors.where(ok).groupBy("x")
            .agg(F.min("id").alias("first_id"), F.count("*").alias("n")))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, block_rows: int = BLOCK_ROWS,
                    id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per row: vec_id, n_links (other rows whose cosine with it, in double
    precision, is at least ``threshold``) and component_id (smallest vec_id
    that links reach, its own included).

    Vectors that are null, empty or zero, or hold a null or non-finite
    component, link with nothing; so do vectors of different dimensions.
    Repeated rows are rows of their own and link with each other. A null
    vec_id takes part but names no component. An empty table gives an empty
    result."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    python_ready(vectors.sparkSession)
    picked = pick(vectors, id=id_col, x=vector_col)
    single = picked.schema["x"].dataType.simpleString() == "array<float>"
    real = np.float32 if single else np.float64
    src = picked.select(
        F.col("id").cast("long").alias("id"),
        F.col("x").cast("array<float>" if single else "array<double>").alias("x"))
    classes = keep(_classes(src).select(
        F.monotonically_increasing_id().alias("c"), "x", "first_id", "n"), "classes")
    total = classes.count()
    blocks = max(1, -(-total // block_rows))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _by_dimension(batch):
                x = np.stack([np.array(v, real) for v in rows.column(1).to_pylist()])
                if not single:  # extreme ones are scaled, so that squares stay finite
                    top = np.abs(x).max(axis=1)[:, None]
                    x = np.where((top > 1e100) | (top < 1e-100), x / top, x)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(2), pa.array([x.shape[1]] * len(x), pa.int32()),
                     pa.array([v.tobytes() for v in x], pa.binary())], ["c", "n", "d", "x"])

    coded = classes.select("c", "x", "n").mapInArrow(code, "c long, n long, d int, x binary")
    block = F.pmod(F.xxhash64("c"), F.lit(blocks)).cast("int")
    tiles = (coded.withColumn("b", block)
             .withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
             .select("d", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), "b",
                     "c", "n", "x"))

    def run(table: pa.Table) -> pa.Table:
        d, i, j = (table.column(k)[0].as_py() for k in ("d", "i", "j"))
        b = table.column("b").to_numpy()
        sides = [np.flatnonzero(b == k) for k in ([i] if i == j else [i, j])]

        def side(at: np.ndarray):
            t = table.take(pa.array(at))
            x = np.frombuffer(b"".join(t.column("x").to_pylist()), real).reshape(t.num_rows, d)
            return x.astype(np.float64), t.column("n").to_numpy().astype(np.float64)

        c = table.column("c").to_numpy()[np.concatenate(sides)]
        if i != j and (not len(sides[0]) or not len(sides[1])):
            some = np.zeros(0, np.int64)
            n_links = roots = some
        else:
            x, w = side(sides[0])
            y, v = (None, None) if i == j else side(sides[1])
            n_links, roots = tile_links(x, y, w, v, threshold)
            some = np.flatnonzero(n_links)
        return pa.table({"c": c[some], "n_links": n_links[some], "root": c[roots[some]]})

    found = keep(tiles.groupBy("d", "i", "j").applyInArrow(run, "c long, n_links long, root long"), "tiles")
    linked = found.groupBy("c").agg(F.sum("n_links").alias("more"))
    roots = components(found.where("c != root"), "c", "root")
    named = (classes.join(linked, "c", "left").join(roots.withColumnRenamed("node", "c"), "c", "left")
             .select("x", "first_id", F.col("n") - 1 + F.coalesce("more", F.lit(0)),
                     F.coalesce("root", "c")).toDF("x", "first_id", "n_links", "root"))
    named = keep(named, "named")
    ids = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = named.join(ids, "root").select(F.col("x").alias("y"), "n_links", "component_id")
    return src.join(named, src["x"] == named["y"], "left").select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("y").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def _by_dimension(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    lengths = np.array([len(v) for v in batch.column(1).to_pylist()])
    for d in np.unique(lengths):
        yield batch.take(pa.array(np.flatnonzero(lengths == d)))
