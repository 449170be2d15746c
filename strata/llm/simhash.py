"""SimHash near-duplicates by the generalised pigeonhole principle.

A document's fingerprint has bit b set where more than half of its shingles'
hashes have it set. Two documents link when their fingerprints differ in at
most ``distance`` bits. Distinct fingerprints are the nodes, so exact copies
never meet in a join.

Search. The 64 bits are grouped into m partitions, correlated bits together.
Partition i gets a threshold t_i >= -1 with sum(t_i + 1) = distance + 1; by
the generalised pigeonhole principle two fingerprints within ``distance`` then
agree up to t_i bits in some partition i. A dynamic program chooses the
thresholds (and m) that minimise the candidates estimated from counts over all
fingerprints plus the keys to probe. Each fingerprint probes the buckets
within t_i of its own value; candidates are verified on all 64 bits.

Buckets with over ``max_bucket`` fingerprints are not paired up. Everything
that touches one takes an exact way that emits no pairs: for distance 2 (or
1), fingerprints link exactly if they share a key within 1 bit of both (or are
one bit apart), so each emits itself and its 64 one-bit neighbours and is
linked to the smallest fingerprint on every key. A key then holds at most 65
different fingerprints, whatever the size of the group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import keep, pick, python_ready
from strata.llm.components import components

BITS = 64
SEED = 42


def _hashes(text: bytes, size: int) -> list[int]:
    """XXH64 of the shingles of one lower-cased text, repeats included."""
    words = text.lower().split()  # bytes: A-Z only, white space \x20 and \x09-\x0D
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    flat = b" ".join(words)
    ends = (np.cumsum([len(w) for w in words]) + np.arange(len(words))).tolist()
    starts = [0, *[e + 1 for e in ends[:-size]]]
    digest = xxhash.xxh64_intdigest
    return [digest(flat[a:b], SEED) for a, b in zip(starts, ends[size - 1:])]


def _vote(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Majority bits of consecutive groups of hashes; zero for an empty group."""
    out = np.zeros(len(sizes), np.uint64)
    some = np.flatnonzero(sizes)
    if not len(some):
        return out
    starts = np.concatenate(([0], np.cumsum(sizes[some])[:-1]))
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
    major = (2 * ones > sizes[some][:, None]).astype(np.uint8)
    out[some] = np.packbits(major, axis=1).view(">u8").ravel()
    return out


def _long_vote(hashes: list[int]) -> int:
    """As _vote for one document of any length, in blocks."""
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        block = np.array(hashes[i:i + (1 << 16)], np.uint64).astype(">u8")
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits((2 * ones > len(hashes)).astype(np.uint8)).view(">u8")[0])


def batch_fingerprints(texts: list[bytes | None], size: int) -> np.ndarray:
    """Fingerprints (uint64) of a batch of UTF-8 texts; a null has no words."""
    out = np.zeros(len(texts), np.uint64)
    held: list[int] = []
    sizes: list[int] = []
    places: list[int] = []

    def flush() -> None:
        if places:
            out[places] = _vote(np.array(held, np.uint64), np.array(sizes))
            held.clear(), sizes.clear(), places.clear()

    for i, text in enumerate(texts):
        found = _hashes(text, size) if text else []
        if len(found) > 1 << 16:
            out[i] = _long_vote(found)
            continue
        held += found
        sizes.append(len(found))
        places.append(i)
        if len(held) > 1 << 16:
            flush()
    flush()
    return out


def fingerprints(docs: DataFrame, size: int = 3, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(doc_id, h1, h2, fp)`` per row; fp is the fingerprint as a signed long,
    h1 and h2 are hashes of the text."""
    python_ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            fps = batch_fingerprints(texts, size).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(fps)],
                                             ["doc_id", "h1", "h2", "fp"])

    src = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h1"), F.hash("text").alias("h2"))
    return src.mapInArrow(run, "doc_id long, h1 long, h2 int, fp long")


# --- the plan: partitions and thresholds ---------------------------------------

def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Rows, and how often bits i and j are both set (64 x 64), over all rows."""
    def run(batches):
        joint, rows = np.zeros((BITS, BITS)), 0
        for batch in batches:
            v = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            x = ((v[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
            joint += x.T @ x
            rows += len(v)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(np.arange(BITS * BITS), -1)),
             pa.array(np.append(joint.ravel(), rows))], ["cell", "n"])

    cells = (fps.select("fp").mapInArrow(run, "cell long, n double")
             .groupBy("cell").agg(F.sum("n").alias("n")).collect())  # 4,097 rows at most
    joint, rows = np.zeros(BITS * BITS), 0
    for cell, n in cells:
        if cell < 0:
            rows = int(n)
        else:
            joint[cell] = n
    return rows, joint.reshape(BITS, BITS)


def group_bits(rows: int, joint: np.ndarray, m: int) -> list[list[int]]:
    """m partitions of the bits, each grown around the bit with the largest
    remaining correlation by the bits most correlated with it."""
    p = np.diag(joint) / max(rows, 1)
    cov = joint / max(rows, 1) - np.outer(p, p)
    dev = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    corr = np.abs(cov / np.outer(dev, dev))
    np.fill_diagonal(corr, 0)
    left, parts = list(range(BITS)), []
    for k in range(m):
        want = len(left) // (m - k)
        seed = max(left, key=lambda b: (corr[b, left].sum(), -b))
        part = [seed]
        left.remove(seed)
        while len(part) < want:
            best = max(left, key=lambda b: (corr[b, part].sum(), -b))
            part.append(best)
            left.remove(best)
        parts.append(sorted(part))
    return parts


def _within(p: np.ndarray, most: int) -> np.ndarray:
    """Chance that two fingerprints differ in exactly 0..most of these bits,
    were the bits independent."""
    chance = np.zeros(most + 1)
    chance[0] = 1
    for d in 2 * p * (1 - p):
        chance[1:] = chance[1:] * (1 - d) + chance[:-1] * d
        chance[0] *= 1 - d
    return chance


def allocate(costs: list[list[float]], units: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 with sum(t_i + 1) = units of least total cost;
    costs[i][k] is the cost of t_i = k - 1. Dynamic program over partitions."""
    best: list[tuple[float, list[int]] | None] = [(0.0, [])] + [None] * units
    for cost in costs:
        after: list[tuple[float, list[int]] | None] = [None] * (units + 1)
        for used, state in enumerate(best):
            for k in range(units - used + 1) if state else ():
                value = (state[0] + cost[k], [*state[1], k - 1])
                if after[used + k] is None or value[0] < after[used + k][0]:
                    after[used + k] = value
        best = after
    return best[units]


def part_value(fp: Column, bits: list[int]) -> Column:
    """The bits of one partition, in place; the others are zero."""
    mask = sum(1 << b for b in bits)
    return fp.bitwiseAND(F.lit(mask - (1 << BITS) if mask >> 63 else mask).cast("long"))


def choose_plan(fps: DataFrame, distance: int = 2,
                choices: tuple[int, ...] = (2, 3, 4)) -> list[tuple[list[int], int]]:
    """``[(bits, threshold), ...]`` of the cheapest plan.

    The candidates of t_i = 0 are counted over all fingerprints (pairs with
    equal partition values); those of larger t_i are scaled from it by the
    bits' own statistics."""
    rows, joint = bit_counts(fps)
    groups = {m: group_bits(rows, joint, m) for m in choices}
    keys = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(i).alias("i"),
                              part_value(F.col("fp"), bits).alias("v"))
                     for m, parts in groups.items() for i, bits in enumerate(parts)])
    pairs = {(r.m, r.i): float(r.pairs) for r in
             fps.select(F.explode(keys).alias("k")).groupBy("k").count()
             .groupBy("k.m", "k.i")
             .agg(F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2).alias("pairs"))
             .collect()}
    p = np.diag(joint) / max(rows, 1)
    plans = []
    for m, parts in groups.items():
        costs = []
        for i, bits in enumerate(parts):
            near = _within(p[bits], distance)
            equal = max(pairs.get((m, i), 0.0), rows * rows / 2 * near[0])
            cost, probes = [0.0], 0
            for t in range(distance + 1):
                probes += comb(len(bits), t)
                cost.append(probes * rows + equal * near[:t + 1].sum() / max(near[0], 1e-300))
            costs.append(cost)
        total, thresholds = allocate(costs, distance + 1)
        plans.append((total, m, [(b, t) for b, t in zip(parts, thresholds) if t >= 0]))
    return min(plans)[2]


# --- probe and verify -----------------------------------------------------------

def _flips(bits: list[int], most: int) -> Column:
    """Masks of all changes of at most ``most`` of these bits."""
    masks = [sum(1 << b for b in c) for t in range(most + 1) for c in combinations(bits, t)]
    return F.array(*[F.lit(x - (1 << BITS) if x >> 63 else x).cast("long") for x in masks])


def _bits_apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _stars(fps: DataFrame, distance: int) -> DataFrame:
    """Links among the distinct ``fps`` that connect exactly what lies within
    ``distance`` (1 or 2) bits, without pairs inside groups."""
    one = fps.select("fp", F.explode(_flips(list(range(BITS)), 1)).alias("x")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("x")).alias("key"))
    if distance == 1:  # at most 64 links each
        return (one.where("key < fp").join(fps.select(F.col("fp").alias("key")), "key")
                .select(F.col("key").alias("a"), F.col("fp").alias("b")))
    sets = one.groupBy("key").agg(F.collect_set("fp").alias("s")).where("size(s) > 1")
    return (sets.select(F.array_min("s").alias("a"), F.explode("s").alias("b"))
            .where("a != b").distinct())


def links(fps: DataFrame, distance: int = 2, max_bucket: int = 128,
          plan: list[tuple[list[int], int]] | None = None) -> DataFrame:
    """``(a, b)``: links that connect the distinct fingerprints ``fps`` (column
    fp) as all pairs within ``distance`` bits do. Every link returned is
    verified; pairs inside buckets over ``max_bucket`` are replaced by the star
    links of the module's docstring.

    Distances 0, 1 and 2 have that exact way. For a larger distance no bucket
    counts as large: all its candidates are verified."""
    plan = plan or choose_plan(fps, distance)
    own, probes = [], []
    for i, (bits, t) in enumerate(plan):
        value = part_value(F.col("fp"), bits)
        own.append(F.struct(F.lit(i).alias("i"), value.alias("v")))
        if t:
            probes.append(fps.select("fp", F.lit(i).alias("i"), value.alias("v"),
                                     F.explode(_flips(bits, t)).alias("x")).select(
                "fp", "i", F.col("v").bitwiseXOR(F.col("x")).alias("v")))
    data = keep(fps.select("fp", F.explode(F.array(*own)).alias("k")).select("fp", "k.i", "k.v"), "keys")
    exact = [i for i, (_, t) in enumerate(plan) if not t]
    found = []
    asks = data.where(F.col("i").isin(exact))
    for probe in probes:
        asks = asks.union(probe)
    if distance <= 2:
        size = data.groupBy("i", "v").agg(F.count("*").alias("n"))
        large = keep(size.where(F.col("n") > max_bucket).select("i", "v"), "large")
        touched = asks.join(large, ["i", "v"], "left_semi").select("fp").distinct()
        found.append(_stars(keep(touched, "touched"), distance))
        data = data.join(large, ["i", "v"], "left_anti")
        asks = asks.join(large, ["i", "v"], "left_anti")
    a, b = asks.withColumnRenamed("fp", "a"), data.withColumnRenamed("fp", "b")
    found.append(a.join(b, ["i", "v"])
                 .where((F.col("a") < F.col("b")) & (_bits_apart("a", "b") <= distance))
                 .select("a", "b").distinct())
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def near_duplicates(docs: DataFrame, size: int = 3, distance: int = 2, max_bucket: int = 128,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp, component_id)`` per row of ``docs``.

    component_id is the smallest doc_id that links reach, the document's own
    included. A null or empty text has fingerprint zero and links like any
    other. Rows with a null doc_id take part but give no component its id; a
    component of such rows alone has a null id. Repeated rows each get a row
    in the result. An empty table gives an empty result."""
    if not 0 <= distance <= BITS:
        raise ValueError("distance must be between 0 and 64 bits")
    fps = keep(fingerprints(docs, size, id_col, text_col), "fingerprints")
    return fps.join(_components(fps, distance, max_bucket), "fp").select("doc_id", "fp", "component_id")


def _components(fps: DataFrame, distance: int, max_bucket: int = 128) -> DataFrame:
    """``(fp, root, component_id)`` of each distinct fingerprint: its component
    by a fingerprint of it, and by the smallest doc_id."""
    classes = keep(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    if not distance:
        return classes.select("fp", F.col("fp").alias("root"), F.col("first_id").alias("component_id"))
    roots = keep(components(links(classes.select("fp"), distance, max_bucket), "a", "b"), "roots")
    named = (classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
             .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    ids = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return keep(named.join(ids, "root").select("fp", "root", "component_id"), "named")


def keep_first(docs: DataFrame, size: int = 3, distance: int = 2) -> DataFrame:
    """One document of each near-duplicate group, columns as in ``docs``: of the
    rows with a doc_id the one with the least (doc_id, hashes of its text), so
    unrelated texts under one doc_id are judged each for itself. No doc_id can
    name the rows without one: of those in a group one stays beside it, the one
    with the least hashes. Of rows that repeat doc_id and text one stays, with
    the least hash over its columns. The result depends on the rows alone, not
    on how they are split."""
    place, body = (f"c{docs.columns.index(n)}" for n in ("doc_id", "text"))
    flat = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    fps = keep(fingerprints(docs, size), "fingerprints")
    near = fps.join(_components(fps, distance).select("fp", "root"), "fp")
    least = near.groupBy("root", F.col("doc_id").isNull().alias("unknown")).agg(
        F.min(F.struct("doc_id", "h1", "h2")).alias("k"))
    kept = keep(least.select("k.*").groupBy("doc_id", "h1", "h2").agg(F.count("*").alias("groups")), "kept")
    many = near.groupBy("doc_id", "h1", "h2").agg(F.count("*").alias("n"))
    key = ["doc_id", "h1", "h2"]
    same = [F.col(f"k.{c}").eqNullSafe(F.col(f"m.{c}")) for c in key]
    kept = keep(kept.alias("k").join(many.alias("m").hint("merge"), same).select("k.*", "m.n"), "kept-rows")
    match = (F.col(place).cast("long").eqNullSafe(F.col("doc_id")) & (F.xxhash64(body) == F.col("h1"))
             & (F.hash(body) == F.col("h2")))
    # the kept keys grow with the corpus: merged, whatever their size, never broadcast
    rows = flat.join(kept.where("n = 1").hint("merge"), match, "left_semi")
    if not kept.where("n > 1").isEmpty():
        more = flat.join(kept.where("n > 1").hint("merge"), match, "left_semi")
        one = (more.groupBy(F.col(place).alias("doc_id"), F.xxhash64(body).alias("h1"), F.hash(body).alias("h2"))
               .agg(F.min_by(F.struct(*more.columns), F.xxhash64(*more.columns)).alias("r")))
        rows = rows.union(one.select("r.*"))
    return rows.toDF(*docs.columns)
