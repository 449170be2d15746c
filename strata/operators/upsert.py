"""Keyed upsert with MERGE semantics, as DataFrame operations.

``upsert(target, source, keys)`` returns what
``MERGE INTO target t USING source s ON t.k = s.k
WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *`` leaves in
the table:

* matched target rows take every column from their source row (a NULL in the
  source overwrites); a key repeated in the target updates all its rows;
* source rows whose key matches no target row are inserted, duplicates
  included; NULL keys never match, so they are always inserted;
* a target row matched by more than one source row is an error, as in MERGE.

Plan. ``target LEFT JOIN source`` produces updated and untouched rows in one
pass; the inserts are ``source`` anti-joined with the *matched keys*, which
are found by semi-joining the target's keys with the source's keys and
collapsing them map-side. The key-check job also measures the source (rows
and bytes); when both fit the broadcast limits the joins broadcast the
source, so the target is scanned but never shuffled. Beyond the limits they
are sort-merge joins and AQE splits skewed target partitions (left outer and
left semi joins both allow it).

``one_scan=True`` takes another plan beyond those limits: one ``FULL OUTER``
join, which reads and shuffles the target once. Adaptive execution cannot split
such a join, so hot target keys are salted beforehand: keys that hold more than
half of a partition's share (found from the key columns alone) have their rows
dealt over as many salts as that share asks for, and their source rows are
repeated for each salt. A source row of such a key is never an insert (the key
is in the target), and rows with a NULL key match nothing, so they are dealt
out freely.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.sizing import DEFAULT_BROADCAST_BYTES, row_bytes
from strata.operators.skew import LEAST_SUPPORT
from strata.session import stage

DEFAULT_BROADCAST_ROWS = 1_000_000


class MergeKeyError(ValueError):
    """Source keys break MERGE rules (NULL keys or multiple matches)."""


class SchemaMismatch(ValueError):
    """Source lacks a target column (UPDATE SET * / INSERT * by name)."""


def _any_null(keys: Sequence[str]):
    cond = F.col(keys[0]).isNull()
    for k in keys[1:]:
        cond = cond | F.col(k).isNull()
    return cond


def align_source(target: DataFrame, source: DataFrame,
                 evolve: bool = False) -> tuple[DataFrame, list[str]]:
    """Resolve source columns by name against the target.

    Missing target columns are an error. Extra source columns are ignored,
    or appended to the schema with ``evolve=True``.
    """
    missing = [c for c in target.columns if c not in source.columns]
    if missing:
        raise SchemaMismatch(f"source lacks target columns {missing}")
    extra = [c for c in source.columns if c not in target.columns]
    columns = list(target.columns) + (extra if evolve else [])
    return source.select(*columns), extra if evolve else []


def check_source_keys(target: DataFrame, source: DataFrame, keys: Sequence[str],
                      null_keys: str = "raise") -> int:
    """Validate source keys; returns the number of source rows."""
    return check_source(target, source, keys, null_keys)[0]


def check_source(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 null_keys: str = "raise") -> tuple[int, int]:
    """Validate source keys; returns (source rows, estimated source bytes).

    One job aggregates the source per key (partial aggregation first, so a
    hot key costs one row per map task) and then globally: row count, rows
    with a NULL key, and the largest group. The target is touched (semi join
    against the few duplicate keys) only when duplicates exist.
    """
    nulls = _any_null(keys)
    per_key = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"),
                                        F.sum(row_bytes(source)).alias("__bytes"))
    stats = per_key.agg(
        F.sum("__rows").alias("n"),
        F.sum("__bytes").alias("bytes"),
        F.sum(F.when(nulls, F.col("__rows")).otherwise(F.lit(0))).alias("null_keys"),
        F.max(F.when(~nulls, F.col("__rows"))).alias("max_per_key")).first()
    if stats["null_keys"] and null_keys == "raise":
        raise MergeKeyError(f"{stats['null_keys']} source rows have a NULL key {list(keys)}")
    if (stats["max_per_key"] or 0) > 1:
        dups = per_key.where(~nulls & (F.col("__rows") > 1)).select(*keys)
        hit = target.select(*keys).join(dups, list(keys), "left_semi").limit(1).collect()
        if hit:
            raise MergeKeyError(
                f"target key {hit[0].asDict()} is matched by several source rows")
    return int(stats["n"] or 0), int(stats["bytes"] or 0)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           null_keys: str = "raise", evolve: bool = False, check: bool = True,
           broadcast_limit: int = DEFAULT_BROADCAST_ROWS,
           delete_missing: bool = False,
           broadcast_bytes: int = DEFAULT_BROADCAST_BYTES, one_scan: bool = False) -> DataFrame:
    """SNK-2/3/4: MERGE ... UPDATE SET * / INSERT * on ``keys``.

    ``delete_missing=True`` adds ``WHEN NOT MATCHED BY SOURCE THEN DELETE``
    for sources that are complete snapshots (Q18): target rows whose key the
    source no longer has are dropped. Off by default, as in the reference.
    """
    return upsert_counted(target, source, keys, null_keys, evolve, check, broadcast_limit,
                          delete_missing, broadcast_bytes, one_scan)[0]


def hot_target_keys(target: DataFrame, keys: Sequence[str], partitions: int) -> DataFrame | None:
    """``keys`` and ``__salts`` of the target keys that hold more than half of a
    partition's even share of the rows, staged; ``None`` without any.

    Candidates come from one pass with bounded counters over a hash of the key
    (no false negatives, no shuffle); their rows are then counted by key, map
    side first. There are at most two keys for each partition."""
    known = target.where(~_any_null(keys)).select(*keys)
    hashed = known.select(F.xxhash64(*keys).alias("__h"))
    rows = hashed.count()
    share = max(LEAST_SUPPORT, 1 / (2 * partitions))
    if rows * share <= 1:
        return None
    found = hashed.stat.freqItems(["__h"], share).first()[0] or []
    if not found:
        return None
    candidates = target.sparkSession.createDataFrame([(h,) for h in found], "__h long")
    counted = (known.join(F.broadcast(candidates), F.xxhash64(*keys) == F.col("__h"), "left_semi")
               .groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > rows * share))
    salts = F.least(F.lit(partitions), F.ceil(F.col("__rows") * 2 * partitions / rows)).cast("int")
    hot = stage(counted.select(*keys, salts.alias("__salts")), f"hot-target-keys/{uuid.uuid4().hex}")
    return None if hot.isEmpty() else hot


def _one_scan(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str],
              delete_missing: bool) -> DataFrame:
    """The merged table by one full outer join of salted rows."""
    partitions = int(target.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_target_keys(target, keys, partitions)
    free = F.when(_any_null(keys), F.lit(partitions))  # matches nothing: dealt freely

    def salted(df: DataFrame) -> DataFrame:
        if hot is None:
            return df.withColumn("__salts", free)
        named = hot.toDF(*[f"__{k}" for k in keys], "__hot")
        cond = F.lit(True)
        for k in keys:
            cond = cond & (df[k] == named[f"__{k}"])
        return (df.join(F.broadcast(named), cond, "left").drop(*[f"__{k}" for k in keys])
                .withColumn("__salts", F.coalesce(F.col("__hot"), free)).drop("__hot"))

    # numbers of rows within their task: salts as even as can be, repeated rows too
    t = salted(target).withColumn("__salt", F.when(
        F.col("__salts").isNotNull(), F.pmod(F.monotonically_increasing_id(), F.col("__salts"))).otherwise(F.lit(0)))
    s = salted(source)
    is_hot = F.col("__salts").isNotNull() & ~_any_null(keys)
    s = (s.withColumn("__is_hot", is_hot)
         .withColumn("__salt", F.when(F.col("__is_hot"), F.sequence(F.lit(0), F.col("__salts") - 1))
                     .when(F.col("__salts").isNotNull(),
                           F.array(F.pmod(F.monotonically_increasing_id(), F.col("__salts")).cast("int")))
                     .otherwise(F.array(F.lit(0))))
         .withColumn("__salt", F.explode("__salt")).withColumn("__src", F.lit(True)))
    t = t.withColumn("__tgt", F.lit(True)).drop("__salts").alias("t")
    s = s.drop("__salts").alias("s")
    cond = F.col("t.__salt") == F.col("s.__salt")
    for k in keys:
        cond = cond & (F.col(f"t.{k}") == F.col(f"s.{k}"))
    both = t.join(s, cond, "right" if delete_missing else "full")
    both = both.where(F.col("t.__tgt").isNotNull() | ~F.col("s.__is_hot"))
    return both.select(*[F.when(F.col("s.__src"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
                         for c in columns])


def upsert_counted(target: DataFrame, source: DataFrame, keys: Sequence[str],
                   null_keys: str = "raise", evolve: bool = False, check: bool = True,
                   broadcast_limit: int = DEFAULT_BROADCAST_ROWS,
                   delete_missing: bool = False,
                   broadcast_bytes: int = DEFAULT_BROADCAST_BYTES, one_scan: bool = False
                   ) -> tuple[DataFrame, int | None]:
    """:func:`upsert` plus the number of source rows (from the key check)."""
    keys = list(keys)
    if not keys:
        raise ValueError("upsert needs at least one key column")
    src, extra = align_source(target, source, evolve)
    n, size = check_source(target, src, keys, null_keys) if check else (None, None)
    # broadcast only a source proven small in rows *and* bytes
    use_broadcast = (n is not None and n <= broadcast_limit
                     and size <= broadcast_bytes)

    tgt = target
    for c in extra:  # evolved columns: NULL on untouched target rows
        tgt = tgt.withColumn(c, F.lit(None).cast(src.schema[c].dataType))
    columns = list(tgt.columns)
    if one_scan and not use_broadcast:
        return _one_scan(tgt, src, keys, columns, delete_missing), n

    marked = src.withColumn("__src", F.lit(True))
    s_side = F.broadcast(marked) if use_broadcast else marked
    t, s = tgt.alias("t"), s_side.alias("s")
    cond = None
    for k in keys:
        c = F.col(f"t.{k}") == F.col(f"s.{k}")
        cond = c if cond is None else cond & c
    matched = F.col("s.__src").isNotNull()
    # an inner join drops the target rows no source row matches (delete_missing)
    updated = t.join(s, cond, "inner" if delete_missing else "left").select(*[
        (F.col(f"t.{c}") if c in keys
         else F.when(matched, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))).alias(c)
        for c in columns
    ])

    # Target keys that some source row matches, collapsed to distinct keys:
    # at most one row per source key. Broadcast path: semi join first (no
    # target shuffle), then distinct, then broadcast to the anti join.
    # Shuffle path: distinct first, which collapses a hot target key
    # map-side and gives the key set its own exchange; sharing the update
    # join's target exchange would stop AQE from splitting that join.
    src_keys = src.select(*keys)
    if use_broadcast:
        matched_keys = F.broadcast(
            tgt.select(*keys).join(F.broadcast(src_keys), keys, "left_semi").distinct())
    else:
        matched_keys = tgt.select(*keys).distinct().join(src_keys, keys, "left_semi")
    inserts = src.join(matched_keys, keys, "left_anti").select(*columns)
    return updated.unionByName(inserts), n


def load_frame(current: DataFrame | None, incoming: DataFrame, keys: Sequence[str],
               load_type: str = "delta", **kwargs) -> tuple[DataFrame, str]:
    """SNK-12 without storage: full (or first) load replaces, delta upserts.

    Returns the new table contents and the effective load type.
    """
    if load_type not in ("full", "delta"):
        raise ValueError(f"load_type must be 'full' or 'delta', not {load_type!r}")
    if load_type == "full" or current is None:
        return incoming, "full"
    return upsert(current, incoming, keys, **kwargs), "delta"
