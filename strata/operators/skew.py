"""Hot-key handling for joins of a large side with a per-key side.

AQE splits skewed sort-merge-join partitions only when both join inputs are
shuffle stages; when a side reuses an earlier partitioning (a header derived
from its own items, a chain of joins on one key) the hot partition stays in
one task. ``find_hot_keys`` + ``split_hot`` handle that explicitly:

1. ``find_hot_keys`` finds all keys with more than ``min_rows`` rows from the
   key column alone; there are fewer than rows / ``min_rows`` of them, kept in
   a staged table, so they never pass through the driver or the plan;
2. the set is broadcast while it is counted small, else joined like any other;
3. rows of hot keys join the per-key side's hot rows by broadcast, where
   they already are (no shuffle at all); all other rows take the normal
   shuffled join.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.sizing import DEFAULT_BROADCAST_BYTES, size_of
from strata.session import stage

DEFAULT_HOT_KEY_ROWS = 1_000_000
# keys of a set that is broadcast, at most
HOT_SET_ROWS = 1_000_000
HOT = "__hot_key"


# the smallest support that ``freqItems`` takes
LEAST_SUPPORT = 1e-4


def find_hot_keys(df: DataFrame, key: str, min_rows: int, label: str = "") -> DataFrame | None:
    """All keys of ``df`` holding more than ``min_rows`` rows, or ``None``.

    Where ``min_rows`` is a share of the rows that ``freqItems`` can look for,
    its one pass with bounded counters gives a superset of the keys (it has
    no false negatives), which is then counted exactly by a broadcast semi
    join: no shuffle of the key column. For a smaller share the keys are
    counted with a map-side-combined aggregate. Either way the result is
    exact and has fewer than rows / ``min_rows`` keys.
    ``label`` names the staged set.
    """
    n = df.count()
    if n <= min_rows:  # no key can have more rows than the table
        return None
    dtype = df.schema[key].dataType
    rows = df.select(key)
    if min_rows / n >= LEAST_SUPPORT:
        candidates = df.stat.freqItems([key], min_rows / n).first()[0] or []
        if not candidates:
            return None
        cand = df.sparkSession.createDataFrame(  # at most 1 / LEAST_SUPPORT
            [(v,) for v in candidates], T.StructType([T.StructField(HOT, dtype)]))
        rows = rows.join(F.broadcast(cand), F.col(key) == F.col(HOT), "left_semi")
    hot = (rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__rows"))
           .where(F.col("__rows") > F.lit(min_rows)).select(F.col(key).alias(HOT)))
    hot = stage(hot, f"hot-keys/{label or 'set'}-{uuid.uuid4().hex}")
    return None if hot.isEmpty() else hot


def _hinted(hot: DataFrame) -> DataFrame:
    return F.broadcast(hot) if hot.count() <= HOT_SET_ROWS else hot


def split_hot(big: DataFrame, big_key: Column, hot: DataFrame | None,
              build: Callable[[DataFrame, bool], DataFrame]) -> DataFrame:
    """Run ``build(part, hot_branch)`` on cold and hot rows of ``big``; union.

    ``build`` receives the rows and whether they are the hot branch, where
    it should broadcast the per-key side (restricted to hot keys, so its
    size is bounded by the hot-key count).
    """
    if hot is None:
        return build(big, False)
    keys = _hinted(hot)
    cold = big.join(keys, big_key == F.col(HOT), "left_anti")
    hot_rows = big.join(keys, big_key == F.col(HOT), "left_semi")
    return build(cold, False).unionByName(build(hot_rows, True))


def restrict_to_hot(side: DataFrame, side_key: Column, hot: DataFrame,
                    broadcast_limit: int = 1_000_000) -> DataFrame:
    """Rows of the per-key side whose key is hot, broadcast when counted small.

    For a per-key side (one header per delivery) this is one row per hot key;
    the count makes that bound a checked one. A hot key that is also hot on
    this side (many-to-many) stays a shuffled join. The rows are staged (column
    names must differ), so the side is not computed again after the count.
    """
    rows = stage(side.join(_hinted(hot), side_key == F.col(HOT), "left_semi"),
                 f"hot-rows/{uuid.uuid4().hex}")
    n, size = size_of(rows)
    small = n <= broadcast_limit and size <= DEFAULT_BROADCAST_BYTES
    return F.broadcast(rows) if small else rows
