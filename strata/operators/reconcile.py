"""Does a copy hold the same rows as its source?

Each side is reduced to one row per partition value: its row count, two
order-free set hashes (a sum that repeated rows change, and an exclusive or) and a
mergeable sketch of its distinct keys. Both sides are read once, partial
aggregates meet in one small shuffle, and the results are stored, so a
source can be compared with a copy made later. Only partitions that differ
are looked at row by row.

NULLs take part in a row's hash together with their place, NULL partition
values are a partition of their own, repeated rows count. Columns of a type
without a hash (maps) have to be left out or turned into text first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FINGERPRINT_SCHEMA = ("partition string, rows bigint, hash_sum decimal(38,0), hash_xor bigint, "
                      "keys_sketch binary")


def row_hash(columns: Sequence[str]) -> Column:
    """64 bits of a row. A hash of columns alone passes over NULLs, so that
    (NULL, x) and (x, NULL) would be equal: whether each is NULL is hashed too."""
    return F.xxhash64(*[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns])


def fingerprints(df: DataFrame, keys: Sequence[str], partition: Column,
                 columns: Sequence[str] | None = None) -> DataFrame:
    """One row per value of ``partition`` (as text) of ``df``, over ``columns``
    (all of them by default, in the order of their names)."""
    h = row_hash(sorted(columns or df.columns))
    return (df.select(partition.cast("string").alias("partition"), h.alias("__h"),
                      F.xxhash64(*keys).alias("__k"))
            .groupBy("partition").agg(
                F.count(F.lit(1)).alias("rows"),
                F.sum(F.col("__h").cast("decimal(28,0)")).alias("hash_sum"),
                F.bit_xor("__h").alias("hash_xor"),
                F.hll_sketch_agg("__k").alias("keys_sketch")))


def distinct_keys(prints: DataFrame) -> DataFrame:
    """Estimated number of distinct keys over all partitions, one row
    (``distinct_keys``): the partitions' sketches are merged, no row is read."""
    return prints.agg(F.hll_sketch_estimate(F.hll_union_agg("keys_sketch")).alias("distinct_keys"))


def differing(source: DataFrame, target: DataFrame) -> DataFrame:
    """Partitions whose fingerprints differ: (partition, source_rows,
    target_rows), 0 where a side has no such partition."""
    side = lambda df, p: df.select(F.lit(True).alias(f"{p}_in"), *[
        F.col(c).alias(f"{p}_{c}") for c in ("partition", "rows", "hash_sum", "hash_xor")])
    both = side(source, "s").join(side(target, "t"),
                                  F.col("s_partition").eqNullSafe(F.col("t_partition")), "full")
    same = (F.col("s_in") & F.col("t_in") & (F.col("s_rows") == F.col("t_rows"))
            & (F.col("s_hash_sum") == F.col("t_hash_sum")) & (F.col("s_hash_xor") == F.col("t_hash_xor")))
    return both.where(~F.coalesce(same, F.lit(False))).select(
        F.when(F.col("s_in"), F.col("s_partition")).otherwise(F.col("t_partition")).alias("partition"),
        F.coalesce("s_rows", F.lit(0)).alias("source_rows"),
        F.coalesce("t_rows", F.lit(0)).alias("target_rows"))


def row_differences(source: DataFrame, target: DataFrame, keys: Sequence[str], partition: Column,
                    found: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Keys whose rows differ, in the partitions ``found`` only: the key columns,
    ``problem``, ``source_rows`` and ``target_rows`` (both counted there).

    ``lost`` has no row in the target, ``extra`` none in the source, ``doubled``
    and ``fewer`` have more and fewer rows there, ``altered`` as many, but other
    ones. Rows become hashes that sum up per key before the shuffle, so a key
    that holds much of a table is as small as any other. A row that moved to
    another partition is altered, as both of its partitions differ."""
    columns = sorted(columns or source.columns)
    keys = list(keys)
    p = found.select(F.col("partition").alias("__found"))

    def side(df: DataFrame, sign: int) -> DataFrame:
        p_text = partition.cast("string")
        here = df.select(*keys, p_text.alias("__p"), F.xxhash64(row_hash(columns), p_text).alias("__h"))
        return (here.join(p, F.col("__p").eqNullSafe(F.col("__found")), "left_semi")
                .select(*keys, F.lit(sign).alias("__side"), F.col("__h").cast("decimal(28,0)").alias("__h")))

    def of(sign: int, value: Column) -> Column:
        return F.sum(F.when(F.col("__side") == sign, value).otherwise(F.lit(0)))

    n = F.lit(1).cast("bigint")
    sums = side(source, 1).unionByName(side(target, -1)).groupBy(*keys).agg(
        of(1, n).alias("source_rows"), of(-1, n).alias("target_rows"),
        F.sum(F.col("__h") * F.col("__side")).alias("__off"))
    s, t = F.col("source_rows"), F.col("target_rows")
    problem = (F.when(t == 0, "lost").when(s == 0, "extra").when(t > s, "doubled").when(t < s, "fewer")
               .when(F.col("__off") != 0, "altered"))
    return (sums.withColumn("problem", problem).where(F.col("problem").isNotNull())
            .select(*keys, "problem", "source_rows", "target_rows"))
