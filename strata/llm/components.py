"""Connected components of an edge table, by alternating star contractions.

Large-star links every node's larger neighbours to its smallest neighbour,
small-star does so with the smaller ones; both are a min-aggregate and a join,
so a node with a third of all edges is pre-aggregated on the map side and its
join is split by adaptive execution. Edges stay in tables; the driver sees a
count and a checksum per round. Each round is written to the shared folder,
so its plan does not grow and a lost executor costs no earlier round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import discard, keep


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m"))
    return (both.join(least, "u").where("v > u and v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = (edges.join(least, "u").where("v != m")
             .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for every node of ``edges``: root is the smallest node
    that its links reach, itself included.

    ``a`` and ``b`` are integer columns. Loops and edges with a null end are
    ignored, repeated edges count once; an empty table gives an empty result.
    """
    pair = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    now = keep(pair.where("a != b")
               .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
               .distinct(), "edges")
    mark = None
    while True:
        after = keep(_small_star(_large_star(now)), "edges")
        seen = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(now)
        now = after
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
