"""Connected components of a graph given as an edge table.

Alternating large-star and small-star rounds (Kiveris et al., 2014).  A round
links every node to the smallest node it knows; rounds are logarithmic in
practice.  Each round is two aggregations and joins on node ids and is written
to the shared folder, so no lineage grows and a lost executor costs a re-read.
No component ever meets in one task: a node with many neighbours takes part in
joins only, which Spark splits when they are skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.scratch import materialize

MAX_ROUNDS = 100


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    hooked = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hooked.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``node, component`` for every node of an edge; component is the smallest node.

    Loops and repeated edges are harmless; edges with a null end are no edges.
    """
    a, b = F.col(left), F.col(right)
    start = edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    current = materialize(start, "edges")
    before = _signature(current)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        current = materialize(_small_star(_large_star(current).distinct()), "edges")
        after = _signature(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
