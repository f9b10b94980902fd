"""Connected components by alternating large-star and small-star rounds.

After Kiveris et al., "Connected Components in MapReduce and Beyond" (2014).
Each round is two aggregations by node with map-side combining and two joins
that adaptive execution can split; no neighbour list is ever collected, and
every round is written to shared scratch, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilth.scratch import materialize, replaced


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on distinct edges (a, b) with a > b."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        moved = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.distinct()
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    moved = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, src: str | Column = "src", dst: str | Column = "dst", max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable, for nodes with an edge.

    Loops and repeated edges are ignored.  Raises if ``max_rounds`` do not do.
    """
    a, b = (F.col(c) if isinstance(c, str) else c for c in (src, dst))
    e = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct()
    e = materialize(e, "components")
    seen = _digest(e)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        e = replaced(e, _star(_star(e, True), False), "components")
        now = _digest(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
