"""Exact quantiles of groups of any size, by refining a histogram.

The built-in exact percentile keeps all distinct values of a group in one buffer.
Here values are counted in bins of equal width in the logarithm first, with
map-side sums; only the bins that hold a wanted rank are then looked into, by
distinct value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Bins for each doubling of a value.
PER_DOUBLING = 256
_BEYOND = 1 << 20  # past all bins of positive doubles


def _bin(v: Column) -> Column:
    """A number that never falls as the value grows: negative values, zero, positive values."""
    size = F.floor(F.log2(F.abs(v)) * PER_DOUBLING).cast("long")
    return F.when(v > 0, size).when(v < 0, -2 * _BEYOND - size).otherwise(-_BEYOND)


def exact_quantiles(table: DataFrame, by: Sequence[str], value: str, shares: Sequence[float]) -> DataFrame:
    """(key, q): ``key`` is the struct of ``by``, ``q`` the interpolated quantiles in order.

    Nulls are left out; a group without values has no row.  Null keys are a group.
    """
    v = table.filter(F.col(value).isNotNull()).select(F.struct(*by).alias("key"), F.col(value).cast("double").alias("v")).withColumn("bin", _bin(F.col("v")))
    counts = v.groupBy("key", "bin").agg(F.count(F.lit(1)).alias("n"))
    prior = W.partitionBy("key").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumns({"before": F.coalesce(F.sum("n").over(prior), F.lit(0)), "total": F.sum("n").over(W.partitionBy("key"))})
    place = lambda q: F.lit(float(q)) * (F.col("total") - 1)
    low = lambda q: F.floor(place(q))
    ranks = F.array(*[r for q in shares for r in (low(q), F.ceil(place(q)))])
    holds = lambda first, n: F.exists(ranks, lambda r: (r >= first) & (r < first + n))
    wanted = counts.filter(holds(F.col("before"), F.col("n"))).drop("n")
    inside = v.join(wanted, ["key", "bin"]).groupBy("key", "bin", "before", "total", "v").agg(F.count(F.lit(1)).alias("n"))
    prior = W.partitionBy("key", "bin").orderBy("v").rowsBetween(W.unboundedPreceding, -1)
    inside = inside.withColumn("before", F.col("before") + F.coalesce(F.sum("n").over(prior), F.lit(0)))
    at = lambda r: F.max(F.when((r >= F.col("before")) & (r < F.col("before") + F.col("n")), F.col("v")))
    ends = [F.struct(at(low(q)).alias("a"), at(F.ceil(place(q))).alias("b"), F.max(place(q) - low(q)).alias("part")) for q in shares]
    found = inside.groupBy("key").agg(F.array(*ends).alias("ends"))
    return found.select("key", F.transform("ends", lambda e: e["a"] * (1 - e["part"]) + e["b"] * e["part"]).alias("q"))
