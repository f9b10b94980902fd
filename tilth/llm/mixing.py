"""Mixing sources to target weights as a time-varying curriculum.

Every source has a weight schedule over training time t in [0, 1], given as
piecewise linear knots.  The integral of the schedule is the source's weight in
the whole mix.  Weights become token targets by water filling: a source never
gives more than ``max_epochs`` times its size, and what it can't give goes to
the others by weight.

A source's documents lie on a tape in an order given by a hash of their key, and
the tape is read again for each epoch.  The offset of a document on the tape,
divided by the target, is the share of the source's demand that is spent before
it.  Inverting the integrated schedule turns that share into the document's
training position, and documents are range-sorted by position.

Offsets are sums over two levels (buckets of a source, then rows of a bucket),
so a source with most of the rows is spread over many tasks.  Everything is a
DataFrame expression.

Defined results: a null or empty text has size 0 and is never taken; a null
source is a source of its own, last in order; rows without a key are ordered by
a hash of their other columns; repeated rows each have their own place; an
empty table gives an empty result; columns of the input travel in one struct, so
their names clash with nothing.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Shapes of the schedules, as (t, multiplier) knots; each integrates to 1.
FADING = ((0.0, 1.5), (1.0, 0.5))
LEVEL = ((0.0, 1.0), (1.0, 1.0))
RISING = ((0.0, 0.5), (1.0, 1.5))
SOURCE_KEY = ["is_null", "name"]


def _source_key(source: Column) -> list[Column]:
    return [source.isNull().alias("is_null"), F.coalesce(source.cast("string"), F.lit("")).alias("name")]


def cyclic_schedule(sources: DataFrame, weights: Sequence[float], shapes: Sequence[Sequence[tuple[float, float]]]) -> DataFrame:
    """Adds ``knots`` to a table with one row per source.

    Sources are ranked by code point, null last; weights and shapes repeat.  The
    table is a dimension: one row per source, not per document.
    """
    rank = F.row_number().over(W.orderBy("is_null", "name")) - 1
    turn = rank % len(weights)
    knots = F.array(*[F.array(*[F.struct(F.lit(float(t)).alias("t"), F.lit(float(w * m)).alias("w")) for t, m in shapes[i % len(shapes)]]) for i, w in enumerate(weights)])
    return sources.withColumn("knots", knots[turn])


def _segments(knots: Column) -> Column:
    """Knots to segments with the integral before each: start, t0, w0, slope, area."""
    pairs = F.arrays_zip(F.slice(knots, 1, F.size(knots) - 1).alias("a"), F.slice(knots, 2, F.size(knots) - 1).alias("b"))
    flat = F.transform(
        pairs,
        lambda p: F.struct(
            p["a"]["t"].alias("t0"),
            p["a"]["w"].alias("w0"),
            F.coalesce(F.try_divide(p["b"]["w"] - p["a"]["w"], p["b"]["t"] - p["a"]["t"]), F.lit(0.0)).alias("slope"),
            ((p["a"]["w"] + p["b"]["w"]) / 2 * (p["b"]["t"] - p["a"]["t"])).alias("area"),
        ),
    )
    return F.transform(
        flat,
        lambda s, i: F.struct(F.aggregate(F.slice(flat, F.lit(1), i), F.lit(0.0), lambda acc, x: acc + x["area"]).alias("start"), s["t0"].alias("t0"), s["w0"].alias("w0"), s["slope"].alias("slope"), s["area"].alias("area")),
    )


def _invert(segments: Column, demand: Column) -> Column:
    """The time at which the integral of a schedule reaches ``demand``."""
    seg = F.coalesce(F.element_at(F.filter(segments, lambda s: (s["start"] <= demand) & (s["area"] > 0)), -1), segments[0])
    left = demand - seg["start"]
    root = F.sqrt(F.greatest(F.lit(0.0), seg["w0"] * seg["w0"] + 2 * seg["slope"] * left))
    return F.least(F.lit(1.0), seg["t0"] + F.coalesce(F.try_divide(2 * left, seg["w0"] + root), F.lit(0.0)))


def source_targets(sources: DataFrame, max_epochs: int) -> DataFrame:
    """Adds weight, target and segments to (is_null, name, source_size, knots).

    Water filling in closed form: in order of cap / weight, a source is full if
    raising the level to its own cap spends no more than all sizes together.
    """
    s = sources.withColumn("segments", _segments(F.col("knots")))
    s = s.withColumn("weight", F.aggregate("segments", F.lit(0.0), lambda acc, x: acc + x["area"]))
    s = s.withColumn("cap", (F.col("source_size") * max_epochs).cast("double"))
    s = s.withColumn("level", F.coalesce(F.try_divide(F.col("cap"), F.col("weight")), F.lit(math.inf)))
    every, upto = W.partitionBy(), W.orderBy("level", *SOURCE_KEY)
    s = s.withColumns({"total": F.sum("source_size").over(every).cast("double"), "caps": F.sum("cap").over(upto), "light": F.sum("weight").over(every) - F.sum("weight").over(upto)})
    s = s.withColumn("full", (F.col("weight") > 0) & (F.col("caps") + F.when(F.col("light") > 1e-12, F.col("level") * F.col("light")).otherwise(0.0) <= F.col("total")))
    spent = F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(every), F.lit(0.0))
    open_ = F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(every), F.lit(0.0))
    s = s.withColumn("share", F.coalesce(F.try_divide(F.col("total") - spent, open_), F.lit(0.0)))
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("share") * F.col("weight")))
    return s.select(*SOURCE_KEY, "source_size", F.coalesce(target, F.lit(0.0)).alias("target"), "weight", "segments")


def mix(
    docs: DataFrame,
    size: Column,
    *,
    source: str = "source",
    key: str = "doc_id",
    weights: Sequence[float] = (5, 2, 1),
    shapes: Sequence[Sequence[tuple[float, float]]] = (FADING, LEVEL, RISING),
    max_epochs: int = 3,
    rows_per_bucket: int = 512,
) -> DataFrame:
    """One row per document: ``row`` (its columns), size, source_size, target,
    taken, ``copies``, an array of (epoch, words, position), and ``order``, the
    hash that places the document on its source's tape.

    A copy with fewer words than the document ends the source's demand: it is
    the document's first words.  ``taken`` sums the words of the copies, so a
    source gives its rounded target exactly.
    """
    sized = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), size.cast("long").alias("size"))
    sized = sized.select("row", "size", *_source_key(F.col(f"row.`{source}`")))
    own = F.col(f"row.`{key}`")
    order = F.when(own.isNull(), F.xxhash64(F.to_json("row"))).otherwise(F.xxhash64(own))
    rows = sized.select("size", *SOURCE_KEY).agg(F.count(F.lit(1))).first()[0]
    bits = max(0, math.ceil(math.log2(max(1, rows / max(rows_per_bucket, math.isqrt(rows))))))
    bucket = F.shiftrightunsigned(order, 64 - bits) if bits else F.lit(0).cast("long")
    sized = sized.withColumn("order", order).withColumn("bucket", bucket)

    buckets = sized.groupBy(*SOURCE_KEY, "bucket").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(W.partitionBy(*SOURCE_KEY).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))
    buckets = buckets.select(*SOURCE_KEY, "bucket", F.coalesce(before, F.lit(0)).alias("bucket_start"))
    sources = sized.groupBy(*SOURCE_KEY).agg(F.sum("size").alias("source_size"))
    sources = source_targets(cyclic_schedule(sources, weights, shapes), max_epochs)

    tape = sized.join(buckets.join(sources, SOURCE_KEY), [*SOURCE_KEY, "bucket"])
    inside = F.sum("size").over(W.partitionBy(*SOURCE_KEY, "bucket").orderBy("order", "size", own).rowsBetween(W.unboundedPreceding, -1))
    tape = tape.withColumn("start", F.col("bucket_start") + F.coalesce(inside, F.lit(0)))
    left = F.round("target").cast("long") - F.col("start")
    spent = lambda e: e * F.col("source_size") + F.col("start")
    copies = F.filter(
        F.transform(
            F.array(*[F.lit(e).cast("long") for e in range(max_epochs)]),
            lambda e: F.struct(
                e.alias("epoch"),
                F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), left - e * F.col("source_size"))).alias("words"),
                _invert(F.col("segments"), F.coalesce(F.try_divide(spent(e), F.col("target")), F.lit(0.0)) * F.col("weight")).alias("position"),
            ),
        ),
        lambda c: c["words"] > 0,
    )
    tape = tape.withColumn("copies", copies)
    return tape.select("row", "size", "source_size", "target", F.aggregate("copies", F.lit(0).cast("long"), lambda acc, c: acc + c["words"]).alias("taken"), "copies", "order")


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    parts = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    return F.array_join(F.slice(parts, F.lit(1), n.cast("int")), "")


def mixed_documents(docs: DataFrame, size: Column, *, text: str = "text", length: str = "n_chars", **options) -> DataFrame:
    """The documents of the mix with the input's columns, in training order.

    A document appears once per copy.  A cut copy has its first words as text and
    its new length in ``length``.
    """
    m = mix(docs, size, **options).select("row", "size", "order", F.explode("copies").alias("copy"))
    cut = F.col("copy.words") < F.col("size")
    short = first_words(F.col(f"row.`{text}`"), F.col("copy.words"))
    changed = {text: F.when(cut, short).otherwise(F.col(f"row.`{text}`"))}
    if length in docs.columns:
        changed[length] = F.when(cut, F.length(short).cast(docs.schema[length].dataType)).otherwise(F.col(f"row.`{length}`"))
    m = m.orderBy("copy.position", "order", "copy.epoch")
    return m.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
