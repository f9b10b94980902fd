"""Parcels from labelled pixels: segments, outlines, statistics, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilth.operators import crs
from tilth.operators import geometry as G
from tilth.operators.components import connected_components
from tilth.operators.quantile import exact_quantiles
from tilth.scratch import materialize

CELL = 1 << 24


def _islands(pixels: DataFrame, by: Sequence[str]) -> DataFrame:
    """Adds ``island``, which neighbours of one class in a row share, and ``start``, its first pixel."""
    in_row = W.partitionBy(*by, "py", "label").orderBy("px")
    p = pixels.withColumn("island", F.col("px") - F.row_number().over(in_row))
    return p.withColumn("start", F.min("px").over(W.partitionBy(*by, "py", "label", "island")))


def parcel_runs(pixels: DataFrame, by: Sequence[str] = ("raster_id",)) -> DataFrame:
    """(by, py, label, start, end, parcel): the parcels of ``segments`` as runs of pixels, ``end`` included.

    Rows of pixels are cut into runs, runs of neighbouring rows that overlap are
    joined, and components are found among runs, which are far fewer than pixels.
    """
    by = list(by)
    runs = _islands(pixels, by).groupBy(*by, "py", "label", "start").agg(F.max("px").alias("end"))
    run_id = (F.col("py") * CELL + F.col("start")).cast("long")
    # component nodes must be unique over all rasters: the place of a run, numbered once
    runs = materialize(runs.withColumn("run", run_id).withColumn("node", F.monotonically_increasing_id()), "parcel-runs")
    below = runs.select(*by, "label", (F.col("py") - 1).alias("py"), F.col("start").alias("start2"), F.col("end").alias("end2"), F.col("node").alias("node2"))
    touch = runs.join(below, [*by, "label", "py"]).filter("start <= end2 and start2 <= end")
    comp = connected_components(touch, "node", "node2")
    named = runs.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    first = named.groupBy("component").agg(F.min("run").alias("parcel"))
    return named.join(first, "component").select(*by, "py", "label", "start", "end", "parcel")


def segments(pixels: DataFrame, by: Sequence[str] = ("raster_id",)) -> DataFrame:
    """Adds ``parcel``: the 4-connected component of equal class, named by its first pixel.

    ``parcel`` is py * 2^24 + px of the component's first pixel in row order.
    """
    by = list(by)
    return _islands(pixels, by).join(parcel_runs(pixels, by).drop("end"), [*by, "py", "label", "start"]).drop("island", "start")


def outline(parcels: DataFrame, by: Sequence[str] = ("raster_id",)) -> DataFrame:
    """Pixel edges with no neighbour of the same parcel: (by, parcel, x, y, vertical)."""
    sides = F.array(*[F.struct((F.col("px") + dx).alias("x"), (F.col("py") + dy).alias("y"), F.lit(v).alias("vertical")) for dx, dy, v in ((0, 0, False), (0, 1, False), (0, 0, True), (1, 0, True))])
    edge = parcels.select(*by, "parcel", F.explode(sides).alias("e")).select(*by, "parcel", "e.*")
    return edge.groupBy(*by, "parcel", "x", "y", "vertical").agg(F.count(F.lit(1)).alias("k")).filter("k = 1").drop("k")


def statistics(parcels: DataFrame, by: Sequence[str] = ("raster_id",), pixel_area: float = 100.0) -> DataFrame:
    """Pixels, area, bounds and majority class of each parcel."""
    return parcels.groupBy(*by, "parcel").agg(
        F.count(F.lit(1)).alias("pixels"), (F.count(F.lit(1)) * pixel_area).alias("area_m2"), F.min("px").alias("minx"), F.min("py").alias("miny"), F.max("px").alias("maxx"), F.max("py").alias("maxy"), F.mode("label", True).alias("label")
    )


def result_checks(results: DataFrame) -> DataFrame:
    """(source, features, usable, problem) instead of an error at the first bad file."""
    good = G.nonempty(F.col("geom"))
    c = results.groupBy("source").agg(F.count(F.lit(1)).alias("features"), F.count_if(good).alias("usable"), F.count_if(F.col("srid").isNull()).alias("without_crs"))
    problem = F.when(F.col("without_crs") > 0, "no CRS").when(F.col("usable") == 0, "no usable geometry")
    return c.select("source", "features", "usable", problem.alias("problem"))


def summary(fields: DataFrame, fallback_srid: int | None = None) -> DataFrame:
    """Per source, layer and CRS: count, bounds, total and median hectares.

    Every row is projected once, from its own CRS.  A feature whose area is not a number counts
    as failed: the figures are of the others, and ``area_error`` says how many failed; without a
    formula for the CRS all fail, and the row stays.
    """
    srid = F.coalesce("srid", F.lit(fallback_srid)) if fallback_srid is not None else F.col("srid")
    f = fields.withColumn("srid", srid).filter(G.nonempty(F.col("geom")))
    f = f.select("source", "layer", "srid", G.bounds(F.col("geom")).alias("b"), (crs.area_m2(F.col("geom"), F.col("srid")) / 10000).alias("ha"))
    f = materialize(f.withColumn("ha", F.when(~F.isnan("ha"), F.col("ha"))), "parcel-areas")
    out = f.groupBy("source", "layer", "srid").agg(
        F.count(F.lit(1)).alias("feature_count"), F.min("b.minx").alias("minx"), F.min("b.miny").alias("miny"), F.max("b.maxx").alias("maxx"), F.max("b.maxy").alias("maxy"), F.sum("ha").alias("total_area_ha"), F.count("ha").alias("measured")
    )
    middle = exact_quantiles(f, ("source", "layer", "srid"), "ha", (0.5,)).select("key", F.get("q", F.lit(0)).alias("median_area_ha"))
    out = out.withColumn("key", F.struct("source", "layer", "srid")).join(middle, "key", "left").drop("key")
    failed = F.col("feature_count") - F.col("measured")
    error = F.when(~crs.known(F.col("srid")) & (F.coalesce("srid", F.lit(0)) != 6933), F.concat(F.lit("no equal-area transformation from EPSG:"), F.coalesce(F.col("srid").cast("string"), F.lit("none"))))
    error = error.when(failed > 0, F.concat(failed.cast("string"), F.lit(" of "), F.col("feature_count").cast("string"), F.lit(" features have no area")))
    return out.withColumn("area_error", error).drop("measured")
