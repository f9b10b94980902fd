"""Raster operators on pixel tables (raster_id, px, py, value...) and their headers."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilth.operators import crs
from tilth.operators import geometry as G
from tilth.operators.quantile import exact_quantiles


def clip(pixels: DataFrame, meta: DataFrame, aoi: DataFrame) -> DataFrame:
    """Pixels of each raster's AOI window; outside the AOI they are nodata.

    ``meta`` has raster_id, ox, oy, rx, ry (origin in the upper left, pixel size),
    width, height, nodata; ``aoi`` has raster_id, geom.  A pixel is kept if its centre is
    inside.  The window is the AOI's bounds in whole pixels and px, py start there.
    """
    b = G.bounds(F.col("geom"))
    w = meta.join(aoi, "raster_id").withColumn("b", b)
    w = w.withColumns({
        "x0": F.greatest(F.lit(0), F.floor((F.col("b.minx") - F.col("ox")) / F.col("rx"))).cast("long"),
        "x1": F.least("width", F.ceil((F.col("b.maxx") - F.col("ox")) / F.col("rx"))).cast("long"),
        "y0": F.greatest(F.lit(0), F.floor((F.col("oy") - F.col("b.maxy")) / F.col("ry"))).cast("long"),
        "y1": F.least("height", F.ceil((F.col("oy") - F.col("b.miny")) / F.col("ry"))).cast("long"),
    })
    w = w.filter("x1 > x0 and y1 > y0").withColumn("edges", F.flatten(F.transform(G.rings(F.col("geom")), G.edges)))
    # where each row of pixels crosses the AOI's edges is found once, not for each pixel
    rows = w.withColumn("py", F.explode(F.sequence("y0", F.col("y1") - 1))).withColumn("y", F.col("oy") - (F.col("py") + 0.5) * F.col("ry"))
    y = F.col("y")
    x_at = lambda e: (e["b"]["x"] - e["a"]["x"]) * F.coalesce(F.try_divide(y - e["a"]["y"], e["b"]["y"] - e["a"]["y"]), F.lit(0.0)) + e["a"]["x"]
    ends = lambda e, c: (F.least(e["a"][c], e["b"][c]), F.greatest(e["a"][c], e["b"][c]))
    level = lambda e, x: F.when(e["a"]["y"] == e["b"]["y"], x).otherwise(x_at(e))
    touched = F.filter("edges", lambda e: y.between(*ends(e, "y")))
    on = F.transform(touched, lambda e: F.struct(level(e, ends(e, "x")[0]).alias("low"), level(e, ends(e, "x")[1]).alias("high")))
    crossed = F.transform(F.filter("edges", lambda e: (e["a"]["y"] > y) != (e["b"]["y"] > y)), x_at)
    rows = rows.select("raster_id", "py", "ox", "rx", F.coalesce("nodata", F.lit(0.0)).alias("nodata"), "x0", "x1", "y0", crossed.alias("crossed"), on.alias("on"))
    hit = pixels.join(rows, ["raster_id", "py"]).filter("px >= x0 and px < x1")
    x = F.col("ox") + (F.col("px") + 0.5) * F.col("rx")
    inside = (F.size(F.filter("crossed", lambda c: x < c)) % 2 == 1) | F.exists("on", lambda s: x.between(s["low"], s["high"]))
    # the value first: in one select, px and py would be the shifted ones
    return hit.withColumn("value", F.when(inside, F.col("value")).otherwise(F.col("nodata"))).select("raster_id", (F.col("px") - F.col("x0")).alias("px"), (F.col("py") - F.col("y0")).alias("py"), "value")


def chunk_pixels(chunks: DataFrame, w: int, h: int) -> DataFrame:
    """(raster_id, band, px, py, value) from chunk rows (raster_id, band, cx, cy, values).

    Chunks are w x h pixels, their values in row order; a chunk at the right edge must be whole.
    """
    p = chunks.select("raster_id", "band", "cx", "cy", F.posexplode("values").alias("i", "value"))
    at = F.col("i")
    return p.select("raster_id", "band", (F.col("cx").cast("long") * w + at % w).alias("px"), (F.col("cy").cast("long") * h + F.floor(at / w)).alias("py"), F.col("value").cast("double").alias("value"))


def chunk_grid(geoms: DataFrame, degrees: float, by: Sequence[str]) -> DataFrame:
    """Boxes of ``degrees`` over each geometry's bounds, cut to them, that meet it."""
    if degrees <= 0:
        raise ValueError("the chunk size must be positive")
    b = geoms.filter(G.nonempty(F.col("geom"))).select(*by, "geom", G.bounds(F.col("geom")).alias("b"))
    b = b.withColumn("whole", F.col("geom") == G.box(F.col("b.minx"), F.col("b.miny"), F.col("b.maxx"), F.col("b.maxy")))
    many = lambda lo, hi: F.greatest(F.lit(1), F.ceil((F.col(f"b.{hi}") - F.col(f"b.{lo}")) / degrees)).cast("int")
    b = b.withColumn("ix", F.explode(F.sequence(F.lit(0), many("minx", "maxx") - 1)))
    b = b.withColumn("iy", F.explode(F.sequence(F.lit(0), many("miny", "maxy") - 1)))
    low = lambda i, lo: F.col(f"b.{lo}") + F.col(i) * degrees
    b = b.withColumns({"minx": low("ix", "minx"), "miny": low("iy", "miny")})
    b = b.withColumns({"maxx": F.least(F.col("minx") + degrees, F.col("b.maxx")), "maxy": F.least(F.col("miny") + degrees, F.col("b.maxy"))})
    cell = G.box(F.col("minx"), F.col("miny"), F.col("maxx"), F.col("maxy"))
    # chunks are within the bounds, so of a geometry that is its own bounds they are whole
    part = F.when(F.col("whole"), cell).otherwise(G.clip_convex(F.col("geom"), cell))
    # the generator makes the part once, though several conditions read it
    b = b.withColumn("part", F.explode(F.filter(F.array(part), lambda g: (F.size(g) > 0) & (G.area(g) > 0))))
    return b.select(*by, F.format_string("chunk_%04d_%04d", "ix", "iy").alias("chunk_id"), "ix", "iy", "minx", "miny", "maxx", "maxy", F.col("part").alias("geom"))


def merge_first(chunks: DataFrame, order: Sequence[str], pixel: Sequence[str], nodata: float = 0.0) -> DataFrame:
    """First valid value per pixel in chunk order; nodata where none is valid."""
    valid = F.col("value") != nodata
    best = F.min_by("value", F.when(valid, F.struct(*order)))
    return chunks.groupBy(*pixel).agg(F.coalesce(best, F.lit(nodata)).alias("value"))


def contrast_stretch(pixels: DataFrame, by: Sequence[str], low: float = 0.02, high: float = 0.98) -> DataFrame:
    """Each band from its ``low`` to its ``high`` percentile to 0..1, on all pixels.

    Valid values are finite and positive; a band without any becomes zeros; NaN
    stays NaN; a constant band is stretched over one unit.
    """
    v = F.col("value")
    valid = ~F.isnan(v) & (v > 0) & (v < float("inf"))
    cuts = exact_quantiles(pixels.filter(valid), by, "value", (low, high))
    cuts = cuts.select("key", F.get("q", F.lit(0)).alias("lo"), F.get("q", F.lit(1)).alias("hi"))
    cuts = cuts.select("key", "lo", F.when(F.col("hi") <= F.col("lo"), F.col("lo") + 1).otherwise(F.col("hi")).alias("hi"))
    scaled = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (v - F.col("lo")) / (F.col("hi") - F.col("lo"))))
    out = F.when(F.col("lo").isNull(), 0.0).when(F.isnan(v), v).otherwise(scaled).cast("float")
    return pixels.withColumn("key", F.struct(*by)).join(cuts, "key", "left").withColumn("value", out).select(*pixels.columns)


def decimate(pixels: DataFrame, meta: DataFrame, most: int) -> DataFrame:
    """Nearest pixels of a raster cut down to at most ``most`` per side.

    Output cell i takes source pixel floor((i + 0.5) * size / out_size).
    """
    scale = F.greatest(F.col("width") / most, F.col("height") / most, F.lit(1.0))
    m = meta.withColumns({"out_w": F.greatest(F.lit(1), (F.col("width") / scale).cast("int")), "out_h": F.greatest(F.lit(1), (F.col("height") / scale).cast("int"))})
    source = lambda i, size, out: F.floor((F.col(i) + 0.5) * F.col(size) / F.col(out)).cast("long")
    xs = m.select("raster_id", "width", "out_w", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("out_w") - 1).cast("long"))).alias("qx")).select("raster_id", "qx", source("qx", "width", "out_w").alias("px"))
    ys = m.select("raster_id", "height", "out_h", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("out_h") - 1).cast("long"))).alias("qy")).select("raster_id", "qy", source("qy", "height", "out_h").alias("py"))
    out = pixels.join(xs, ["raster_id", "px"]).join(ys, ["raster_id", "py"])
    return out.drop("px", "py").withColumnsRenamed({"qx": "px", "qy": "py"})


def decimated_meta(meta: DataFrame, most: int) -> DataFrame:
    scale = F.greatest(F.col("width") / most, F.col("height") / most, F.lit(1.0))
    w, h = F.greatest(F.lit(1), (F.col("width") / scale).cast("int")), F.greatest(F.lit(1), (F.col("height") / scale).cast("int"))
    return meta.withColumns({"rx": F.col("rx") * F.col("width") / w, "ry": F.col("ry") * F.col("height") / h, "width": w.cast("long"), "height": h.cast("long")})


def overlay_segments(features: DataFrame, keys: Sequence[str], srid: Column, target: int) -> DataFrame:
    """(keys, ring, seq, x1, y1, x2, y2): the outlines of an overlay frame in the raster's CRS, from each row's own.

    A row whose CRS has no formula has no segments.
    """
    moved = features.select(*keys, crs.to_crs_by_row(F.col("geom"), srid, target).alias("geom")).filter(G.nonempty(F.col("geom")))
    return moved.select(*keys, F.explode(G.boundary(F.col("geom"))).alias("s")).select(*keys, "s.*")


def usable(meta: DataFrame) -> DataFrame:
    """Rasters with at least three bands."""
    return meta.filter(F.size("band_names") >= 3)


def reorder(bands: Column, order: Sequence[int]) -> Column:
    """An array of bands in a 1-based order."""
    return F.array(*[F.element_at(bands, i) for i in order])


def stride(size: int, overlap: int) -> int:
    if size <= 0 or not 0 <= overlap < size:
        raise ValueError("window sizes are positive and larger than their overlap")
    return size - overlap


def _starts(length: Column, size: int, step: int) -> Column:
    """Window starts; the last window is flush with the edge."""
    last = F.greatest(length - size, F.lit(0))
    return F.array_distinct(F.concat(F.sequence(F.lit(0).cast("long"), last.cast("long"), F.lit(step).cast("long")), F.array(last.cast("long"))))


def windows(pixels: DataFrame, meta: DataFrame, size: int = 128, overlap: int = 12) -> DataFrame:
    """Each pixel once per window that holds it: adds wx, wy (window start), ix, iy."""
    step = stride(size, overlap)
    m = meta.select("raster_id", _starts(F.col("width"), size, step).alias("sx"), _starts(F.col("height"), size, step).alias("sy"))
    holds = lambda starts, p: F.filter(starts, lambda s: (s <= F.col(p)) & (F.col(p) < s + size))
    w = pixels.join(m, "raster_id").withColumn("wx", F.explode(holds("sx", "px"))).withColumn("wy", F.explode(holds("sy", "py")))
    return w.withColumns({"ix": F.col("px") - F.col("wx"), "iy": F.col("py") - F.col("wy")}).drop("sx", "sy")


Model = Callable[[pd.DataFrame], pd.DataFrame]


def upsample(factor: int) -> Callable[[], Model]:
    """A loader of the shipped model: each pixel becomes factor x factor."""

    def load() -> Model:
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            parts = [pdf.assign(ix=pdf["ix"] * factor + dx, iy=pdf["iy"] * factor + dy) for dx in range(factor) for dy in range(factor)]
            return pd.concat(parts)

        return run

    return load


def apply_model(windowed: DataFrame, load: Callable[[], Model], schema: str) -> DataFrame:
    """Runs a model on batches of whole windows; it is loaded once per task."""
    keyed = windowed.repartition("raster_id", "wx", "wy").sortWithinPartitions("raster_id", "wx", "wy", "iy", "ix")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, held = load(), None
        for pdf in frames:
            pdf = pdf if held is None else pd.concat([held, pdf])
            if pdf.empty:
                continue
            last = pdf[["raster_id", "wx", "wy"]].iloc[-1]
            open_ = (pdf[["raster_id", "wx", "wy"]] == last).all(axis=1)
            held, done = pdf[open_], pdf[~open_]
            if len(done):
                yield model(done)
        if held is not None and len(held):
            yield model(held)

    return keyed.mapInPandas(run, schema)


def stitch(windowed: DataFrame, meta: DataFrame, size: int = 128, factor: int = 1, border: int = 2) -> DataFrame:
    """One value per output pixel: borders dropped but at scene edges, then the
    pixel farthest from its window's edge, then the lowest window.

    wx, wy are in source pixels; ix, iy, the result's px, py in output pixels.
    """
    m = meta.select("raster_id", (F.col("width") * factor).alias("w"), (F.col("height") * factor).alias("h"))
    x = windowed.join(m, "raster_id").withColumns({"px": F.col("wx") * factor + F.col("ix"), "py": F.col("wy") * factor + F.col("iy")})
    far = lambda i, total: F.least(F.col(i), F.least(F.lit(size * factor), F.col(total)) - 1 - F.col(i))
    edge = border * factor
    inner = lambda i, p, total: (far(i, total) >= edge) | ((F.col(i) < edge) & (F.col(p) < edge)) | ((F.col(p) >= F.col(total) - edge))
    x = x.filter(inner("ix", "px", "w") & inner("iy", "py", "h"))
    best = F.max_by("value", F.struct(F.least(far("ix", "w"), far("iy", "h")), -F.col("wy"), -F.col("wx")))
    return x.groupBy("raster_id", "px", "py").agg(best.alias("value"))
