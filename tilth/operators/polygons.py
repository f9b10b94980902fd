"""Parcel polygons: the rings around labelled pixels, assembled from directed edges.

Edges run with their parcel on the left (x to the right, y along the rows), so shells have a
positive area and holes a negative one.  They are made from runs of pixels as longest straight pieces, not pixel by
pixel.  Each edge is linked to the one that starts where it ends; where four edges meet, at pixels that touch
by a corner, it turns right, so that every ring is simple and a hole may touch its shell at points.
Links are a permutation of the edges, and its cycles are the rings: pointer jumping finds the first corner of every
ring and each corner's distance from it in as many rounds as the longest ring's length has bits; a ring leaves the
rounds when it is known, so only long rings are in the later ones.

A parcel is 4-connected, so it has one shell, and all its other rings are its holes.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilth.operators import geometry as G
from tilth.scratch import discard, materialize, scratch_path

#: Rows and columns of a raster are below this.
CELL = 1 << 24
EAST, SOUTH, WEST, NORTH = range(4)


def pixel_runs(parcels: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, parcel, py, start, stop): pixels of a parcel that are neighbours in a row; ``stop`` is exclusive."""
    row = W.partitionBy(*by, "parcel", "py").orderBy("px")
    islands = parcels.select(*by, "parcel", "py", "px", (F.col("px") - F.row_number().over(row)).alias("island"))
    return islands.groupBy(*by, "parcel", "py", "island").agg(F.min("px").alias("start"), (F.max("px") + 1).alias("stop")).drop("island")


def directed_edges(runs: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, parcel, sx, sy, ex, ey, heading) for every longest straight piece of a parcel's outline."""
    # on a line between two rows, an edge lies where only one of the rows has the parcel
    change = lambda x, line, above, below: F.struct(F.col(x).alias("x"), line.alias("y"), F.lit(above).alias("above"), F.lit(below).alias("below"))
    top, bottom = F.col("py"), F.col("py") + 1
    changes = F.array(change("start", top, 0, 1), change("stop", top, 0, -1), change("start", bottom, 1, 0), change("stop", bottom, -1, 0))
    at = runs.select(*by, "parcel", F.explode(changes).alias("c")).groupBy(*by, "parcel", F.col("c.y").alias("y"), F.col("c.x").alias("x")).agg(F.sum("c.above").alias("above"), F.sum("c.below").alias("below"))
    line = W.partitionBy(*by, "parcel", "y").orderBy("x")
    level = at.select(*by, "parcel", "y", "x", F.lead("x").over(line).alias("next"), F.sum("above").over(line).alias("above"), F.sum("below").over(line).alias("below"))
    east = F.col("below") > F.col("above")
    flat = level.filter("above <> below").select(*by, "parcel", F.when(east, F.col("x")).otherwise(F.col("next")).alias("sx"), F.col("y").alias("sy"), F.when(east, F.col("next")).otherwise(F.col("x")).alias("ex"), F.col("y").alias("ey"), F.when(east, EAST).otherwise(WEST).alias("heading"))
    # left ends of runs below one another are one edge, and so are right ends
    ends = runs.select(*by, "parcel", "py", F.explode(F.array(F.struct(F.col("start").alias("x"), F.lit(NORTH).alias("heading")), F.struct(F.col("stop").alias("x"), F.lit(SOUTH).alias("heading")))).alias("e"))
    ends = ends.select(*by, "parcel", "py", "e.x", "e.heading")
    column = W.partitionBy(*by, "parcel", "x", "heading").orderBy("py")
    tall = ends.withColumn("island", F.col("py") - F.row_number().over(column)).groupBy(*by, "parcel", "x", "heading", "island").agg(F.min("py").alias("y0"), (F.max("py") + 1).alias("y1"))
    south = F.col("heading") == SOUTH
    tall = tall.select(*by, "parcel", F.col("x").alias("sx"), F.when(south, F.col("y0")).otherwise(F.col("y1")).alias("sy"), F.col("x").alias("ex"), F.when(south, F.col("y1")).otherwise(F.col("y0")).alias("ey"), "heading")
    return flat.unionByName(tall)


def linked_edges(edges: DataFrame, by: Sequence[str]) -> DataFrame:
    """Adds ``node`` and ``next``, the edge that follows in the ring."""
    edges = materialize(edges.withColumn("node", F.monotonically_increasing_id()), "polygon-edges")
    own = [F.max(F.when(F.col("heading") == h, F.col("node"))).alias(f"to{h}") for h in range(4)]
    starts = edges.groupBy(*by, "parcel", F.col("sx").alias("ex"), F.col("sy").alias("ey")).agg(*own)
    towards = lambda turn: F.element_at(F.array(*[F.col(f"to{h}") for h in range(4)]), (F.col("heading") + turn) % 4 + 1)
    right, left = 3, 1  # of the axes above
    return edges.join(starts, [*by, "parcel", "ex", "ey"]).withColumn("next", F.coalesce(towards(right), towards(left))).drop(*[f"to{h}" for h in range(4)])


def ring_places(links: DataFrame, key: str = "key") -> DataFrame:
    """(node, first, steps): the smallest key on each node's cycle and the links from the node to it.

    ``links`` is a permutation (node, next) whose keys differ within a cycle.
    """
    spark, span, known = links.sparkSession, 1, []
    state = materialize(links.select("node", "next", F.col(key).alias("first"), F.lit(0).cast("long").alias("steps")), "ring-places")
    last = state.scratch
    while True:
        # a node has seen ``span`` links, and so has the one it ends at; if both found the same first corner, their way leads
        # round the ring, and if that one has left, its ring is no longer than what the node has seen itself
        far = state.select(F.col("node").alias("next"), F.col("next").alias("next2"), F.col("first").alias("first2"), F.col("steps").alias("steps2"))
        nearer = F.coalesce(F.col("first2") < F.col("first"), F.lit(False))
        done = F.coalesce(F.col("first2") == F.col("first"), F.lit(True)).cast("int")
        moved = state.join(far, "next", "left").select("node", F.col("next2").alias("next"), F.least("first", "first2").alias("first"), F.when(nearer, F.col("steps2") + span).otherwise(F.col("steps")).alias("steps"), done.alias("done"))
        path = scratch_path(spark, "ring-places")
        moved.write.partitionBy("done").parquet(path)
        rows = spark.read.schema(moved.schema).parquet(path)
        discard(spark, last)
        known.append(rows.filter("done = 1").select("node", "first", "steps"))
        state, last, span = rows.filter("done = 0").drop("done"), f"{path}/done=0", span * 2
        if not state.limit(1).count():
            return reduce(DataFrame.unionByName, known)


def _placed(runs: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, parcel, ring, steps, x, y, cross): corners with the links from them to their ring's first."""
    edges = linked_edges(directed_edges(runs, by), by)
    edges = materialize(edges.withColumn("key", (F.col("sy") * CELL + F.col("sx")).cast("long")), "polygon-links")
    cross = F.col("sx") * F.col("ey") - F.col("ex") * F.col("sy")
    return edges.join(ring_places(edges), "node").select(*by, "parcel", F.col("first").alias("ring"), "steps", F.col("sx").alias("x"), F.col("sy").alias("y"), cross.alias("cross"))


def ring_corners(parcels: DataFrame, by: Sequence[str] = ("raster_id",)) -> DataFrame:
    """(by, parcel, ring, seq, x, y, cross): the corners of every ring in order, in pixel units.

    ``ring`` is y * 2^24 + x of the ring's first corner; ``cross`` sums to twice the ring's signed area.
    """
    by = list(by)
    corners = _placed(pixel_runs(parcels, by), by)
    sizes = corners.groupBy(*by, "parcel", "ring").agg(F.count(F.lit(1)).alias("corners"))
    return corners.join(sizes, [*by, "parcel", "ring"]).select(*by, "parcel", "ring", ((F.col("corners") - F.col("steps")) % F.col("corners")).alias("seq"), "x", "y", "cross")


def polygons(parcels: DataFrame, by: Sequence[str] = ("raster_id",)) -> DataFrame:
    """(by, parcel, geom, rings, corners, area): one polygon per parcel, its shell first, in pixel units.

    A polygon is one row, as everywhere in this library; ``ring_corners`` has the same in rows.
    """
    return run_polygons(pixel_runs(parcels, list(by)), by)


def run_polygons(runs: DataFrame, by: Sequence[str] = ("raster_id",)) -> DataFrame:
    """``polygons`` of parcels that are runs of pixels, as ``pixel_runs`` makes them."""
    by = list(by)
    # the first corner is no link from itself, and the last is one, so corners in order have falling numbers after it
    point = F.struct(F.when(F.col("steps") > 0, -F.col("steps")).otherwise(F.lit(-(1 << 62))).alias("seq"), F.struct(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).alias("p"))
    rings = _placed(runs, by).repartition(*by, "parcel").groupBy(*by, "parcel", "ring").agg(F.array_sort(F.collect_list(point)).alias("points"), F.sum("cross").alias("twice"))
    open_ = F.transform("points", lambda q: q["p"])
    ring = F.struct((F.col("twice") < 0).alias("hole"), F.col("ring").alias("ring"), F.concat(open_, F.slice(open_, 1, 1)).alias("line"))
    out = rings.groupBy(*by, "parcel").agg(F.array_sort(F.collect_list(ring)).alias("all"), F.sum("twice").alias("twice"), F.sum(F.size("points")).alias("corners"))
    geom = F.array(F.transform("all", lambda r: r["line"]))
    return out.select(*by, "parcel", geom.alias("geom"), F.size("all").cast("long").alias("rings"), "corners", (F.col("twice") / 2).cast("long").alias("area"))


def on_map(table: DataFrame, meta: DataFrame) -> DataFrame:
    """``geom`` from pixel units to the raster's CRS by its origin and pixel size; shells stay counter-clockwise."""
    m = meta.select("raster_id", "ox", "oy", "rx", "ry")
    place = lambda p: G.point(F.col("ox") + p["x"] * F.col("rx"), F.col("oy") - p["y"] * F.col("ry"))
    turned = F.transform(G.map_points(F.col("geom"), place), lambda poly: F.transform(poly, F.reverse))
    return table.join(m, "raster_id").withColumn("geom", turned).drop("ox", "oy", "rx", "ry")


def dissolve(layer: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, x1, y1, x2, y2): the outline of edge-matched polygons: edges that occur once."""
    edge = layer.select(*by, F.explode(G.boundary(F.col("geom"))).alias("e")).select(*by, "e.*")
    ahead = F.struct("x1", "y1") <= F.struct("x2", "y2")
    same = [F.when(ahead, F.col(a)).otherwise(F.col(b)).alias(n) for n, a, b in (("x1", "x1", "x2"), ("y1", "y1", "y2"), ("x2", "x2", "x1"), ("y2", "y2", "y1"))]
    return edge.select(*by, *same).groupBy(*by, "x1", "y1", "x2", "y2").agg(F.count(F.lit(1)).alias("_times")).filter("_times = 1").drop("_times")
