"""Tile discovery: bounds, bucketed bbox join, exact join, dedupe, include, limit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilth.operators import geometry as G
from tilth.scratch import materialize

BOX = ("minx", "miny", "maxx", "maxy")


def total_bounds(table: DataFrame, geom: str = "geom") -> DataFrame:
    """One row: the bounds of all non-empty geometries."""
    b = table.filter(G.nonempty(F.col(geom))).select(G.bounds(F.col(geom)).alias("b"))
    return b.agg(F.min("b.minx").alias("minx"), F.min("b.miny").alias("miny"), F.max("b.maxx").alias("maxx"), F.max("b.maxy").alias("maxy"))


def bbox_scan(grid: DataFrame, minx: float, miny: float, maxx: float, maxy: float) -> DataFrame:
    """Rows whose box meets the given one; closed, and pushed to the scan."""
    return grid.filter((F.col("maxx") >= minx) & (F.col("minx") <= maxx) & (F.col("maxy") >= miny) & (F.col("miny") <= maxy))


def _level(box: Column) -> Column:
    """The exponent of the cell of a box: the least power of four that is no smaller than the box.

    A box covers at most four cells of its level.  A point, or a box that is tiny beside its coordinates, gets the
    level at which cells still have exact numbers.
    """
    far = F.greatest(*[F.abs(box[c]) for c in BOX]) * 2.0**-40
    size = F.greatest(box["maxx"] - box["minx"], box["maxy"] - box["miny"], far, F.lit(2.0**-400))
    return (F.ceil(F.log2(size) / 2) * 2).cast("int")


def bbox_join(left: DataFrame, right: DataFrame, on: Sequence[str] = ()) -> DataFrame:
    """Pairs of rows whose boxes meet, as structs ``left`` and ``right``; with ``on``, of equal values there.

    Cells come in levels by powers of four.  A pair is joined at the level of its larger box: a row
    is dealt to the cells of its own level and to those of the larger levels that the other side has, at most four each,
    so the cells of a box are bounded whatever its size and the CRS.  A pair is reported in the
    cell of the lower left corner of its overlap only, so it needs no distinct (Patel & DeWitt 1996).
    Rows outside the other side's bounds are not dealt.  Both sides are shuffled: what the cells make of a small table is not small, and
    its size before does not tell whether it can be broadcast.
    """

    def sized(df: DataFrame, side: str) -> DataFrame:
        x = df.filter(" and ".join(f"{c} is not null and not isnan({c})" for c in BOX)).select(F.struct(*df.columns).alias(side), F.struct(*BOX).alias("box"), *[F.col(c).alias(f"on_{c}") for c in on])
        return x.withColumn("own", _level(F.col("box")))

    def dealt(x: DataFrame, other: DataFrame, side: str) -> DataFrame:
        b = F.col("box")
        far = other.agg(F.min("box.minx").alias("minx"), F.min("box.miny").alias("miny"), F.max("box.maxx").alias("maxx"), F.max("box.maxy").alias("maxy"), F.collect_set("own").alias("levels"))  # a few dozen levels
        far = far.select(F.struct("*").alias("far")).scalar()
        x = x.filter((b["minx"] <= far["maxx"]) & (b["maxx"] >= far["minx"]) & (b["miny"] <= far["maxy"]) & (b["maxy"] >= far["miny"]))
        x = x.withColumn("level", F.explode(F.array_union(F.array("own"), far["levels"]))).filter("level >= own")
        size = F.pow(F.lit(2.0), F.col("level"))
        for axis, lo, hi in (("x", "minx", "maxx"), ("y", "miny", "maxy")):
            x = x.withColumn(f"cell_{axis}", F.explode(F.sequence(F.floor(F.col(f"box.{lo}") / size), F.floor(F.col(f"box.{hi}") / size))))
        return x.withColumnsRenamed({"box": f"{side}_box", "own": f"{side}_own"})

    a, b = sized(left, "left"), sized(right, "right")
    pairs = dealt(a, b, "left").join(dealt(b, a, "right").hint("merge"), [*[f"on_{c}" for c in on], "level", "cell_x", "cell_y"])
    a, b, size = F.col("left_box"), F.col("right_box"), F.pow(F.lit(2.0), F.col("level"))
    meet = (a["minx"] <= b["maxx"]) & (a["maxx"] >= b["minx"]) & (a["miny"] <= b["maxy"]) & (a["maxy"] >= b["miny"])
    once = (F.greatest("left_own", "right_own") == F.col("level")) & (F.floor(F.greatest(a["minx"], b["minx"]) / size) == F.col("cell_x")) & (F.floor(F.greatest(a["miny"], b["miny"]) / size) == F.col("cell_y"))
    return pairs.filter(meet & once).select("left", "right")


def with_box(table: DataFrame, geom: str = "geom") -> DataFrame:
    b = G.bounds(F.col(geom))
    return table.filter(G.nonempty(F.col(geom))).withColumns({c: b[c] for c in BOX})


def spatial_join(tiles: DataFrame, aoi: DataFrame, *, tile_key: str | None = None, aoi_key: str | None = None) -> DataFrame:
    """Pairs (left tile, right AOI part) that intersect, touching included.

    With keys, which are unique on their side, only keys and boxes are dealt into cells,
    and the other columns are joined to the pairs whose boxes meet.
    """

    def slim(table: DataFrame, key: str | None) -> DataFrame:
        return with_box(table) if key is None else with_box(table).select(key, *BOX)

    def whole(pairs: DataFrame, side: str, table: DataFrame, key: str | None) -> DataFrame:
        if key is None:
            return pairs
        rows = table.select(F.col(key).alias("key"), F.struct(*table.columns).alias("whole"))
        other = "right" if side == "left" else "left"
        return pairs.withColumn("key", F.col(f"{side}.{key}")).join(rows, "key").select(F.col("whole").alias(side), other)

    pairs = bbox_join(slim(tiles, tile_key), slim(aoi, aoi_key))
    pairs = whole(whole(pairs, "left", tiles, tile_key), "right", aoi, aoi_key)
    return pairs.filter(G.intersects(F.col("left.geom"), F.col("right.geom"))).select("left", "right")


def intersecting_tiles(tiles: DataFrame, aoi: DataFrame) -> DataFrame:
    """Tiles that intersect any part of the AOI, which is its union.

    Boxes are computed once, and only they are dealt into cells.  A tile needs one part that meets it: the part with the
    largest common box is tried first, and all others only for tiles that it does not meet.
    """
    left, right = (materialize(with_box(t).withColumn("row", F.monotonically_increasing_id()), "tile-boxes") for t in (tiles.select("tile_id", "geom"), aoi.select("geom")))
    pairs = bbox_join(left.select("row", *BOX), right.select("row", *BOX))
    a, b = F.col("left"), F.col("right")
    common = (F.least(a["maxx"], b["maxx"]) - F.greatest(a["minx"], b["minx"])) * (F.least(a["maxy"], b["maxy"]) - F.greatest(a["miny"], b["miny"]))
    pairs = materialize(pairs.select(a["row"].alias("tile"), b["row"].alias("part"), common.alias("common")), "tile-pairs")

    def met(pairs: DataFrame) -> DataFrame:
        p = pairs.join(left.select(F.col("row").alias("tile"), "tile_id", F.col("geom").alias("a")), "tile").join(right.select(F.col("row").alias("part"), F.col("geom").alias("b")), "part")
        return p.filter(G.intersects(F.col("a"), F.col("b"))).select("tile", "tile_id")

    likely = materialize(met(pairs.groupBy("tile").agg(F.max_by("part", "common").alias("part"))), "tile-hits")
    others = met(pairs.join(likely, "tile", "left_anti").select("tile", "part"))
    return tiles.join(likely.unionByName(others).select("tile_id").distinct(), "tile_id", "left_semi")


def dedupe(tiles: DataFrame, order: Column) -> DataFrame:
    """One row per tile id, the first by ``order``."""
    w = W.partitionBy("tile_id").orderBy(order)
    return tiles.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def include(tiles: DataFrame, names: Sequence[str]) -> DataFrame:
    """The listed ids, whatever their case; an empty list keeps all."""
    return tiles.filter(F.upper("tile_id").isin([n.upper() for n in names])) if names else tiles


def first_tiles(tiles: DataFrame, n: int | None) -> DataFrame:
    """The first n ids in order; None keeps all."""
    if n is not None and n <= 0:
        raise ValueError("the number of tiles must be positive")
    out = tiles.orderBy("tile_id")
    return out if n is None else out.limit(n)


def discover(tiles: DataFrame, aoi: DataFrame, names: Sequence[str] = (), n: int | None = None) -> DataFrame:
    """All steps in order: join, dedupe, include, limit."""
    found = dedupe(intersecting_tiles(tiles, aoi), G.geojson(F.col("geom")))
    return first_tiles(include(found, names), n)


def aoi_clip(tiles: DataFrame, aoi: DataFrame, sliver: float = 1e-12) -> DataFrame:
    """(tile_id, aoi_id, geom): each tile's share of each AOI part that it meets; ids are unique.

    A tile that only touches an AOI part, so that the share's area is rounding error up to
    ``sliver``, gets all of that part.
    """
    return clip_pairs(spatial_join(tiles, aoi, tile_key="tile_id", aoi_key="aoi_id"), sliver)


def clip_pairs(pairs: DataFrame, sliver: float = 1e-12) -> DataFrame:
    """``aoi_clip`` of pairs (left tile, right AOI part) that are known to meet."""
    whole = F.col("right.geom")
    share = F.explode(F.transform(F.array(G.clip_convex(whole, F.col("left.geom"))), lambda g: F.when((F.size(g) > 0) & (G.area(g) > sliver), g).otherwise(whole)))
    return pairs.select("left.tile_id", "right.aoi_id", share.alias("geom"))
