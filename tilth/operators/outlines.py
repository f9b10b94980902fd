"""Exact predicates on polygons of many vertices, with their edges as rows.

The functions of ``geometry`` look at all edges of a row at once, which is right for short rings.  Here edges
are exploded and dealt into cells by ``bbox_join``, so no row or task holds all edges of an outline
and only edges that are near are compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilth.operators import geometry as G
from tilth.operators.tiles import BOX, bbox_join, with_box
from tilth.scratch import materialize


def edge_rows(layer: DataFrame, keys: Sequence[str], geom: str = "geom") -> DataFrame:
    """(keys, poly, ring, seq, edges, a, b, box): one row per edge; ``edges`` are those of its ring."""
    e = layer.select(*keys, F.posexplode(geom).alias("poly", "rings")).select(*keys, "poly", F.posexplode("rings").alias("ring", "points"))
    # sizes before the explosion, so that no row of it drags the ring along
    e = e.select(*keys, "poly", "ring", (F.size("points") - 1).alias("edges"), G.edges(F.col("points")).alias("all"))
    e = e.select(*keys, "poly", "ring", "edges", F.posexplode("all").alias("seq", "e")).select(*keys, "poly", "ring", "seq", "edges", "e.a", "e.b")
    low, high = lambda c: F.least(f"a.{c}", f"b.{c}"), lambda c: F.greatest(f"a.{c}", f"b.{c}")
    return e.select("*", low("x").alias("minx"), low("y").alias("miny"), high("x").alias("maxx"), high("y").alias("maxy"))


def relations(tiles: DataFrame, outlines: DataFrame, tile_key: str = "tile_id", outline_key: str = "aoi_id", on: Sequence[str] = ()) -> DataFrame:
    """(tile key, outline key, edge): pairs that intersect, and whether an edge of the outline meets the tile.

    Keys are unique on their side; with ``on``, only rows of equal values there are paired.  A tile
    that no edge meets is wholly inside or wholly outside, which its first corner tells: inside if an odd number of edges
    cross the ray from it towards greater x.  Corners of equal y share the edges that cross their line,
    and a running count along the line gives every corner its parity.
    """
    edges = materialize(edge_rows(outlines, [outline_key, *on]), "outline-edges")
    boxed = with_box(tiles).select(tile_key, *on, "geom", *BOX)
    near = bbox_join(boxed, edges.select(outline_key, *on, "a", "b", *BOX), on).select(F.col(f"left.{tile_key}").alias(tile_key), F.col(f"right.{outline_key}").alias(outline_key), "left.geom", "right.a", "right.b")
    edge = F.struct("a", "b")
    of_tile = F.flatten(F.transform(G.rings(F.col("geom")), G.edges))
    met = near.filter(G.covers_point(F.col("geom"), F.col("a")) | F.exists(of_tile, lambda t: G.segments_meet(t, edge)))
    met = materialize(met.select(tile_key, outline_key).distinct(), "outline-met")
    both = bbox_join(boxed, with_box(outlines).select(outline_key, *on, *BOX), on).select(F.col(f"left.{tile_key}").alias(tile_key), F.col(f"right.{outline_key}").alias(outline_key), F.get(G.points(F.col("left.geom")), F.lit(0)).alias("p"))
    asked = materialize(both.join(met, [tile_key, outline_key], "left_anti").select(tile_key, outline_key, "p.x", "p.y"), "outline-asked")
    crossings = line_crossings(asked.select(outline_key, "y").distinct(), edges, outline_key)
    crossings = crossings.select(outline_key, "y", "x", F.lit(1).alias("n"), F.lit(None).cast(asked.schema[tile_key].dataType).alias(tile_key))
    events = asked.select(outline_key, "y", "x", F.lit(0).alias("n"), tile_key).unionByName(crossings)
    beyond = W.partitionBy(outline_key, "y").orderBy(F.col("x").desc(), "n")  # a corner comes before a crossing at its own place
    inside = events.withColumn("n", F.sum("n").over(beyond)).filter(F.col(tile_key).isNotNull() & (F.col("n") % 2 == 1))
    return met.withColumn("edge", F.lit(True)).unionByName(inside.select(tile_key, outline_key, F.lit(False).alias("edge")))


def line_crossings(lines: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """(key, y, x): where the edges of each key cross its lines of equal y; an edge holds its lower end and not its upper one."""
    flat = lambda df, lo, hi: df.select("*", F.lit(0.0).alias("minx"), F.col(lo).alias("miny"), F.lit(0.0).alias("maxx"), F.col(hi).alias("maxy"))
    spans = flat(edges.select(key, "a", "b", F.col("miny").alias("low"), F.col("maxy").alias("high")), "low", "high")
    crossed = bbox_join(flat(lines, "y", "y"), spans, on=[key]).select(F.col(f"left.{key}").alias(key), "left.y", "right.a", "right.b").filter((F.col("a.y") > F.col("y")) != (F.col("b.y") > F.col("y")))
    x = (F.col("b.x") - F.col("a.x")) * ((F.col("y") - F.col("a.y")) / (F.col("b.y") - F.col("a.y"))) + F.col("a.x")
    return crossed.select(key, "y", x.alias("x"))


def tiles_meeting(tiles: DataFrame, outlines: DataFrame, tile_key: str = "tile_id", outline_key: str = "aoi_id") -> DataFrame:
    """Distinct (tile key, outline key) that intersect, touching included; see ``relations``."""
    return relations(tiles, outlines, tile_key, outline_key).drop("edge")


#: Chains of a level that are one chain of the next, and more than rounding can move a point by, beside its coordinates.
FAN, SLACK = 8, 1e-9
#: Sides of a turned box: its axis (ux, uy) and what it spans along and across it.
_TURNED = ("ux", "uy", "u0", "u1", "v0", "v1")


def _turned(points: Column) -> Column:
    """A turned box of some points: its axis is that along which they spread most."""
    n, total = F.size(points), lambda f: F.aggregate(points, F.lit(0.0), lambda acc, p: acc + f(p))
    mx, my = total(lambda p: p["x"]) / n, total(lambda p: p["y"]) / n
    m = F.struct(points.alias("ps"), mx.alias("mx"), my.alias("my"))

    def axis(m: Column) -> Column:
        total = lambda f: F.aggregate(m["ps"], F.lit(0.0), lambda acc, p: acc + f(p["x"] - m["mx"], p["y"] - m["my"]))
        turn = F.atan2(2 * total(lambda x, y: x * y), total(lambda x, y: x * x - y * y)) / 2
        return F.struct(m["ps"].alias("ps"), F.cos(turn).alias("ux"), F.sin(turn).alias("uy"))

    def spans(a: Column) -> Column:
        along = F.transform(a["ps"], lambda p: p["x"] * a["ux"] + p["y"] * a["uy"])
        across = F.transform(a["ps"], lambda p: p["y"] * a["ux"] - p["x"] * a["uy"])
        far = SLACK * F.array_max(F.transform(a["ps"], lambda p: F.abs(p["x"]) + F.abs(p["y"])))
        return F.struct(a["ux"].alias("ux"), a["uy"].alias("uy"), (F.array_min(along) - far).alias("u0"), (F.array_max(along) + far).alias("u1"), (F.array_min(across) - far).alias("v0"), (F.array_max(across) + far).alias("v1"))

    return F.get(F.transform(F.transform(F.array(m), axis), spans), F.lit(0))


def _corners(box: Column) -> Column:
    at = lambda u, v: F.struct((box[u] * box["ux"] - box[v] * box["uy"]).alias("x"), (box[u] * box["uy"] + box[v] * box["ux"]).alias("y"))
    return F.array(at("u0", "v0"), at("u1", "v0"), at("u1", "v1"), at("u0", "v1"))


def _boxes_meet(a: Column, b: Column) -> Column:
    """Turned boxes that no side of either parts."""

    def along(a: Column, b: Column) -> Column:
        # b's middle and half sizes on a's axes
        u, v, hu, hv = (b["u0"] + b["u1"]) / 2, (b["v0"] + b["v1"]) / 2, (b["u1"] - b["u0"]) / 2, (b["v1"] - b["v0"]) / 2
        x, y = u * b["ux"] - v * b["uy"], u * b["uy"] + v * b["ux"]
        c, s = F.abs(a["ux"] * b["ux"] + a["uy"] * b["uy"]), F.abs(a["ux"] * b["uy"] - a["uy"] * b["ux"])
        mu, mv, ru, rv = x * a["ux"] + y * a["uy"], y * a["ux"] - x * a["uy"], hu * c + hv * s, hu * s + hv * c
        return (mu - ru <= a["u1"]) & (mu + ru >= a["u0"]) & (mv - rv <= a["v1"]) & (mv + rv >= a["v0"])

    return along(a, b) & along(b, a)


def crossing_rings(layer: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, poly, ring, crossings): rings with two edges, not neighbours, that cross or touch, and how many such pairs.

    Rings that cross nowhere have no row.  Edges that follow one another are chains of ``FAN``, those again, and so on up to the ring.
    A chain has a box turned to the line along which it lies, so long edges side by side have boxes apart, whatever their
    direction.  Pairs of chains whose boxes meet give way to the pairs of their parts, level by level, down to edges.
    """
    own = [*keys, "poly", "ring"]
    edges = edge_rows(layer, keys).select(*own, "edges", F.col("seq").cast("long").alias("seq"), "a", "b")
    edges = materialize(edges.withColumn("box", _turned(F.array("a", "b"))).repartition(*own, F.floor(F.col("seq") / 4096)), "ring-edges")
    most = edges.agg(F.max("edges")).first()[0] or 1
    levels = [edges.select(*own, "seq", "box")]
    while most > 1:
        most = -(-most // FAN)
        up = levels[-1].groupBy(*own, F.floor(F.col("seq") / FAN).alias("seq")).agg(F.flatten(F.collect_list(_corners(F.col("box")))).alias("ps"))
        levels.append(materialize(up.select(*own, "seq", _turned(F.col("ps")).alias("box")), "ring-chains"))
    pairs = levels.pop().select(*own, F.col("seq").alias("i"), F.col("seq").alias("j"))
    while levels:
        chains = levels.pop()
        parts = lambda c: F.explode(F.transform(F.sequence(F.lit(0), F.lit(FAN - 1)), lambda k: F.col(c) * FAN + k)).alias(c)  # noqa: B023, E731
        side = lambda c: chains.select(*own, F.col("seq").alias(c), F.struct("seq", "box").alias(f"of_{c}"))  # noqa: B023, E731
        met = pairs.select(*own, parts("i"), "j").select(*own, "i", parts("j")).filter("i <= j")
        met = met.join(side("i").hint("merge"), [*own, "i"]).join(side("j").hint("merge"), [*own, "j"])
        pairs = materialize(met.filter(_boxes_meet(F.col("of_i.box"), F.col("of_j.box"))).select(*own, "i", "j"), "ring-pairs")
    edge = lambda c: edges.select(*own, F.col("seq").alias(c), F.struct("a", "b").alias(f"of_{c}"), F.col("edges").alias(f"n_{c}"))
    i, j, n = F.col("i"), F.col("j"), F.col("n_i")
    apart = (j > i + 1) & ~((i == 0) & (j == n - 1))
    near = pairs.join(edge("i").hint("merge"), [*own, "i"]).filter(apart).join(edge("j").hint("merge"), [*own, "j"])
    return near.filter(G.segments_meet(F.col("of_i"), F.col("of_j"))).groupBy(*own).agg(F.count(F.lit(1)).alias("crossings"))
