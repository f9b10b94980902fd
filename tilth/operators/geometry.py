"""Geometry columns: array of polygons, of rings (the first is the shell), of points.

Functions take and return columns; long vertex lists are better exploded.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TYPE = "array<array<array<struct<x:double,y:double>>>>"


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def polygon(*corners: tuple[Column, Column]) -> Column:
    """A polygon of one closed ring through the corners."""
    points = [point(x, y) for x, y in corners]
    return F.array(F.array(F.array(*points, points[0])))


def box(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    return polygon((minx, miny), (maxx, miny), (maxx, maxy), (minx, maxy))


def empty() -> Column:
    return F.array().cast(TYPE)


def nonempty(geom: Column) -> Column:
    return geom.isNotNull() & (F.size(geom) > 0)


def points(geom: Column) -> Column:
    return F.flatten(F.flatten(geom))


def rings(geom: Column) -> Column:
    return F.flatten(geom)


def bounds(geom: Column) -> Column:
    p = points(geom)
    xs, ys = F.transform(p, lambda q: q["x"]), F.transform(p, lambda q: q["y"])
    return F.struct(F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"), F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy"))


def edges(ring: Column) -> Column:
    """(a, b) for each pair of neighbours of a closed ring."""
    n = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.zip_with(F.slice(ring, F.lit(1), n), F.slice(ring, F.lit(2), n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def ring_area(ring: Column) -> Column:
    """Signed shoelace area, taken from the first point for precision."""
    o = F.get(ring, F.lit(0))
    cross = lambda e: (e["a"]["x"] - o["x"]) * (e["b"]["y"] - o["y"]) - (e["b"]["x"] - o["x"]) * (e["a"]["y"] - o["y"])
    return F.aggregate(edges(ring), F.lit(0.0), lambda acc, e: acc + cross(e)) / 2


def area(geom: Column) -> Column:
    """Shells minus holes."""

    def of(poly: Column) -> Column:
        shell = F.abs(ring_area(F.get(poly, F.lit(0))))
        return shell - F.aggregate(F.slice(poly, F.lit(2), F.greatest(F.size(poly) - 1, F.lit(0))), F.lit(0.0), lambda acc, r: acc + F.abs(ring_area(r)))

    return F.aggregate(F.transform(geom, of), F.lit(0.0), lambda acc, a: acc + a)


def map_points(geom: Column, f) -> Column:
    return F.transform(geom, lambda poly: F.transform(poly, lambda ring: F.transform(ring, f)))


def orient(a: Column, b: Column, c: Column) -> Column:
    return (b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"])


def covers_point(geom: Column, p: Column) -> Column:
    """Crossing parity over all rings, or on an edge."""
    every = F.flatten(F.transform(rings(geom), edges))

    def crossed(e: Column) -> Column:
        a, b = e["a"], e["b"]
        up = (a["y"] > p["y"]) != (b["y"] > p["y"])
        return F.when(up & (p["x"] < (b["x"] - a["x"]) * F.coalesce(F.try_divide(p["y"] - a["y"], b["y"] - a["y"]), F.lit(0.0)) + a["x"]), 1).otherwise(0)

    inside = F.aggregate(every, F.lit(0), lambda acc, e: acc + crossed(e)) % 2 == 1
    return inside | F.exists(every, lambda e: on_segment(p, e["a"], e["b"]))


def on_segment(p: Column, a: Column, b: Column) -> Column:
    return (orient(a, b, p) == 0) & p["x"].between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"])) & p["y"].between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))


def segments_meet(e: Column, f: Column) -> Column:
    """Crossing or touching."""
    side = lambda s: F.signum(s)
    a, b, c, d = e["a"], e["b"], f["a"], f["b"]
    cross = (side(orient(a, b, c)) * side(orient(a, b, d)) < 0) & (side(orient(c, d, a)) * side(orient(c, d, b)) < 0)
    return cross | on_segment(c, a, b) | on_segment(d, a, b) | on_segment(a, c, d) | on_segment(b, c, d)


def intersects(a: Column, b: Column) -> Column:
    """Boundary included: a vertex of one in the other, or edges that meet."""
    first = lambda g: F.get(points(g), F.lit(0))
    ea, eb = F.flatten(F.transform(rings(a), edges)), F.flatten(F.transform(rings(b), edges))
    return covers_point(a, first(b)) | covers_point(b, first(a)) | F.exists(ea, lambda e: F.exists(eb, lambda f: segments_meet(e, f)))


def clip_convex(geom: Column, clip: Column) -> Column:
    """Intersection with a convex polygon (its shell counter-clockwise), ring by ring.

    Sutherland-Hodgman; the area is exact, concave input may keep bridges of no
    width.  Nothing left gives an empty geometry.
    """
    sides = edges(F.get(F.get(clip, F.lit(0)), F.lit(0)))

    def half(ring: Column, s: Column) -> Column:
        """Of an open ring, what is left of one side."""
        far = F.transform(ring, lambda p, i: F.struct(p.alias("p"), F.get(ring, (i + 1) % F.size(ring)).alias("q"), orient(s["a"], s["b"], p).alias("dp")))
        far = F.transform(far, lambda e: F.struct(e["p"].alias("p"), e["q"].alias("q"), e["dp"].alias("dp"), orient(s["a"], s["b"], e["q"]).alias("dq")))

        def step(e: Column) -> Column:
            t = F.coalesce(F.try_divide(e["dp"], e["dp"] - e["dq"]), F.lit(0.0))
            cut = point(e["p"]["x"] + t * (e["q"]["x"] - e["p"]["x"]), e["p"]["y"] + t * (e["q"]["y"] - e["p"]["y"]))
            none = F.array().cast("array<struct<x:double,y:double>>")
            return F.when((e["dp"] >= 0) & (e["dq"] >= 0), F.array(e["q"])).when(e["dp"] >= 0, F.array(cut)).when(e["dq"] >= 0, F.array(cut, e["q"])).otherwise(none)

        return F.flatten(F.transform(far, step))

    cut = lambda ring: F.aggregate(sides, F.slice(ring, F.lit(1), F.greatest(F.size(ring) - 1, F.lit(0))), half)
    polys = F.transform(geom, lambda poly: F.filter(F.transform(poly, cut), lambda r: F.size(r) >= 3))
    polys = F.transform(polys, lambda poly: F.transform(poly, lambda r: F.concat(r, F.slice(r, 1, 1))))
    return F.filter(polys, lambda p: F.size(p) > 0)


def repaired(geom: Column) -> Column:
    """Closes rings, drops repeated points and rings without area, orients them."""

    def fixed(ring: Column, hole: Column) -> Column:
        same = lambda a, b: (a["x"] == b["x"]) & (a["y"] == b["y"])
        kept = F.filter(F.transform(ring, lambda p, i: F.struct(p.alias("p"), F.coalesce(same(p, F.get(ring, i - 1)), F.lit(False)).alias("again"))), lambda q: ~q["again"])
        open_ = F.transform(kept, lambda q: q["p"])
        closed = F.when(same(F.get(open_, F.lit(0)), F.get(open_, F.size(open_) - 1)), open_).otherwise(F.concat(open_, F.slice(open_, 1, 1)))
        turned = F.when((ring_area(closed) < 0) != hole, F.reverse(closed)).otherwise(closed)
        return turned

    polys = F.transform(geom, lambda poly: F.transform(poly, lambda ring, i: fixed(ring, i > 0)))
    polys = F.transform(polys, lambda poly: F.filter(poly, lambda r: (F.size(r) >= 4) & (ring_area(r) != 0)))
    return F.filter(polys, lambda p: F.size(p) > 0)


def self_crossing(geom: Column) -> Column:
    """Some ring has two edges that cross; such geometry is flagged, not rebuilt."""

    def crosses(ring: Column) -> Column:
        es = F.transform(edges(ring), lambda e, i: F.struct(i.alias("i"), e.alias("e")))
        n = F.size(es)
        apart = lambda p, q: (q["i"] > p["i"] + 1) & ~((p["i"] == 0) & (q["i"] == n - 1))
        return F.exists(es, lambda p: F.exists(es, lambda q: apart(p, q) & segments_meet(p["e"], q["e"])))

    return F.exists(rings(geom), crosses)


def number_text(x: Column) -> Column:
    """A number as JSON text, with all its digits: plain from 0.0001 up to 10^16, beyond that as 1.5e-07 or 1e+16."""
    text = x.cast("string")
    mantissa, e = F.regexp_replace(F.split_part(text, F.lit("E"), F.lit(1)), r"\.0$", ""), F.split_part(text, F.lit("E"), F.lit(2)).cast("int")
    sign, digits = F.regexp_extract(mantissa, "^-?", 0), F.regexp_replace(mantissa, r"[-.]", "")
    whole = F.concat(sign, F.rpad(F.substring(digits, F.lit(1), e + 1), e + 1, F.lit("0")), F.lit("."), F.when(F.length(digits) > e + 1, F.substring(digits, e + 2, F.length(digits))).otherwise("0"))
    small = F.concat(sign, F.lit("0.000"), digits)
    other = F.when(e == -4, small).when(e.between(7, 15), whole).otherwise(F.concat(mantissa, F.format_string("e%+03d", e)))
    plain = (x == 0) | F.abs(x).between(1e-3, 9999999.0)
    special = F.isnan(x) | (F.abs(x) == float("inf"))
    return F.when(x.isNull(), "null").when(special, F.concat(F.lit('"'), text, F.lit('"'))).when(plain | ~F.contains(text, F.lit("E")), text).otherwise(other)


def points_json(geom: Column, f) -> Column:
    """The nested arrays of a geometry as JSON text, each point by ``f``."""
    listed = lambda items, g: F.concat(F.lit("["), F.array_join(F.transform(items, g), ","), F.lit("]"))
    return listed(geom, lambda poly: listed(poly, lambda ring: listed(ring, f)))


def geojson(geom: Column) -> Column:
    """GeoJSON text; a single polygon is a Polygon, more are a MultiPolygon."""
    coordinates = points_json(geom, lambda p: F.concat(F.lit("["), number_text(p["x"]), F.lit(","), number_text(p["y"]), F.lit("]")))
    text = lambda kind, c: F.concat(F.lit(f'{{"type":"{kind}","coordinates":'), c, F.lit("}"))
    one = text("Polygon", F.substring(coordinates, F.lit(2), F.length(coordinates) - 2))
    return F.when(~nonempty(geom), F.lit(None)).when(F.size(geom) == 1, one).otherwise(text("MultiPolygon", coordinates))


def boundary(geom: Column) -> Column:
    """All edges as (ring, seq, x1, y1, x2, y2)."""
    parts = F.transform(rings(geom), lambda ring, i: F.transform(edges(ring), lambda e, k: F.struct(i.alias("ring"), k.alias("seq"), e["a"]["x"].alias("x1"), e["a"]["y"].alias("y1"), e["b"]["x"].alias("x2"), e["b"]["y"].alias("y2"))))
    return F.flatten(parts)
