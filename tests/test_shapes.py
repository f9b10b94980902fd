"""Parcel polygons, outlines of many vertices, coverage, box levels and CRS by row against brute force."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilth.operators import coverage, crs, outlines, parcels, polygons, tiles
from tilth.operators import geometry as G

c = F.col
GEOM = G.TYPE
BOXES = "id int, minx double, miny double, maxx double, maxy double"


def ring(points) -> list:
    p = [(float(x), float(y)) for x, y in points]
    return p if p[0] == p[-1] else [*p, p[0]]


def star(x, y, n, rng, low=0.5, high=1.5):
    at = np.sort(rng.uniform(0, 2 * math.pi, n))
    r = rng.uniform(low, high, n)
    return ring(zip(x + r * np.cos(at), y + r * np.sin(at)))


def inside(rings, x, y) -> bool:
    odd = False
    for line in rings:
        for (ax, ay), (bx, by) in zip(line, line[1:]):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                odd = not odd
    return odd


# -- parcel polygons


def rasters(spark, grids: dict[str, np.ndarray]):
    rows = [(name, x, y, int(g[y, x])) for name, g in grids.items() for y in range(g.shape[0]) for x in range(g.shape[1]) if g[y, x]]
    return spark.createDataFrame(rows, "raster_id string, px long, py long, label int")


GRIDS = {
    "hole": np.array([[1, 1, 1], [1, 0, 1], [1, 1, 1]]),
    "touching holes": np.array([[1, 1, 1, 1], [1, 0, 1, 1], [1, 1, 0, 1], [1, 1, 1, 1]]),
    "hole at the corner": np.array([[0, 1, 1], [1, 0, 1], [1, 1, 1]]),
    "nested": np.array([[1, 1, 1, 1, 1], [1, 2, 2, 2, 1], [1, 2, 3, 2, 1], [1, 2, 2, 2, 1], [1, 1, 1, 1, 1]]),
    "one": np.array([[1]]),
    "random": np.random.default_rng(5).integers(0, 3, (14, 17)),
    "dense": (np.random.default_rng(6).random((16, 16)) < 0.75).astype(int),
}


@pytest.fixture(scope="module")
def segmented(spark):
    return parcels.segments(rasters(spark, GRIDS)).persist()


def test_polygons_fill_their_pixels_with_simple_rings(segmented):
    pixels: dict[tuple, set] = {}
    for r in segmented.collect():
        pixels.setdefault((r["raster_id"], r["parcel"]), set()).add((r["px"], r["py"]))
    found = polygons.polygons(segmented).collect()
    assert {(r["raster_id"], r["parcel"]) for r in found} == set(pixels) and len(found) == len(pixels)
    for r in found:
        own = pixels[r["raster_id"], r["parcel"]]
        ((shell, *holes),) = r["geom"]
        rings = [[(p["x"], p["y"]) for p in line] for line in (shell, *holes)]
        assert all(len(set(line)) == len(line) - 1 and line[0] == line[-1] for line in rings)  # simple and closed
        area = [sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(line, line[1:])) / 2 for line in rings]
        assert area[0] > 0 and all(a < 0 for a in area[1:]) and sum(area) == len(own) == r["area"]
        assert all((b[0] - a[0] == 0) != (d[0] - b[0] == 0) for line in rings for a, b, d in zip(line, line[1:], line[2:]))  # every corner turns
        xs, ys = [x for x, _ in own], [y for _, y in own]
        box = [(x, y) for x in range(min(xs) - 1, max(xs) + 2) for y in range(min(ys) - 1, max(ys) + 2)]
        assert {(x, y) for x, y in box if inside(rings, x + 0.5, y + 0.5)} == own
        assert r["rings"] == len(rings) and r["corners"] == sum(len(line) - 1 for line in rings)


def test_holes_that_touch_are_rings_of_their_own(segmented):
    rings = {r["raster_id"]: r["rings"] for r in polygons.polygons(segmented).filter("parcel = 0 or raster_id = 'hole at the corner'").collect()}
    assert (rings["hole"], rings["touching holes"], rings["nested"], rings["one"]) == (2, 3, 2, 1)
    assert rings["hole at the corner"] == 2


def test_polygons_on_the_map_and_of_nothing(spark, segmented):
    meta = spark.createDataFrame([(k, 100.0, 50.0, 2.0, 3.0) for k in GRIDS], "raster_id string, ox double, oy double, rx double, ry double")
    on = polygons.on_map(polygons.polygons(segmented), meta).filter("raster_id = 'hole'").select(G.area(c("geom")).alias("a"), G.bounds(c("geom")).alias("b"), G.ring_area(F.get(F.get("geom", F.lit(0)), F.lit(0))).alias("shell")).first()
    assert on["a"] == 48.0 and tuple(on["b"]) == (100.0, 41.0, 106.0, 50.0) and on["shell"] > 0
    assert polygons.polygons(segmented.limit(0)).count() == 0


def test_ring_places_of_any_permutation(spark):
    rng = np.random.default_rng(2)
    links, node = [], 0
    for n in (1, 2, 3, 7, 64, 300):
        keys = rng.permutation(1000)[:n]
        links += [(node + i, node + (i + 1) % n, int(keys[i])) for i in range(n)]
        node += n
    got = {r["node"]: (r["first"], r["steps"]) for r in polygons.ring_places(spark.createDataFrame(links, "node long, next long, key long")).collect()}
    after, key = {a: b for a, b, _ in links}, {a: k for a, _, k in links}
    for a in after:
        cycle = [a]
        while (b := after[cycle[-1]]) != a:
            cycle.append(b)
        least = min(key[x] for x in cycle)
        assert got[a] == (least, [key[x] for x in cycle].index(least))


def test_dissolve_keeps_what_occurs_once(spark):
    boxes = spark.createDataFrame([("a", 0.0, 0.0), ("a", 1.0, 0.0), ("b", 1.0, 0.0)], "k string, x double, y double").withColumn("geom", G.box(c("x"), c("y"), c("x") + 1, c("y") + 1))
    assert {r["k"]: r["count"] for r in polygons.dissolve(boxes, ["k"]).groupBy("k").count().collect()} == {"a": 6, "b": 4}
    assert polygons.dissolve(boxes.filter("k = 'a'")).count() == 6


# -- boxes in levels


def test_boxes_of_all_sizes_meet_once(spark):
    rng = np.random.default_rng(4)

    def boxes(n, scale):
        size = scale * 10.0 ** rng.uniform(-6, 1, n)
        size[::7] = 0  # points
        at = rng.uniform(-scale, scale, (n, 2))
        return [(i, *map(float, (x, y, x + s, y + s * rng.uniform(0, 2)))) for i, ((x, y), s) in enumerate(zip(at, size, strict=True))]

    a, b = boxes(120, 5e5) + [(900, -9e5, -9e5, 9e5, 9e5), (901, 1.0, 1.0, 1.0, 1.0)], boxes(150, 5e5) + [(900, 0.0, 0.0, 0.0, 0.0), (901, 1.0, 1.0, 2.0, 2.0), (902, None, 1.0, 1.0, 1.0), (903, math.nan, 1.0, 1.0, 1.0)]
    got = [tuple(r) for r in tiles.bbox_join(spark.createDataFrame(a, BOXES), spark.createDataFrame(b, BOXES)).select("left.id", "right.id").collect()]
    want = {(p[0], q[0]) for p in a for q in b if q[1] is not None and not math.isnan(q[1]) and p[1] <= q[3] and p[3] >= q[1] and p[2] <= q[4] and p[4] >= q[2]}
    assert len(got) == len(want) and set(got) == want


@pytest.mark.parametrize("unit", [1.0, 111_320.0])
def test_a_box_is_dealt_to_few_cells(spark, unit):
    """The rows before the join, for boxes from metres to a country, in degrees and in metres."""
    rows = [(i, 0.0, 0.0, unit * s, unit * s) for i, s in enumerate((0.00001, 0.03, 1.1, 25.0))]
    boxes = spark.createDataFrame(rows, BOXES)
    plan = tiles.bbox_join(boxes, boxes)
    plan.collect()
    assert plan.count() == 16
    levels = boxes.select(tiles._level(F.struct(*tiles.BOX)).alias("v")).distinct().count()
    cells = F.pow(F.lit(2.0), tiles._level(F.struct(*tiles.BOX)))
    per = boxes.select(((F.floor(c("maxx") / cells) - F.floor(c("minx") / cells) + 1) * (F.floor(c("maxy") / cells) - F.floor(c("miny") / cells) + 1)).alias("n"))
    assert per.agg(F.max("n")).first()[0] <= 4 and levels <= len(rows)


def test_boxes_join_within_keys_and_empty_sides(spark):
    a = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0, "x"), (2, 0.0, 0.0, 1.0, 1.0, "y"), (3, 0.0, 0.0, 1.0, 1.0, None)], BOXES + ", k string")
    assert sorted(tuple(r) for r in tiles.bbox_join(a, a, on=["k"]).select("left.id", "right.id").collect()) == [(1, 1), (2, 2)]
    assert tiles.bbox_join(a, a.limit(0)).count() == tiles.bbox_join(a.limit(0), a).count() == 0


# -- outlines


@pytest.fixture(scope="module")
def coast(spark):
    rng = np.random.default_rng(8)
    rows = [(0, [[star(5, 45, 400, rng, 2, 4)]]), (1, [[star(2, 42, 40, rng)], [star(8, 48, 30, rng)]])]
    rows += [(2, [[ring([(0, 40), (10, 40), (10, 50), (0, 50)]), ring([(2.05, 42.05), (2.05, 47.95), (7.95, 47.95), (7.95, 42.05)])]]), (3, [[ring([(3, 43), (3.2, 43), (3.1, 43.2)])]]), (4, None), (5, [])]
    return spark.createDataFrame(rows, f"aoi_id int, geom {GEOM}")


def test_tiles_meet_outlines_as_before(spark, coast):
    """Whole tiles inside, in a hole, around a small part, touching and beside, as the row-wise predicate says."""
    t = spark.range(400).select(F.format_string("T%03d", "id").alias("tile_id"), ((c("id") % 20) * 0.5).alias("minx"), (40 + F.floor(c("id") / 20) * 0.5).alias("miny"))
    t = t.withColumns({"maxx": c("minx") + 0.5, "maxy": c("miny") + 0.5}).withColumn("geom", G.box(c("minx"), c("miny"), c("maxx"), c("maxy")))
    got = Counter(tuple(r) for r in outlines.tiles_meeting(t, coast).collect())
    both = tiles.spatial_join(t.select("tile_id", "geom"), coast).select("left.tile_id", "right.aoi_id")
    want = {tuple(r) for r in both.collect()}
    assert set(got) == want and max(got.values()) == 1 and len(want) > 300
    assert outlines.tiles_meeting(t.limit(0), coast).count() == outlines.tiles_meeting(t, coast.limit(0)).count() == 0


def test_an_outline_of_many_vertices(spark):
    n = 100_000
    points = F.transform(F.sequence(F.lit(0), F.lit(n)), lambda i: G.point(5 + (4 + 0.1 * F.sin(F.lit(2 * math.pi * 997 / n) * (i % n))) * F.cos(F.lit(2 * math.pi / n) * (i % n)), 45 + (4 + 0.1 * F.sin(F.lit(2 * math.pi * 997 / n) * (i % n))) * F.sin(F.lit(2 * math.pi / n) * (i % n))))
    country = spark.range(1).select(F.lit(7).alias("aoi_id"), F.array(F.array(points)).alias("geom"))
    t = spark.range(2500).select(c("id").alias("tile_id"), ((c("id") % 50) * 0.2).alias("minx"), (40 + F.floor(c("id") / 50) * 0.2).alias("miny"))
    t = t.withColumn("geom", G.box(c("minx"), c("miny"), c("minx") + 0.2, c("miny") + 0.2))
    got = {r["tile_id"] for r in outlines.tiles_meeting(t, country).collect()}
    # away from the shore, distances decide
    for i in range(2500):
        x, y = (i % 50) * 0.2, 40 + i // 50 * 0.2
        corners = [math.hypot(x + dx - 5, y + dy - 45) for dx in (0, 0.2) for dy in (0, 0.2)]
        if max(corners) < 3.89:
            assert i in got
        if min(corners) > 4.31:
            assert i not in got
    assert {i for i in range(2500)} - got and len(got) > 1000


def test_crossings_are_those_of_the_ring(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [[star(0, 0, 12 + i, rng)]]) for i in range(6)]
    for i in (1, 4):  # swapped corners
        line = rows[i][1][0][0]
        line[3], line[7] = line[7], line[3]
    rows += [(10, [[ring([(0, 0), (2, 2), (2, 0), (0, 2)])]]), (11, [[ring([(0, 0), (4, 0), (4, 4), (2, 0), (0, 4)])]]), (12, [[ring([(0, 0), (1, 0), (0, 1)])], [ring([(0, 0), (2, 2), (2, 0), (0, 2)])]]), (13, None)]
    layer = spark.createDataFrame(rows, f"id int, geom {GEOM}")
    flagged = {r["id"] for r in layer.filter(G.self_crossing(c("geom"))).collect()}
    found = outlines.crossing_rings(layer, ["id"]).collect()
    assert {r["id"] for r in found} == flagged and {10, 11, 12} <= flagged
    assert {(r["id"], r["poly"]): r["crossings"] for r in found}[12, 1] == 1


def test_a_long_ring_is_searched_near_edges_only(spark):
    n = 50_000
    points = F.transform(F.sequence(F.lit(0), F.lit(n)), lambda i: G.point(F.cos(F.lit(2 * math.pi / n) * (i % n)), F.sin(F.lit(2 * math.pi / n) * (i % n))))
    circle = spark.range(1).select(F.lit(1).alias("id"), F.array(F.array(points)).alias("geom"))
    assert outlines.crossing_rings(circle, ["id"]).count() == 0


# -- coverage


@pytest.mark.parametrize("block", [1 << 16, 5])
def test_union_area_equals_counted_cells(spark, monkeypatch, block):
    monkeypatch.setattr(coverage, "BLOCK", block)
    rng = np.random.default_rng(9)
    shapes = [(str(i % 3), i, [[star(*rng.uniform(0, 4, 2), 9, rng)]]) for i in range(24)]
    shapes += [("0", 90, [[ring([(0, 0), (4, 0), (4, 4), (0, 4)]), ring([(1, 1), (1, 3), (3, 3), (3, 1)])]]), ("hole", 91, [[ring([(0, 0), (4, 0), (4, 4), (0, 4)]), ring([(1, 1), (1, 3), (3, 3), (3, 1)])]]), ("none", 92, None), ("tiny", 93, [[ring([(0.3, 0.3), (0.31, 0.3), (0.3, 0.31)])]])]
    layer = spark.createDataFrame(shapes, f"k string, id int, geom {GEOM}")
    cell = 0.1
    got = {r["k"]: r["cells"] for r in coverage.union_area(layer, ["k"], ["id"], cell).collect()}
    for k in ("0", "1", "2", "hole"):
        own = [rings for name, _, geom in shapes if name == k for rings in geom]
        centres = [(i, j) for i in range(-30, 80) for j in range(-30, 80)]
        assert got[k] == sum(any(inside(rings, (i + 0.5) * cell, (j + 0.5) * cell) for rings in own) for i, j in centres)
    assert set(got) == {"0", "1", "2", "hole"} and got["hole"] == 1200
    with pytest.raises(ValueError):
        coverage.union_area(layer, ["k"], ["id"], 0.0)


def test_edge_matched_polygons_share_no_cell(spark):
    layer = spark.range(16).select(c("id"), G.box(c("id") % 4 * 0.25, F.floor(c("id") / 4) * 0.25, (c("id") % 4 + 1) * 0.25, (F.floor(c("id") / 4) + 1) * 0.25).alias("geom"))
    spans = coverage.cell_spans(layer, ["id"], 0.03)
    per = spans.select("row", F.explode(F.sequence("first", c("stop") - 1)).alias("col"))
    assert per.count() == per.distinct().count() == 33 * 33


# -- CRS by row


def test_areas_by_row_equal_those_of_one_system(spark):
    at = spark.range(40).select(c("id"), (-170 + c("id") * 8.5).alias("x"), (-60 + c("id") * 3.0).alias("y"))
    zone = (F.floor((c("x") + 180) / 6) + 1).cast("int")
    at = at.withColumn("geom", G.box(c("x"), c("y"), c("x") + 0.01, c("y") + 0.01)).withColumn("srid", F.when(c("y") < 0, 32700).otherwise(32600) + zone)
    moved = at.withColumn("utm", crs.to_utm_by_row(c("geom"), c("srid"))).select("srid", crs.area_m2(c("geom")).alias("want"), crs.area_m2(c("utm"), c("srid")).alias("got"))
    rows = moved.collect()
    assert len({r["srid"] for r in rows}) > 30
    assert all(r["got"] == pytest.approx(r["want"], rel=1e-6) for r in rows)
    mixed = spark.createDataFrame([(4326,), (3857,), (6933,), (32631,), (2154,), (None,)], "srid int").withColumn("geom", square())
    by = {r["srid"]: r["a"] for r in mixed.select("srid", crs.area_m2(c("geom"), c("srid")).alias("a")).collect()}
    one = lambda s: spark.range(1).select(crs.area_m2(square(), s)).first()[0]
    assert all(by[s] == pytest.approx(one(s), rel=1e-12) for s in (4326, 3857, 6933, 32631)) and by[2154] is None and by[None] is None


def square():
    return G.box(F.lit(1.0), F.lit(2.0), F.lit(1.5), F.lit(2.5))


def test_summary_says_which_areas_failed(spark):
    rows = [("a", 4326, 1.0), ("a", 4326, math.nan), ("a", 4326, 2.0), ("b", 32631, 1.0), ("b", None, 1.0), ("c", 4326, math.nan)]
    f = spark.createDataFrame(rows, "source string, srid int, x double").withColumn("layer", F.lit("l")).withColumn("geom", G.box(c("x"), F.lit(40.0), c("x") + 0.01, F.lit(40.01)))
    got = {(r["source"], r["srid"]): r for r in parcels.summary(f).collect()}
    each = spark.range(1).select(crs.area_m2(G.box(F.lit(1.0), F.lit(40.0), F.lit(1.01), F.lit(40.01))) / 10000).first()[0]
    a = got["a", 4326]
    assert a["feature_count"] == 3 and a["total_area_ha"] == pytest.approx(2 * each) and a["median_area_ha"] == pytest.approx(each) and a["area_error"] == "1 of 3 features have no area"
    assert got["b", 32631]["area_error"] is None and got["b", None]["area_error"].endswith("EPSG:none") and got["b", None]["total_area_ha"] is None
    assert got["c", 4326]["total_area_ha"] is None and got["c", 4326]["area_error"] == "1 of 1 features have no area"
    assert {r["area_error"] for r in parcels.summary(f, 4326).filter("source = 'b'").collect()} == {None}


# -- scratch tables


def test_replaced_tables_are_deleted(spark):
    from pathlib import Path

    from tilth.scratch import materialize, replaced

    place = lambda df: Path(df.scratch.removeprefix("file://").removeprefix("file:"))
    one = materialize(spark.range(5), "scratch-test")
    assert place(one).exists() and spark.sparkContext.applicationId in one.scratch
    two = replaced(one, one.filter("id > 1"), "scratch-test")
    assert not place(one).exists() and sorted(r["id"] for r in two.collect()) == [2, 3, 4]
