"""Edge cases, guards and properties of the parcel operators."""

from __future__ import annotations

import math
import sqlite3
import struct
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilth.functions import scalars
from tilth.operators import composite, crs, landcover, parcels, raster, tiles
from tilth.operators import geometry as G
from tilth.operators.components import connected_components
from tilth.operators.quantile import exact_quantiles
from tilth.sinks import results as sinks
from tilth.sources import gpkg, vectors

c = F.col


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def square(x, y, w):
    return G.box(F.lit(float(x)), F.lit(float(y)), F.lit(float(x + w)), F.lit(float(y + w)))


def test_equal_area_projection_meets_published_extent(spark):
    p = one(spark, crs.point_to_crs(G.point(F.lit(180.0), F.lit(85.0445664)), 4326, 6933))
    assert abs(p["x"] - 17367530.445) < 1e-3 and abs(p["y"] - 7314540.831) < 5e-3
    assert abs(one(spark, crs.area_m2(G.box(F.lit(-180.0), F.lit(-90.0), F.lit(180.0), F.lit(90.0)))) / 5.10065621724e14 - 1) < 1e-9


def test_utm_round_trip_and_known_point(spark):
    p = one(spark, crs.point_to_crs(G.point(F.lit(3.0), F.lit(0.0)), 4326, 32631))
    assert abs(p["x"] - 500000) < 1e-6 and abs(p["y"]) < 1e-6
    there = crs.point_to_crs(G.point(F.lit(5.5), F.lit(51.25)), 4326, 32631)
    back = one(spark, crs.point_to_crs(there, 32631, 4326))
    assert abs(back["x"] - 5.5) < 1e-9 and abs(back["y"] - 51.25) < 1e-9
    with pytest.raises(ValueError):
        crs.point_to_crs(G.point(F.lit(0.0), F.lit(0.0)), 4326, 2154)


def test_clip_area_is_exact(spark):
    tri = G.polygon((F.lit(0.0), F.lit(0.0)), (F.lit(4.0), F.lit(0.0)), (F.lit(2.0), F.lit(4.0)))
    assert one(spark, G.area(G.clip_convex(tri, square(0, 0, 2)))) == pytest.approx(3.0)
    assert one(spark, F.size(G.clip_convex(tri, square(10, 10, 2)))) == 0
    assert one(spark, G.area(G.clip_convex(tri, square(-10, -10, 40)))) == pytest.approx(8.0)


@pytest.mark.parametrize("x,y,hit", [(0, 0, True), (4, 0, True), (4.0001, 0, False), (1.5, 1, True), (3.9, 3, False)])
def test_intersects_with_touch(spark, x, y, hit):
    tri = G.polygon((F.lit(0.0), F.lit(0.0)), (F.lit(4.0), F.lit(0.0)), (F.lit(2.0), F.lit(4.0)))
    assert one(spark, G.intersects(tri, square(x, y, 0.5))) is hit


def test_holes_null_and_empty(spark):
    ring = lambda x, y, w: F.get(F.get(square(x, y, w), F.lit(0)), F.lit(0))
    holed = F.array(F.array(ring(0, 0, 4), ring(1, 1, 1)))
    assert one(spark, G.area(holed)) == pytest.approx(15.0)
    assert one(spark, G.covers_point(holed, G.point(F.lit(1.5), F.lit(1.5)))) is False
    assert one(spark, G.nonempty(G.empty())) is False
    assert one(spark, G.geojson(G.empty())) is None


def test_repair_and_bow_tie(spark):
    p = [G.point(F.lit(float(x)), F.lit(float(y))) for x, y in ((0, 0), (0, 2), (0, 2), (2, 2), (2, 0))]
    fixed = one(spark, G.repaired(F.array(F.array(F.array(*p)))))
    assert len(fixed[0][0]) == 5 and fixed[0][0][0] == fixed[0][0][-1]
    assert one(spark, G.ring_area(F.get(F.get(G.repaired(F.array(F.array(F.array(*p)))), F.lit(0)), F.lit(0)))) == pytest.approx(4.0)
    tie = [G.point(F.lit(float(x)), F.lit(float(y))) for x, y in ((0, 0), (2, 2), (2, 0), (0, 2), (0, 0))]
    assert one(spark, G.self_crossing(F.array(F.array(F.array(*tie))))) is True
    line = F.array(F.array(F.array(p[0], p[1], p[0])))
    assert one(spark, F.size(G.repaired(line))) == 0


def test_bucket_join_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    boxes = lambda n: [(i, *map(float, (x, y, x + w, y + h))) for i, (x, y, w, h) in enumerate(np.c_[rng.uniform(-5, 5, (n, 2)), rng.uniform(0, 3, (n, 2))])]
    a, b = boxes(40), boxes(50)
    schema = "id int, minx double, miny double, maxx double, maxy double"
    got = tiles.bbox_join(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)).select("left.id", "right.id").collect()
    want = {(p[0], q[0]) for p in a for q in b if p[1] <= q[3] and p[3] >= q[1] and p[2] <= q[4] and p[4] >= q[2]}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_tile_guards(spark):
    t = spark.createDataFrame([("a", 1), ("a", 0), ("B", 2)], "tile_id string, k int")
    assert {r["k"] for r in tiles.dedupe(t, c("k")).collect()} == {0, 2}
    assert tiles.include(t, ["b"]).count() == 1 and tiles.include(t, []).count() == 3
    with pytest.raises(ValueError):
        tiles.first_tiles(t, 0)


OBS = "tile_id string, scene_id long, acquired date, px long, py long, b04 long, b03 long, b02 long, b08 long, valid boolean"


def test_composite_edges(spark):
    d1, d2 = date(2024, 1, 1), date(2024, 2, 1)
    obs = spark.createDataFrame([("T", 1, d1, 0, 0, 0, 1, 1, 0, True), ("T", 2, d2, 0, 0, 10, 2, 2, 30, True), ("T", 3, d2, 0, 0, 10, 3, 3, 30, True), ("T", 4, d1, 1, 0, 5, 5, 5, 5, False)], OBS)
    best = composite.max_ndvi(obs).collect()
    assert [(r["px"], r["scene_id"], r["b03"]) for r in best] == [(0, 2, 2)]  # null NDVI loses, ties go to the lower scene
    grid = spark.createDataFrame([("T", 0, 0), ("T", 1, 0)], "tile_id string, px long, py long")
    assert {r["px"]: r["b04"] for r in composite.fill_nodata(best and composite.max_ndvi(obs), grid).collect()} == {0: 10, 1: 0}
    with pytest.raises(ValueError):
        composite.percentile(obs, None)
    with pytest.raises(ValueError):
        composite.median(obs, ["b99"])
    with pytest.raises(ValueError):
        composite.in_period(obs, d2, d1)
    stop = composite.coverage_stop(obs, composite.rank_scenes(obs)).orderBy("rank").collect()
    assert all(r["kept"] for r in stop)  # never reached, so all scenes stay


def test_mode_tie_and_range(spark):
    rows = spark.createDataFrame([("T", 0, 0, x) for x in (3, 3, 1, 1, 12)], "tile_id string, px long, py long, label long")
    assert landcover.mode(rows).first()["label"] == 1
    assert {r["label"] for r in landcover.histogram(rows).collect()} == {1, 3}


def test_stretch_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("a", 0, nan), ("a", 1, inf), ("a", 2, 1.0), ("a", 3, 3.0), ("b", 0, -1.0), ("b", 1, 0.0), ("k", 0, 5.0), ("k", 1, 5.0)]
    out = raster.contrast_stretch(spark.createDataFrame(rows, "band string, i int, value double"), ["band"]).collect()
    v = {(r["band"], r["i"]): r["value"] for r in out}
    assert math.isnan(v["a", 0]) and v["a", 1] == 1.0 and v["b", 0] == v["b", 1] == 0.0 and v["k", 0] == 0.0


@pytest.mark.parametrize("size,overlap,w,h", [(5, 2, 13, 7), (4, 0, 4, 4), (8, 3, 1, 1)])
def test_windows_stitch_to_identity(spark, size, overlap, w, h):
    px = spark.createDataFrame([("r", x, y, float(x * 100 + y)) for x in range(w) for y in range(h)], "raster_id string, px long, py long, value double")
    meta = spark.createDataFrame([("r", w, h)], "raster_id string, width long, height long")
    win = raster.windows(px, meta, size, overlap).select("raster_id", "wx", "wy", "ix", "iy", "value")
    assert sorted(raster.stitch(win, meta, size, 1, overlap // 2).select("raster_id", "px", "py", "value").collect()) == sorted(px.collect())
    with pytest.raises(ValueError):
        raster.stride(4, 4)


def test_chunks_add_up(spark):
    tri = G.polygon((F.lit(0.0), F.lit(0.0)), (F.lit(1.0), F.lit(0.1)), (F.lit(0.3), F.lit(0.8)))
    g = spark.range(1).select("id", tri.alias("geom"))
    total = g.select(G.area(c("geom")).alias("a")).first()["a"]
    assert raster.chunk_grid(g, 0.15, ["id"]).agg(F.sum(G.area(c("geom")))).first()[0] == pytest.approx(total)
    with pytest.raises(ValueError):
        raster.chunk_grid(g, 0, ["id"])


def test_segments_of_a_whole_raster(spark):
    rng = np.random.default_rng(5)
    grid = rng.integers(0, 3, (20, 30))
    rows = [("r", x, y, int(grid[y, x])) for y in range(20) for x in range(30) if grid[y, x]]
    got = parcels.segments(spark.createDataFrame(rows, "raster_id string, px long, py long, label int").repartition(5)).collect()
    label = {(r["px"], r["py"]): r["parcel"] for r in got}
    want, seen = {}, set()
    for y in range(20):
        for x in range(30):
            if grid[y, x] and (x, y) not in seen:
                stack = [(x, y)]
                seen.add((x, y))
                while stack:
                    a, b = stack.pop()
                    want[a, b] = y * parcels.CELL + x
                    for n in ((a + 1, b), (a - 1, b), (a, b + 1), (a, b - 1)):
                        if 0 <= n[0] < 30 and 0 <= n[1] < 20 and n not in seen and grid[n[1], n[0]] == grid[y, x]:
                            seen.add(n)
                            stack.append(n)
    assert label == want


def test_components_of_chains_loops_and_nothing(spark):
    e = [(i, i + 1) for i in range(50)] + [(100, 102), (102, 101), (7, 7), (100, 102)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(e, "src long, dst long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 101: 100, 102: 100}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_scalars(spark):
    assert one(spark, scalars.parse_csv(F.lit(None).cast("string"))) == []
    assert one(spark, scalars.parse_csv(F.lit(" a, ,b,"))) == ["a", "b"]
    assert one(spark, scalars.tile_of(F.lit("/x/T1.simp.gpkg"))) == "T1"
    assert one(spark, scalars.parse_date(F.lit("2024-02-29"))) == date(2024, 2, 29)
    for bad in ("20240101", "2024-1-1", "2024-W01-1", "2023-02-29"):
        with pytest.raises(Exception):
            one(spark, scalars.parse_date(F.lit(bad)))
    with pytest.raises(Exception):
        one(spark, scalars.parse_int_csv(F.lit("1,x")))


def test_geojson_collection_and_wkt(spark, tmp_path):
    poly = '{"type":"Polygon","coordinates":[[[0,0,9],[1,0,9],[1,1,9],[0,0,9]]]}'
    geoms = [poly, f'{{"type":"GeometryCollection","geometries":[{poly},{{"type":"Point","coordinates":[0,0]}},{poly}]}}', '{"type":"Point","coordinates":[1,2]}', "null"]
    (tmp_path / "a.geojson").write_text('{"type":"FeatureCollection","features":[' + ",".join(f'{{"type":"Feature","properties":{{"k":"{i}"}},"geometry":{g}}}' for i, g in enumerate(geoms)) + "]}")
    got = {r["k"]: r["n"] for r in vectors.read_geojson(spark, str(tmp_path / "a.geojson")).select(c("properties")["k"].alias("k"), F.size("geom").alias("n")).collect()}
    assert {k: v for k, v in got.items() if v and v > 0} == {"0": 1, "1": 2}
    wkt = {"POLYGON ((0 0, 1 0, 1 1, 0 0), (0.2 0.1, 0.4 0.1, 0.4 0.2, 0.2 0.1))": (1, 2), "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))": (2, 1)}
    for text, (n, r) in wkt.items():
        g = one(spark, vectors.wkt_geometry(F.lit(text)))
        assert (len(g), len(g[0]), g[0][0][1]["x"]) == (n, r, 1.0)
    assert one(spark, vectors.wkt_geometry(F.lit("POINT (1 2)"))) is None
    with pytest.raises(ValueError):
        vectors.expand_inputs(spark)


def blob(ring, envelope=0):
    head = b"GP\x00" + bytes([envelope << 1 | 1]) + struct.pack("<i", 4326) + b"\0" * gpkg.ENVELOPES[envelope]
    return head + struct.pack("<BIII", 1, 3, 1, len(ring)) + b"".join(struct.pack("<dd", *p) for p in ring)


def test_gpkg_headers_and_box(spark, tmp_path):
    ring = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]
    for e in gpkg.ENVELOPES:
        assert gpkg.decode(blob(ring, e)) == [[ring]]
    with pytest.raises(ValueError):
        gpkg.header_size(b"GP\x00\x0b")
    assert gpkg.decode(None) is None
    with sqlite3.connect(tmp_path / "t.gpkg") as db:
        db.execute("create table gpkg_geometry_columns (table_name text, column_name text, srs_id integer)")
        db.execute("insert into gpkg_geometry_columns values ('g', 'geom', 4326)")
        db.execute("create table g (fid integer primary key, tile_id text, geom blob)")
        db.execute("insert into g values (1, 'a', ?), (2, 'b', ?), (3, 'c', null)", (blob(ring), blob([(x + 5, y) for x, y in ring])))
    df = gpkg.read_gpkg(spark, str(tmp_path))
    assert [r["id"] for r in tiles.bbox_scan(df, 4.0, 0.0, 9.0, 9.0).collect()] == ["b"]
    assert df.filter("geom is null").count() == 1
    assert {r["id"] for r in gpkg.read_gpkg(spark, f"file:{tmp_path}/t*.gpkg", id="fid").collect()} == {"1", "2", "3"}
    with pytest.raises(Exception, match="no column nosuch"):
        gpkg.read_gpkg(spark, str(tmp_path), id="nosuch").collect()
    with pytest.raises(ValueError, match="no id column"):
        gpkg.id_column(["fid", "geom"], None)


def test_gpkg_box_reaches_the_rtree(spark, tmp_path):
    """Rows outside the box are never decoded: a damaged blob there does no harm."""
    from tilth.plans.results import _gpkg_file

    path = str(tmp_path / "r.gpkg")
    _gpkg_file(path, [(i, float(i), 0.0, i + 0.5, 1.0) for i in range(200)])
    with sqlite3.connect(path) as db:
        db.execute("update parcels set geom = x'475000ff' where fid > 100")
    near = tiles.bbox_scan(gpkg.read_gpkg(spark, path), 9.75, 0.0, 12.0, 9.0)
    assert sorted(r["id"] for r in near.collect()) == ["10", "11", "12"]
    with pytest.raises(Exception, match="envelope"):
        gpkg.read_gpkg(spark, path).collect()


@pytest.mark.parametrize("values", [[1.0], [2.0, 1.0], [0.0, 0.0, -1.5, -1e300, 1e-300, 3.0], list(np.random.default_rng(0).lognormal(0, 4, 999)), list(np.random.default_rng(1).normal(0, 1, 500)) + [7.0] * 500])
def test_quantiles_are_exact(spark, values):
    shares = (0.0, 0.02, 0.5, 0.98, 1.0)
    rows = [(g, float(v)) for g in ("a", None) for v in values] + [("b", None)]
    out = {r["key"]["g"]: r["q"] for r in exact_quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", shares).collect()}
    assert set(out) == {"a", None}
    for q in out.values():
        assert q == pytest.approx(list(np.quantile(values, shares)), rel=1e-12, abs=1e-300)


def test_quantiles_keep_no_group_in_one_buffer(spark):
    plan = raster.contrast_stretch(spark.createDataFrame([("a", 1.0)], "band string, value double"), ["band"])._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan


def test_clip_equals_the_point_test(spark):
    """Row spans against the test of each pixel's centre, with a hole, a concave shell, and edges on centres."""
    rings = [[(1.0, 1.0), (9.5, 1.5), (9.0, 8.5), (5.5, 4.5), (1.5, 9.0), (1.0, 1.0)], [(3.0, 2.5), (4.5, 2.5), (4.5, 4.5), (3.0, 4.5), (3.0, 2.5)]]
    geom = F.array(F.array(*[F.array(*[G.point(F.lit(x), F.lit(y)) for x, y in ring]) for ring in rings]))
    px = spark.range(100).selectExpr("'r' as raster_id", "id % 10 as px", "cast(floor(id / 10) as bigint) as py", "1.0d as value")
    meta = spark.createDataFrame([("r", 10, 10, 0.0, 10.0, 1.0, 1.0, None)], "raster_id string, width long, height long, ox double, oy double, rx double, ry double, nodata double")
    aoi = spark.range(1).select(F.lit("r").alias("raster_id"), geom.alias("geom"))
    got = {(r["px"] + 1, r["py"] + 1) for r in raster.clip(px, meta, aoi).collect() if r["value"] == 1.0}
    want = px.crossJoin(aoi.select("geom")).filter(G.covers_point(c("geom"), G.point(c("px") + 0.5, 10 - c("py") - 0.5)))
    assert got == {(r["px"], r["py"]) for r in want.select("px", "py").collect()} and 20 < len(got) < 80


def test_a_tile_that_only_touches_gets_the_whole_part(spark):
    t = spark.range(2).select(F.concat(F.lit("t"), c("id").cast("string")).alias("tile_id"), G.box(c("id") * 2.0, F.lit(0.0), c("id") * 2.0 + 2, F.lit(2.0)).alias("geom"))
    a = spark.range(1).select(F.lit(1).alias("aoi_id"), square(1, 0, 1).alias("geom"))
    got = {r["tile_id"]: r["area"] for r in tiles.aoi_clip(t, a).select("tile_id", G.area(c("geom")).alias("area")).collect()}
    assert got == {"t0": 1.0, "t1": 1.0}


def test_kml_documents_are_well_formed(spark, tmp_path):
    from xml.etree import ElementTree

    f = spark.range(30).select(F.when(c("id") % 3 > 0, F.concat(F.lit("a/"), (c("id") % 3).cast("string"))).alias("source"), c("id").alias("name"), F.when(c("id") > 0, square(0, 0, 1)).alias("geom"))
    sinks.write_kml(f.repartition(4), str(tmp_path / "k"), "name")
    found = {}
    for folder in (tmp_path / "k").glob("source=*"):
        (text,) = [x.read_text() for x in folder.glob("part-*")]
        marks = ElementTree.fromstring(text.encode()).findall(".//{http://www.opengis.net/kml/2.2}Placemark")
        found[folder.name] = len(marks)
    assert sorted(found.values()) == [9, 10, 10]


def test_nested_collections(spark):
    poly = '{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}'
    text = poly
    for depth in range(1, 5):
        text = f'{{"type":"GeometryCollection","geometries":[{text},{poly}]}}'
        assert len(one(spark, vectors.geojson_geometry(F.lit(text), 4))) == depth + 1


def test_summary_keeps_unknown_crs(spark):
    f = spark.range(2).select(F.lit("s").alias("source"), F.lit("l").alias("layer"), F.lit(2154).alias("srid"), square(0, 0, 1).alias("geom"))
    row = parcels.summary(f).first()
    assert row["feature_count"] == 2 and row["total_area_ha"] is None and "2154" in row["area_error"]


def test_kml_and_summary_csv(spark):
    f = spark.range(1).select(F.lit("<a&b>").alias("name"), square(0, 0, 1).alias("geom"))
    text = sinks.placemarks(f, "name").first()["value"]
    assert "&lt;a&amp;b&gt;" in text and text.count("<Polygon>") == 1
    row = sinks.summary_csv(spark.createDataFrame([("s", 3)], "source string, feature_count long")).first()
    assert tuple(row) == ("s", "", "", "3", "", "")
