"""Cases that only larger tables have, as small tables: queries against DuckDB, and their operators."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest

from tests.test_queries import rows
from tilth.plans.registry import ORACLES, QUERIES


@pytest.fixture
def agrees(spark, tmp_path):
    """Runs a query and its SQL on the given tables."""

    def run(name: str, **tables: pd.DataFrame) -> int:
        db = duckdb.connect()
        for table, pdf in tables.items():
            pdf.to_parquet(f"{tmp_path}/{table}.parquet", coerce_timestamps="us")
            db.execute(f"create view {table} as select * from '{tmp_path}/{table}.parquet'")
        got, want = QUERIES[name](spark, str(tmp_path)).toPandas(), db.execute(ORACLES[name]).df()
        assert rows(got) == rows(want)
        return len(got)

    return run


def customers(*keys: int) -> pd.DataFrame:
    return pd.DataFrame({"c_custkey": list(keys), "c_nationkey": [k % 25 for k in keys]})


def parts(*keys: int) -> pd.DataFrame:
    return pd.DataFrame({"p_partkey": list(keys), "p_size": [1] * len(keys)})


def orders(*keys: int, customers: int = 1000) -> pd.DataFrame:
    return pd.DataFrame({"o_orderkey": list(keys), "o_custkey": [k % customers for k in keys], "o_orderdate": pd.to_datetime("1997-01-01")})


def test_rounding_at_a_slanted_side_is_decided_as_in_sql(agrees):
    assert agrees("tile_spatial_join", customer=customers(3051, 5468, 6168), part=parts(*range(110)))


def test_clips_have_the_same_pairs(agrees):
    assert agrees("tile_aoi_clip", customer=customers(3051, 5468, 6168), part=parts(*range(110)))


@pytest.mark.parametrize("name", ["geom_geojson", "geom_repair"])
def test_tiny_coordinates_as_text(agrees, name):
    assert agrees(name, customer=customers(1, 2379)) == 2


@pytest.mark.parametrize("x", [0.0, 1e-3, 9.99e-4, 1.25e-4, -1e-4, 9.9e-5, -2.5e-17, 1e-300, 9999999.0, 1e7, -12345678.25, 123456789012345.6, 1e15, 1e16, -1.5e300])
def test_numbers_as_text(spark, x):
    from pyspark.sql import functions as F

    from tilth.operators import geometry as G

    assert spark.range(1).select(G.number_text(F.lit(x) + F.col("id")).alias("t")).first()["t"] == repr(x)


def test_tiny_coordinates_of_points_as_text(agrees):
    assert agrees("geom_force_2d", customer=customers(1, 2379)) == 2


def test_a_tile_listed_twice_is_staged_twice(agrees):
    assert agrees("stage_manifest", part=parts(7, 10000, 100000, 100001)) == 4


def test_a_name_of_no_tile_is_of_none_at_any_size(agrees):
    assert agrees("tile_include", part=parts(1, 42, 99999)) == 2


@pytest.mark.parametrize("last", [4000, 160000])
def test_a_scene_too_narrow_for_a_column(agrees, last):
    found = agrees("raster_decimate", embeddings=pd.DataFrame({"vec_id": [42, 1610, last], "embedding": [[0.5] * 64] * 3}))
    assert (found > 0) == (last == 4000)


@pytest.mark.parametrize("last", [19999, 20000, 160000])
def test_a_scene_of_any_height_keeps_a_column(spark, agrees, tmp_path, last):
    """Above 20,000 embeddings (vec_id from 0) the scale leaves less than one column; the reference keeps max(1, int(width / scale))."""
    ids = [*range(10, last, 20), last]
    height = (last // 20 + 1) * 8
    out = max(1, int(height / max(160 / 50, height / 50, 1)))
    rows_of = [int((y + 0.5) * height / out) for y in range(out)]
    want = [(0, y, float((r // 8 * 20 + 10) * 64 + r % 8 * 8)) for y, r in enumerate(rows_of)]
    assert agrees("raster_decimate", embeddings=pd.DataFrame({"vec_id": ids, "embedding": [[float(k * 64 + i) for i in range(64)] for k in ids]})) == out
    assert sorted(map(tuple, QUERIES["raster_decimate"](spark, str(tmp_path)).collect())) == want


def test_collections_stay_whole_in_any_number_of_tasks(spark, agrees):
    small = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    old = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        assert agrees("src_geojson_split", orders=orders(*range(2000))) == 2000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_files_of_equal_tile_ids_are_all_found(agrees):
    assert agrees("src_expand_inputs", part=parts(*range(1500), 10000, 100000, 100001)) == 1503


def test_inputs_are_listed_by_level(spark, tmp_path):
    from tilth.sources.vectors import expand_inputs

    for name in ("a/x.gpkg", "a/b/y.gpkg", "a/b/z.txt", "a/_hidden/h.gpkg", "c/k1.gpkg", "c/k2.gpkg", "c/m.gpkg", "one.gpkg"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("")
    names = lambda *inputs: [r["path"].rsplit("/", 1)[1] for r in expand_inputs(spark, *inputs).collect()]
    assert names(f"{tmp_path}/a") == ["y.gpkg", "x.gpkg"]
    assert names(f"{tmp_path}/c/k*", f"{tmp_path}/c/k1.gpkg", f"{tmp_path}/one.gpkg") == ["k1.gpkg", "k2.gpkg", "one.gpkg"]
    assert names(f"{tmp_path}/*/{{k1,m}}.gpkg") == ["k1.gpkg", "m.gpkg"]
    assert names(f"file:{tmp_path}/[a]*") == ["y.gpkg", "x.gpkg"]
    with pytest.raises(ValueError):
        names(f"{tmp_path}/nothing*")
    with pytest.raises(FileNotFoundError):
        names(f"{tmp_path}/missing")


@pytest.mark.parametrize("name", ["composite_coverage_stop", "band_reorder"])
def test_blocks_of_ranks_and_tasks_of_a_large_table(spark, monkeypatch, name):
    from tests.test_queries import SF
    from tilth.operators import composite
    from tilth.plans import fixtures

    monkeypatch.setattr(composite, "RANKS", 3)
    monkeypatch.setattr(fixtures, "ROWS", 500)
    db = duckdb.connect()
    for table in ("orders", "lineitem"):
        db.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    assert fixtures.spread(fixtures.fixture(spark, SF, "lineitem"), "l_orderkey").rdd.getNumPartitions() > 4
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(db.execute(ORACLES[name]).df())


def test_edges_side_by_side_are_not_all_compared(spark, agrees, monkeypatch):
    from tilth.operators import outlines

    most, whole = {}, outlines.materialize

    def counted(df, tag):
        out = whole(df, tag)
        most[tag] = max(most.get(tag, 0), out.count())
        return out

    monkeypatch.setattr(outlines, "materialize", counted)
    assert agrees("geom_crossings", customer=customers(*range(1, 50000, 25))) == 1
    assert 2000 < most["ring-pairs"] < 2000 * 30


def test_turned_boxes_of_rings_of_few_edges(spark):
    from tilth.operators import geometry as G
    from tilth.operators.outlines import crossing_rings

    rings = [(1, [(0, 0), (2, 2), (2, 0), (0, 2)]), (2, [(0, 0), (3, 0), (3, 3), (0, 3)]), (3, [(0, 0), (4, 0), (4, 4), (2, 0), (0, 4)]), (4, [(0, 0), (1, 1)])]
    data = [(k, [[[{"x": float(x), "y": float(y)} for x, y in [*ps, ps[0]]]]]) for k, ps in rings]
    found = crossing_rings(spark.createDataFrame(data, f"id long, geom {G.TYPE}"), ["id"]).collect()
    assert {r["id"]: r["crossings"] for r in found} == {1: 1, 3: 2}


@pytest.mark.parametrize("name", ["tile_bbox_join", "tile_outline_join"])
def test_sides_of_a_box_join_are_not_broadcast(spark, name):
    from tests.test_queries import SF

    cells = [j for j in QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString().split("\n") if "cell_x" in j and "Join" in j]
    assert not any("Broadcast" in j for j in cells)
    plan = QUERIES["tile_bbox_join"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_spans_of_a_clip_are_joined_by_chunk(spark):
    from tests.test_queries import SF

    plan = QUERIES["raster_clip_chunks"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert any("Join LeftSemi" in j and "cx" in j and "cy" in j for j in plan.split("\n"))


def test_a_tile_is_tried_with_its_likeliest_part_first(spark, monkeypatch):
    """The triangle with the largest common box misses tile b, which a smaller one meets; tile c meets none."""
    from tilth.operators import geometry as G
    from tilth.operators import tiles as T

    seen, whole = {}, T.materialize

    def counted(df, tag):
        out = whole(df, tag)
        seen[tag] = out.count()
        return out

    monkeypatch.setattr(T, "materialize", counted)
    c = lambda *ps: [[[{"x": float(x), "y": float(y)} for x, y in [*ps, ps[0]]]]]
    square = lambda x, y, s: c((x, y), (x + s, y), (x + s, y + s), (x, y + s))
    tiles = spark.createDataFrame([("a", square(1, 0, 2)), ("b", square(7, 7, 3)), ("b", square(70, 70, 3)), ("c", square(6, 6, 1)), ("d", None)], f"tile_id string, geom {G.TYPE}")
    parts = [c((0, 0), (10, 0), (0, 10)), *[square(1 + i / 100, 0, 1) for i in range(50)], square(9.9, 9.9, 1), None]
    found = T.intersecting_tiles(tiles, spark.createDataFrame([(p,) for p in parts], f"geom {G.TYPE}")).collect()
    assert sorted((r["tile_id"], r["geom"][0][0][0]["x"]) for r in found) == [("a", 1.0), ("b", 7.0), ("b", 70.0)]
    assert seen["tile-pairs"] == 54 and seen["tile-hits"] == 1


def test_the_report_hashes_its_pixels(spark):
    from tests.test_queries import SF

    plan = QUERIES["tile_report"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" in plan and "SortAggregate" not in plan and "max(" in plan


def test_rings_leave_the_rounds_when_they_are_known(spark, monkeypatch):
    from pyspark.sql import functions as F

    from tilth.operators import polygons

    paths, fresh = [], polygons.scratch_path
    monkeypatch.setattr(polygons, "scratch_path", lambda s, tag: paths.append(fresh(s, tag)) or paths[-1])
    lengths = [1, 2, 3, 5, 8, 200] + [4] * 300
    links, want, node = [], {}, 0
    for n in lengths:
        keys = [(i * 7 + node) % n for i in range(n)] if n % 7 else list(range(n))
        for i in range(n):
            links.append((node + i, node + (i + 1) % n, keys[i] + 10 * node))
            want[node + i] = (min(keys) + 10 * node, (keys.index(min(keys)) - i) % n)
        node += n
    got = polygons.ring_places(spark.createDataFrame(links, "node long, next long, key long")).collect()
    assert len(got) == node and {r["node"]: (r["first"], r["steps"]) for r in got} == want
    left = [spark.read.schema("node long, done int").parquet(p).filter("done = 1").count() for p in paths]
    assert sum(left) == node and sum(left[:5]) == node - 200 and sum(left[3:]) < 220


def test_parcels_as_runs(spark):
    import numpy as np

    from tilth.operators import parcels, polygons

    rng = np.random.default_rng(11)
    pixels = spark.createDataFrame([(r, x, y, int(rng.integers(0, 2))) for r in ("a", "b") for x in range(14) for y in range(9)], "raster_id string, px long, py long, label int").persist()
    runs = parcels.parcel_runs(pixels).selectExpr("raster_id", "parcel", "py", "start", "end + 1 as stop")
    whole = parcels.segments(pixels)
    assert sorted(map(tuple, runs.collect())) == sorted(map(tuple, polygons.pixel_runs(whole, ["raster_id"]).collect()))
    assert sorted(map(str, polygons.run_polygons(runs).collect())) == sorted(map(str, polygons.polygons(whole).collect()))
    assert sorted((r["raster_id"], r["parcel"], r["area"]) for r in polygons.run_polygons(runs).collect()) == sorted(map(tuple, whole.groupBy("raster_id", "parcel").count().collect()))
