"""Chunk tables against pixel tables, and collections split inside a file."""

from __future__ import annotations

import json
from collections import Counter
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilth.operators import chunks, composite, parcels, raster
from tilth.operators import geometry as G
from tilth.sources import collections

c = F.col
OBS = "tile_id string, scene_id long, acquired date, px long, py long, b04 long, b03 long, b02 long, b08 long, valid boolean"


@pytest.fixture(scope="module")
def obs(spark):
    """Pixels never valid, without NDVI, missing in some scenes, and ties of NDVI and date."""
    rng = np.random.default_rng(3)
    rows = []
    for tile in ("A", "B"):
        for scene in range(7):
            for x in range(10):
                for y in range(6):
                    if rng.random() < 0.8:
                        bands = [int(v) for v in rng.integers(0, 3, 4)]
                        rows.append((tile, scene, date(2024, 1, 1 + scene // 2), x, y, *bands, bool(rng.random() < 0.6 and (x, y) != (9, 5))))
    return spark.createDataFrame(rows, OBS)


@pytest.fixture(scope="module")
def stacks(obs):
    return chunks.from_pixels(obs, ["tile_id", "scene_id", "acquired"], [*composite.BANDS, "valid"], 4, 4).persist()


def pixels(table, values):
    return chunks.to_pixels(table, ["tile_id"], values, 4, 4).filter(c(values[0]).isNotNull())


def same(a, b, names):
    rows = lambda d: Counter(tuple(None if r[n] is None else round(float(r[n]), 9) if n != "tile_id" else r[n] for n in names) for r in d.collect())
    assert rows(a) == rows(b)


def test_chunks_hold_the_pixels(obs, stacks):
    names = ["tile_id", "scene_id", "px", "py", *composite.BANDS]
    back = chunks.to_pixels(stacks, ["tile_id", "scene_id"], composite.BANDS, 4, 4).filter("b04 is not null")
    same(back, obs, names)
    assert stacks.filter(F.size("valid") != 16).count() == 0


def test_composites_of_chunks_equal_those_of_pixels(obs, stacks):
    best = chunks.OUTPUT[chunks.BestState]
    same(pixels(chunks.composite(stacks, chunks.BestState, 16), best), composite.max_ndvi(obs).filter("ndvi is not null"), ["tile_id", "px", "py", *best])
    same(pixels(chunks.composite(stacks, chunks.MeanState, 16), composite.BANDS), composite.mean(obs), ["tile_id", "px", "py", *composite.BANDS])
    ranks = composite.rank_scenes(obs)
    ranked = stacks.join(ranks.select("tile_id", "scene_id", "rank"), ["tile_id", "scene_id"])
    same(pixels(chunks.composite(ranked, chunks.FirstState, 16), chunks.OUTPUT[chunks.FirstState]), composite.first(obs, ranks), ["tile_id", "px", "py", *composite.BANDS, "scene_id"])
    assert chunks.composite(stacks.limit(0), chunks.MeanState, 16).count() == 0


@pytest.mark.parametrize("share,strip", [(0.5, 16), (0.25, 5), (1.0, 1)])
def test_quantiles_of_strips_equal_those_of_pixels(obs, stacks, share, strip):
    out = chunks.quantile_composite(stacks, share, 16, strip).select("tile_id", "cx", "cy", "strip", F.posexplode(F.arrays_zip(*composite.BANDS)).alias("i", "v"))
    at = c("strip") * strip + c("i")
    out = out.select("tile_id", (c("cx") * 4 + at % 4).alias("px"), (c("cy") * 4 + F.floor(at / 4)).alias("py"), "v.*").filter("b04 is not null")
    same(out, composite.percentile(obs, share * 100), ["tile_id", "px", "py", *composite.BANDS])


def test_states_are_bounded_and_merge(monkeypatch):
    monkeypatch.setattr(chunks, "HELD", 8)
    rows = [(("t", i % 3, 0), np.full((2, 2), float(i))) for i in range(9)]
    parts = list(chunks._states(iter(rows), chunks.MeanState.merge, whole=False))
    assert max(sum(s.size for _, s in p) for p in parts) <= 8
    total = Counter()
    for p in parts:
        for key, s in p:
            total[key] += s[0, 0]
    assert total == {("t", 0, 0): 9, ("t", 1, 0): 12, ("t", 2, 0): 15}
    assert [len(p) for p in chunks._states(iter(sorted(rows, key=lambda r: r[0])), chunks.MeanState.merge, whole=True)] == [1, 1, 1]


# -- clipping


def test_clipped_chunks_equal_clipped_pixels(spark):
    rng = np.random.default_rng(7)
    w, h = 37, 29
    vals = spark.createDataFrame([("r", x, y, float(rng.integers(1, 99))) for x in range(w) for y in range(h)], "raster_id string, px long, py long, value double").persist()
    meta = spark.createDataFrame([("r", 3.0, 40.0, 0.5, 0.25, w, h, -1.0, ["a"]), ("far", 0.0, 0.0, 1.0, 1.0, 4, 4, None, ["a", "b"]), ("none", 0.0, 0.0, 1.0, 1.0, 4, 4, None, [])], "raster_id string, ox double, oy double, rx double, ry double, width long, height long, nodata double, band_names array<string>")
    at = np.sort(rng.uniform(0, 2 * np.pi, 15))
    star = [(float(11 + 7 * r * np.cos(a)), float(36 + 3 * r * np.sin(a))) for a, r in zip(at, rng.uniform(0.4, 1, 15))]
    box = [(6.25, 37.125), (14.25, 37.125), (14.25, 38.875), (6.25, 38.875), (6.25, 37.125)]  # its edges run through centres
    hole = [(8.0, 37.6), (8.0, 38.2), (12.0, 38.2), (12.0, 37.6), (8.0, 37.6)]
    for parts in ([[[star + star[:1]]]], [[[box, hole]]], [[[[(4.0, 34.0), (20.0, 34.0), (20.0, 39.9), (4.0, 39.9), (4.0, 34.0)]]]]):
        rows = [("r", g) for g in parts] + [("far", [[[(50.0, 50.0), (51.0, 50.0), (50.0, 51.0), (50.0, 50.0)]]])]
        aoi = spark.createDataFrame(rows, f"raster_id string, geom {G.TYPE}")
        tiles = chunks.from_pixels(vals.withColumn("band", F.lit(1)), ["raster_id", "band"], ["value"], 8, 8).withColumnRenamed("value", "values")
        got = chunks.clip(tiles, meta, aoi, 8, 8).withColumn("values", F.coalesce("values", F.array_repeat(F.lit(-1.0), 64)))
        got = chunks.to_pixels(got, ["x0", "y0"], ["values"], 8, 8)
        head = {r["raster_id"]: r for r in chunks.clipped_meta(meta, aoi).collect()}
        own = head["r"]
        have = {(r["px"] - r["x0"], r["py"] - r["y0"]): r["values"] for r in got.collect() if 0 <= r["px"] - r["x0"] < own["width"] and 0 <= r["py"] - r["y0"] < own["height"]}
        want = {(r["px"], r["py"]): r["value"] for r in raster.clip(vals, meta.filter("raster_id = 'r'"), aoi).collect()}
        assert have == want and len(set(have.values())) > 2
        assert (max(x for x, _ in want) + 1, max(y for _, y in want) + 1) == (own["width"], own["height"]) and own["problem"] is None
        assert head["far"]["problem"] == "the AOI does not overlap the raster" and head["far"]["width"] is None and head["far"]["band_names"] == ["a", "b"]
        assert head["none"]["problem"] == "no AOI"


def test_whole_chunks_are_passed_without_their_pixels(spark):
    vals = spark.range(64 * 64).select(F.lit("r").alias("raster_id"), F.lit(1).alias("band"), (c("id") % 64).alias("px"), F.floor(c("id") / 64).alias("py"), c("id").cast("double").alias("value"))
    tiles = chunks.from_pixels(vals, ["raster_id", "band"], ["value"], 8, 8).withColumnRenamed("value", "values")
    meta = spark.createDataFrame([("r", 0.0, 64.0, 1.0, 1.0, 64, 64, None)], "raster_id string, ox double, oy double, rx double, ry double, width long, height long, nodata double")
    frame = [[[(0.0, 0.0), (64.0, 0.0), (64.0, 64.0), (0.0, 64.0), (0.0, 0.0)], [(12.0, 12.0), (12.0, 52.0), (52.0, 52.0), (52.0, 12.0), (12.0, 12.0)]]]
    out = chunks.clip(tiles, meta, spark.createDataFrame([("r", frame)], f"raster_id string, geom {G.TYPE}"), 8, 8).collect()
    assert len(out) == 64 and sum(r["values"] is None for r in out) == 16  # the chunks in the hole
    whole = {(r["cx"], r["cy"]): list(r["values"]) for r in tiles.collect()}
    assert sum(r["values"] is not None and list(r["values"]) == whole[r["cx"], r["cy"]] for r in out) == 28


# -- parcels


def test_chunked_parcels_equal_those_of_pixels(spark):
    rng = np.random.default_rng(11)
    grids = {"a": rng.integers(0, 3, (19, 23)), "b": (rng.random((16, 16)) < 0.65).astype(int), "c": np.ones((9, 9), int)}
    snake = np.zeros((15, 15), int)
    snake[::2], snake[1::4, -1], snake[3::4, 0] = 1, 1, 1
    grids["snake"] = snake
    rows = [(k, x, y, int(g[y, x])) for k, g in grids.items() for y in range(g.shape[0]) for x in range(g.shape[1]) if g[y, x]]
    p = spark.createDataFrame(rows, "raster_id string, px long, py long, label int")
    want = {(r["raster_id"], r["px"], r["py"]): r["parcel"] for r in parcels.segments(p).collect()}
    got = chunks.to_pixels(chunks.segments(chunks.from_pixels(p, ["raster_id"], ["label"], 5, 4), 5, 4), ["raster_id"], ["parcel"], 5, 4).filter("parcel is not null")
    assert {(r["raster_id"], r["px"], r["py"]): r["parcel"] for r in got.collect()} == want
    assert chunks.segments(chunks.from_pixels(p.limit(0), ["raster_id"], ["label"], 5, 4), 5, 4).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_roots_of_a_block(seed):
    rng = np.random.default_rng(seed)
    block = rng.integers(-1, 2, (13, 17))
    got = chunks._roots(block)
    seen = np.full(block.shape, -1)
    for y in range(13):
        for x in range(17):
            if block[y, x] >= 0 and seen[y, x] < 0:
                todo = [(y, x)]
                while todo:
                    a, b = todo.pop()
                    if 0 <= a < 13 and 0 <= b < 17 and seen[a, b] < 0 and block[a, b] == block[y, x]:
                        seen[a, b] = y * 17 + x
                        todo += [(a + 1, b), (a - 1, b), (a, b + 1), (a, b - 1)]
    assert (got == seen).all()


def test_only_borders_enter_the_components(spark):
    sides = spark.createDataFrame([("r", 3, 1, 1, 7), ("r", 4, 1, 1, 9), ("r", 4, 2, 2, 5), ("r", 3, 2, 1, 7), ("s", 4, 1, 1, 8)], "raster_id string, px long, py long, label int, node long")
    assert [tuple(r) for r in chunks.border_links(sides, 4, 4).collect()] == [("r", 7, 9)]


# -- collections


def feature(i: int, name: str, extra: dict | None = None) -> dict:
    return {"type": "Feature", "properties": {"name": name, **(extra or {})}, "geometry": {"type": "Polygon", "coordinates": [[[i, 0, 5], [i + 1, 0], [i, 1], [i, 0, 5]]]}}


NAMES = ["plain", 'quote " here', "back\\slash", "}{][", '\\"}', "é漢\U0001f600", "", "line\nfeed", '"}]}', "x" * 900]


@pytest.fixture()
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda n: [spark.conf.set(k, str(n)) for k in old]
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("indent,size", [(None, 450), (2, 1200), (None, 1 << 20)])
def test_one_file_in_many_splits(spark, tmp_path, small_splits, indent, size):
    own = [feature(i, NAMES[i % len(NAMES)], {"n": str(i), "o": "{" * (i % 3)}) for i in range(60)]
    body = {"bbox": [0, 1], "note": {"a": [{"type": "x}"}]}, "type": "FeatureCollection", "features": own, "more": [{"type": "No"}]}
    (tmp_path / "a.geojson").write_text(json.dumps(body, indent=indent, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "b.geojson").write_text(json.dumps({"features": own[:1], "type": "FeatureCollection"}))
    small_splits(size)
    found = collections.collection_features(spark, str(tmp_path))
    got = Counter((r["file"][-9:], json.dumps(json.loads(r["text"]), sort_keys=True)) for r in found.collect())
    assert got == Counter(("a.geojson", json.dumps(f, sort_keys=True)) for f in own) + Counter([("b.geojson", json.dumps(own[0], sort_keys=True))])
    blocks = collections._records(spark, str(tmp_path / "a.geojson")).select("block").distinct().count()
    assert blocks > 5 if size < 2000 else blocks == 1
    geoms = collections.read_collection(spark, str(tmp_path / "a.geojson")).collect()
    assert sorted(r["properties"]["name"] for r in geoms) == sorted(f["properties"]["name"] for f in own) and all(len(r["geom"][0][0]) == 4 for r in geoms)


def test_aoi_guards(spark, tmp_path):
    write = lambda name, text: (tmp_path / name).write_text(text) and str(tmp_path / name)
    with pytest.raises(FileNotFoundError, match="AOI not found"):
        collections.load_aoi(spark, str(tmp_path / "no.geojson"))
    with pytest.raises(ValueError, match="no features"):
        collections.load_aoi(spark, write("e.geojson", '{"type":"FeatureCollection","features":[]}'))
    with pytest.raises(ValueError, match="no valid geometries"):
        collections.load_aoi(spark, write("p.geojson", '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{},"geometry":{"type":"Point","coordinates":[1,2]}},{"type":"Feature","properties":null,"geometry":null}]}'))
    good = collections.load_aoi(spark, write("g.geojson", json.dumps({"type": "FeatureCollection", "features": [feature(1, "a"), {"type": "Feature", "properties": {}, "geometry": None}]})))
    assert [(r["srid"], len(r["geom"])) for r in good.collect()] == [(4326, 1)]
    assert collections.load_aoi(spark, write("g.wkt", "\n POLYGON ((0 0, 1 0, 0 1, 0 0))\n")).first()["geom"][0][0][1] == (1.0, 0.0)
    with pytest.raises(ValueError, match="no valid geometries"):
        collections.load_aoi(spark, write("l.txt", "LINESTRING (0 0, 1 1)"))


# -- larger tables


def test_states_are_made_and_merged_by_the_batch(obs, stacks):
    class Counted(chunks.BestState):
        calls = 0

        @classmethod
        def score(cls, *args):
            cls.calls += 1
            if cls.calls > 3:
                raise ValueError("a call per row")
            return chunks.BestState.score(*args)

    chunks.OUTPUT[Counted] = best = chunks.OUTPUT[chunks.BestState]
    try:
        same(pixels(chunks.composite(stacks.coalesce(1), Counted, 16), best), composite.max_ndvi(obs).filter("ndvi is not null"), ["tile_id", "px", "py", *best])
    finally:
        del chunks.OUTPUT[Counted]


@pytest.mark.parametrize("method", [chunks.BestState, chunks.MeanState])
def test_folds_equal_pairwise_merges(method):
    rng = np.random.default_rng(5)
    states = rng.integers(0, 3, (60, 7 if method is chunks.BestState else 5, 4)).astype(float)
    states[:, 0][rng.random((60, 4)) < 0.2] = -np.inf if method is chunks.BestState else 0
    first = np.array([0, 1, 2, 30, 59])
    for folded, lo, hi in zip(method.fold(states, first), first, [*first[1:], 60], strict=True):
        want = states[lo]
        for s in states[lo + 1 : hi]:
            want = method.merge(want, s)
        np.testing.assert_array_equal(folded, want)


def test_chunks_are_filled_without_lists_of_pixels(spark, obs):
    table = chunks.from_pixels(obs, ["tile_id", "scene_id", "acquired"], [*composite.BANDS, "valid"], 4, 4)
    assert "collect_list" not in table._jdf.queryExecution().optimizedPlan().toString()
    rows = [("r", x, y, None if x == y else x * 1000 + y) for x in range(150) for y in range(3, 100)]  # chunks that go on over batches
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = chunks.from_pixels(spark.createDataFrame(rows, "raster_id string, px long, py long, value int"), ["raster_id"], ["value"], 64, 5)
        found = found.collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    want = {(x, y): v for _, x, y, v in rows}
    assert len(found) == 3 * 20 and found[0].asDict().keys() == {"raster_id", "cx", "cy", "value"}
    for r in found:
        assert r["value"] == [want.get((r["cx"] * 64 + i % 64, r["cy"] * 5 + i // 64)) for i in range(320)]
    with pytest.raises(Exception, match="pixel twice"):
        chunks.from_pixels(spark.createDataFrame([rows[1], rows[1]], "raster_id string, px long, py long, value int"), ["raster_id"], ["value"], 64, 5).collect()
