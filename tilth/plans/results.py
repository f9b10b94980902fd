"""Queries on manifests, scalar functions, sources and sinks."""

from __future__ import annotations

import json
import sqlite3
import struct
import tempfile

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tilth.functions import scalars as S
from tilth.operators import geometry as G
from tilth.operators import manifest as M
from tilth.operators import tiles as T
from tilth.plans.discovery import aoi, fields, tiles
from tilth.plans.fixtures import fixture, oracle
from tilth.plans.registry import query
from tilth.scratch import scratch_path
from tilth.sinks import results as K
from tilth.sources import vectors as V
from tilth.sources.collections import read_collection
from tilth.sources.gpkg import read_gpkg

_c = F.col


@query(oracle("select distinct source, tile_id from fx_fields", "fx_fields"))
def tile_from_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_fields").select("source", S.tile_of(_c("source")).alias("tile_id")).distinct()


@query(oracle("select tile_id, n, case when cast(substr(tile_id, 2) as int) % 3 > 0 then concat('/sr/', tile_id, '.tif') end as path from (select tile_id, count(*) as n from fx_fields group by tile_id) f", "fx_fields"))
def summary_with_raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = fixture(spark, sf_dir, "fx_fields").groupBy("tile_id").agg(F.count(F.lit(1)).alias("n"))
    rasters = fixture(spark, sf_dir, "fx_tiles").filter("cast(substr(tile_id, 2) as int) % 3 > 0").select("tile_id", F.concat(F.lit("/sr/"), "tile_id", F.lit(".tif")).alias("path"))
    return M.with_raster(n, rasters)


_FORMATS = "concat(' GeoJSON,', case when c_custkey % 2 = 0 then 'kml, ' else ',' end, case when c_custkey % 3 = 0 then 'KML,csv' else 'geojson' end)"


@query(oracle(f"select c_custkey, array_to_string(list_sort(list_distinct([lower(trim(x)) for x in string_split({_FORMATS}, ',') if trim(x) <> ''])), '|') as formats, list_contains([lower(trim(x)) for x in string_split({_FORMATS}, ',')], 'kml') as kml from customer"))
def export_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = fixture(spark, sf_dir, "customer").select("c_custkey", S.formats(F.expr(_FORMATS)).alias("f"))
    return c.select("c_custkey", F.array_join(F.array_sort("f"), "|").alias("formats"), F.array_contains("f", "kml").alias("kml"))


@query(oracle("select distinct source, concat(tile_id, case when source like '%.simp.gpkg' then '.simp' else '' end, '_parcels') as base, concat('/out/', tile_id, '/', tile_id, case when source like '%.simp.gpkg' then '.simp' else '' end, '_parcels') as folder from fx_fields", "fx_fields"))
def export_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = S.base_name(_c("source"), F.lit("parcels"))
    f = fixture(spark, sf_dir, "fx_fields").select("source", base.alias("base"), F.concat_ws("/", F.lit("/out"), S.tile_of(_c("source")), base).alias("folder"))
    return f.distinct()


@query(oracle("select tile_id, concat('/m/', tile_id) as mosaic, case when cast(substr(tile_id, 2) as int) % 2 = 0 then concat('/k/', tile_id) end as mask, concat('/s/', tile_id) as sr from fx_tiles", "fx_tiles"))
def stage_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixture(spark, sf_dir, "fx_tiles")
    at = lambda head: t.select("tile_id", F.concat(F.lit(head), "tile_id").alias("path"))
    return M.staged(t, mosaic=at("/m/"), mask=at("/k/").filter("cast(substr(tile_id, 2) as int) % 2 = 0"), sr=at("/s/"))


@query(oracle("select user_id as key, max_by(path, concat(cast(ts as string), path)) as path from (select user_id, ts, concat('/o/', cast(event_id as string)) as path, min(ts) over (partition by user_id) + interval 10 minute as started from events) e where ts >= started - interval 5 second group by user_id"))
def latest_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = fixture(spark, sf_dir, "events")
    files = e.select(_c("user_id").alias("key"), _c("ts").alias("modified"), F.concat(F.lit("/o/"), _c("event_id").cast("string")).alias("path"))
    started = files.groupBy("key").agg((F.min("modified") + F.expr("interval 10 minutes")).alias("started"))
    return M.latest_output(files, started)


@query(oracle("select tile_id from fx_tiles where tile_id not in (select tile_id from fx_fields)", "fx_tiles", "fx_fields"))
def pending_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.pending(fixture(spark, sf_dir, "fx_tiles").select("tile_id"), fixture(spark, sf_dir, "fx_fields"))


@query(oracle("select run_id, step, last.status as status, cast(last.started_at as string) as started_at, round(last.duration_seconds, 3) as duration_seconds, last.seq as seq, events, failures from (select run_id, step, max_by(s, s.seq) as last, count(*) as events, count(*) filter (s.status = 'failed') as failures from fx_steps s group by run_id, step) l", "fx_steps"))
def step_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = M.ledger(fixture(spark, sf_dir, "fx_steps"))
    return out.withColumn("started_at", _c("started_at").cast("string"))


@query(oracle("select p_partkey, array_to_string([trim(x) for x in string_split(concat(' ', p_name, ' ,, ', p_brand, ','), ',') if trim(x) <> ''], '|') as items from part"))
def parse_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fixture(spark, sf_dir, "part")
    return p.select("p_partkey", F.array_join(S.parse_csv(F.concat(F.lit(" "), "p_name", F.lit(" ,, "), "p_brand", F.lit(","))), "|").alias("items"))


@query(oracle("select p_partkey, p_partkey + p_size as total from part"))
def parse_int_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fixture(spark, sf_dir, "part")
    items = S.parse_int_csv(F.concat(_c("p_partkey").cast("string"), F.lit(" , ,"), _c("p_size").cast("string")))
    return p.select("p_partkey", F.aggregate(items, F.lit(0).cast("long"), lambda acc, x: acc + x).alias("total"))


@query(oracle("select o_orderkey, cast(cast(o_orderdate as date) as string) as day from orders"))
def parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = fixture(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("text"))
    return o.select("o_orderkey", S.parse_date(_c("text")).cast("string").alias("day"))


@query(oracle("select tile_id from fx_tiles order by tile_id", "fx_tiles"))
def sink_tile_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as CSV and read again."""
    path = scratch_path(spark, "tiles-csv")
    K.write_tile_csv(fixture(spark, sf_dir, "fx_tiles"), path)
    return spark.read.schema("tile_id string").csv(path, header=True)


_COUNTS = "select source, tile_id, count(*) as feature_count from fx_fields group by source, tile_id"


@query(oracle(f"select source, 'parcels' as layer, 'EPSG:4326' as crs, cast(feature_count as string) as feature_count, '' as total_area_ha, case when feature_count % 2 = 0 then cast(feature_count as string) else '' end as median_area_ha from ({_COUNTS}) c", "fx_fields"))
def sink_summary_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as CSV and read again."""
    s = _counts(spark, sf_dir).withColumns({"layer": F.lit("parcels"), "crs": F.lit("EPSG:4326"), "median_area_ha": F.when(_c("feature_count") % 2 == 0, _c("feature_count")), "extra": F.lit(1)})
    path = scratch_path(spark, "summary-csv")
    K.write_summary_csv(s, path)
    return spark.read.schema(", ".join(f"{c} string" for c in K.SUMMARY_COLUMNS)).option("emptyValue", "").csv(path, header=True).na.fill("")


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "fx_fields").groupBy("source", "tile_id").agg(F.count(F.lit(1)).alias("feature_count"))


def _exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _counts(spark, sf_dir)
    path = lambda kind: F.concat(F.lit("/out/"), "tile_id", F.lit(f"/{kind}"))
    some = lambda k, kind: F.when(_c("feature_count") % k == 0, path(kind))
    made = F.create_map(F.lit("geojson"), path("p.geojson"), F.lit("kml"), some(2, "p.kml"), F.lit("summary"), path("s.json"), F.lit("overlay"), some(3, "o.png"), F.lit("boundaries"), path("b.png"))
    return n.withColumns({"exports": made, "total_area_ha": F.when(_c("feature_count") % 5 > 0, _c("feature_count") * 12.25)})


@query(
    oracle(
        f"""select concat(tile_id, case when source like '%.simp.gpkg' then '.simp' else '' end) as title,
                   concat(tile_id, case when feature_count % 3 = 0 then '/o.png' else '/b.png' end) as image,
                   concat('GeoJSON: ', tile_id, '/p.geojson', case when feature_count % 2 = 0 then concat(';KML: ', tile_id, '/p.kml') else '' end, ';Summary: ', tile_id, '/s.json') as links,
                   concat(format('{{:,}}', feature_count), ' features', case when feature_count % 5 > 0 then concat(' | ', format('{{:,.1f}}', feature_count * 12.25e0), ' ha') else '' end) as text
            from ({_COUNTS}) c""",
        "fx_fields",
    )
)
def gallery_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.cards(_exports(spark, sf_dir), "/out").withColumn("links", F.array_join("links", ";"))


#: The summary of each result file as a JSON object.
_OBJECTS = f"""select '{{"source":"' || source || '","tile_id":"' || tile_id || '","feature_count":' || feature_count
                   || ',"exports":{{"geojson":"/out/' || tile_id || '/p.geojson","kml":' || case when feature_count % 2 = 0 then '"/out/' || tile_id || '/p.kml"' else 'null' end
                   || ',"summary":"/out/' || tile_id || '/s.json","overlay":' || case when feature_count % 3 = 0 then '"/out/' || tile_id || '/o.png"' else 'null' end
                   || ',"boundaries":"/out/' || tile_id || '/b.png"}},"total_area_ha":' || case when feature_count % 5 > 0 then cast(feature_count * 12.25e0 as varchar) else 'null' end || '}}' as value
            from ({_COUNTS}) c"""


@query(oracle(_OBJECTS, "fx_fields"))
def sink_summary_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.summary_json(_exports(spark, sf_dir))


@query(oracle(f"""select '{{"exports": [' || chr(10) || string_agg(value, chr(10) || ',' order by value) || chr(10) || ']}}' as value from ({_OBJECTS}) o""", "fx_fields"))
def sink_exports_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list of all summaries as one document, written and read again."""
    path = scratch_path(spark, "exports-json")
    K.write_exports_json(_exports(spark, sf_dir), path)
    return spark.read.text(path, wholetext=True).select(F.regexp_replace("value", r"\n$", "").alias("value"))


@query(
    oracle(
        """select run_id, '{"run_id":' || run_id || ',"status":"' || case when sum(failures) > 0 then 'failed' else 'completed' end || '","steps":['
             || string_agg('{"name":"' || step || '","status":"' || status || '","started_at":"' || strftime(started_at, '%Y-%m-%dT%H:%M:%S') || '","duration_seconds":' || cast(round(duration_seconds, 3) as varchar) || '}', ',' order by started_at, seq) || ']}' as value
           from (select *, row_number() over (partition by run_id, step order by seq desc) as n, count(*) filter (status = 'failed') over (partition by run_id, step) as failures from fx_steps) s
           where n = 1 group by run_id""",
        "fx_steps",
    )
)
def run_summary_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.run_summaries(M.ledger(fixture(spark, sf_dir, "fx_steps")))


@query(oracle("select source, cast(field_id as string) as name, x0 || ',' || y0 as first, 5 as points from fx_fields union all select distinct source, 'head', '', 0 from fx_fields union all select distinct source, 'tail', '', 0 from fx_fields", "fx_fields"))
def sink_kml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document for each result file, written and read again by lines."""
    path = scratch_path(spark, "fields-kml")
    K.write_kml(fields(spark, sf_dir), path, "field_id")
    lines = spark.read.text(path)
    head, tail = (F.split(F.lit(x), "\n") for x in (K.KML_HEAD, K.KML_TAIL))
    name = F.when(_c("value") == F.element_at(head, -1), "head").when(_c("value") == F.element_at(tail, -1), "tail").otherwise(F.regexp_extract("value", "<name>(.*)</name>", 1))
    points = F.split(F.regexp_extract("value", "<coordinates>(.*)</coordinates>", 1), " ")
    mark = F.startswith("value", F.lit("<Placemark>"))
    lines = lines.filter(~F.startswith("value", F.lit("<?xml")))
    return lines.select("source", name.alias("name"), F.when(mark, F.get(points, F.lit(0))).otherwise("").alias("first"), F.when(mark, F.size(points)).otherwise(0).alias("points"))


@query(oracle("select aoi_id, kind = 'polygon' as has_geometry, case when kind = 'polygon' then cx - h end as minx, case when kind = 'polygon' then cy + h end as maxy from fx_aoi", "fx_aoi"))
def src_geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The AOI written as one feature per line and read again."""
    path = scratch_path(spark, "aoi-geojson")
    K.write_geojson(aoi(spark, sf_dir), path, ["aoi_id"])
    read = V.read_geojson(spark, path, lines=True)
    b = G.bounds(_c("geom"))
    return read.select(_c("properties")["aoi_id"].cast("long").alias("aoi_id"), _c("geom").isNotNull().alias("has_geometry"), b["minx"].alias("minx"), b["maxy"].alias("maxy"))


@query(oracle("""select tile_id, '{"type":"Feature","properties":{"tile_id":"' || tile_id || '"},"geometry":{"type":"Polygon","coordinates":[[[' || minx || ',' || miny || '],[' || maxx || ',' || miny || '],[' || maxx || ',' || maxy || '],[' || minx || ',' || maxy || '],[' || minx || ',' || miny || ']]]}}' as value from fx_tiles""", "fx_tiles"))
def sink_geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.features(tiles(spark, sf_dir), ["tile_id"]).select("tile_id", "value")


@query(oracle("select field_id, x0 as minx, y0 as miny, 5 as points from fx_fields", "fx_fields"))
def src_wkt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields written as lines of WKT under their tile and read again."""
    path = scratch_path(spark, "fields-wkt")
    text = F.expr("concat('polygon ((', x0, ' ', y0, ', ', x0 + w, ' ', y0, ', ', x0 + w, ' ', y0 + w, ', ', x0, ' ', y0 + w, ', ', x0, ' ', y0, '))')")
    fixture(spark, sf_dir, "fx_fields").select("field_id", text.alias("value")).write.csv(path, sep="\t", quote="")
    g = V.read_wkt(spark, path, column="wkt", schema="field_id long, wkt string")
    b = G.bounds(_c("geom"))
    return g.select("field_id", b["minx"].alias("minx"), b["miny"].alias("miny"), F.size(G.points(_c("geom"))).alias("points"))


@query(oracle(r"""select field_id, tile_id, '}{"a\' || cast(field_id as string) || '"],[' as label, x0 as minx, y0 + w as maxy from fx_fields""", "fx_fields"))
def src_geojson_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields written as a feature collection per tile, with brackets and quotes in strings, and read in splits."""
    path = scratch_path(spark, "collections")
    f = fields(spark, sf_dir).select("tile_id", "field_id", F.concat(F.lit('}{"a\\'), _c("field_id").cast("string"), F.lit('"],[')).alias("label"), "geom")
    lines = K.features(f, ["field_id", "label"])
    by = Window.partitionBy("tile_id").orderBy("field_id")
    # head and tail go with a tile's first and last feature, so that no other rows must reach its file
    head = F.when(F.row_number().over(by) == 1, '{"type":"FeatureCollection","crs":{"name":"}]\\""},"bbox":[1,2],"features":[\n').otherwise(",")
    tail = F.when(F.lead("field_id").over(by).isNull(), '\n],"more":[{"type":"x"}]}').otherwise("")
    lines = lines.select("tile_id", "field_id", F.concat(head, "value", tail).alias("value"))
    lines.repartition("tile_id").sortWithinPartitions("tile_id", "field_id").select("tile_id", "value").write.partitionBy("tile_id").text(path)
    b = G.bounds(_c("geom"))
    out = read_collection(spark, path).select(F.regexp_extract("file", "tile_id=([^/]*)/", 1).alias("tile_id"), _c("properties.field_id").cast("long").alias("field_id"), _c("properties.label").alias("label"), b["minx"].alias("minx"), b["maxy"].alias("maxy"))
    return out


def _gpkg_file(path: str, rows: list[tuple]) -> None:
    """A GeoPackage of (id, x0, y0, x1, y1) boxes with its rtree."""
    with sqlite3.connect(path) as db:
        db.execute("create table gpkg_geometry_columns (table_name text, column_name text, srs_id integer)")
        db.execute("insert into gpkg_geometry_columns values ('parcels', 'geom', 4326)")
        db.execute("create table parcels (fid integer primary key, name text, geom blob)")
        db.execute("create virtual table rtree_parcels_geom using rtree(id, minx, maxx, miny, maxy)")
        for i, (name, x0, y0, x1, y1) in enumerate(rows, 1):
            ring = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
            blob = b"GP\x00\x01" + struct.pack("<i", 4326) + struct.pack("<BIII", 1, 3, 1, 5) + b"".join(struct.pack("<dd", *p) for p in ring)
            db.execute("insert into parcels values (?, ?, ?)", (i, str(name), blob))
            db.execute("insert into rtree_parcels_geom values (?, ?, ?, ?, ?)", (i, x0, x1, y0, y1))


def _write_gpkg(folder: str):
    """Each group of rows as a file, made beside the worker and sent to the store."""

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        with tempfile.TemporaryDirectory() as own:
            _gpkg_file(f"{own}/x.gpkg", list(pdf[["id", "minx", "miny", "maxx", "maxy"]].itertuples(index=False, name=None)))
            files, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
            files.create_dir(root, recursive=True)
            with open(f"{own}/x.gpkg", "rb") as source, files.open_output_stream(f"{root}/{pdf['part'].iloc[0]}.gpkg") as out:
                while some := source.read(1 << 20):
                    out.write(some)
        return pd.DataFrame({"path": [f"{folder}/{pdf['part'].iloc[0]}.gpkg"]})

    return write


def _gpkg(spark: SparkSession, rows: DataFrame, tag: str) -> str:
    """A folder of GeoPackages, one for each ``part`` of (part, id, box)."""
    folder = scratch_path(spark, tag)
    rows.groupBy("part").applyInPandas(_write_gpkg(folder), "path string").write.format("noop").mode("overwrite").save()
    return folder


@query(oracle("select field_id, x0 as minx, y0 as miny, x0 + w as maxx, y0 + w as maxy from fx_fields", "fx_fields"))
def src_gpkg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields written to a GeoPackage per tile and read through the data source."""
    f = fixture(spark, sf_dir, "fx_fields").selectExpr("tile_id as part", "field_id as id", "x0 as minx", "y0 as miny", "x0 + w as maxx", "y0 + w as maxy")
    return read_gpkg(spark, _gpkg(spark, f, "fields-gpkg")).select(_c("id").cast("long").alias("field_id"), "minx", "miny", "maxx", "maxy")


@query(oracle("select tile_id, minx, miny, maxx, maxy from fx_tiles where maxx >= 2.5 and minx <= 6.25 and maxy >= 41 and miny <= 43.75", "fx_tiles"))
def src_gpkg_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles written to GeoPackages of 1000 and read by their box, which reaches the rtree of each file."""
    t = fixture(spark, sf_dir, "fx_tiles").withColumns({"part": F.xxhash64("tile_id") % F.greatest(F.lit(1), F.ceil(F.lit(fixture(spark, sf_dir, "fx_tiles").count()) / 1000)), "id": _c("tile_id")})
    read = read_gpkg(spark, _gpkg(spark, t.select("part", "id", *T.BOX), "tiles-gpkg"))
    return T.bbox_scan(read, 2.5, 41.0, 6.25, 43.75).select(_c("id").alias("tile_id"), *T.BOX)


def _write_inputs(folder: str):
    """Each group of rows as a folder of small files."""

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        files, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        own = f"{root}/{pdf['part'].iloc[0]}"
        files.create_dir(own, recursive=True)
        for tile_id, x, y in pdf[["tile_id", "minx", "miny"]].itertuples(index=False, name=None):
            with files.open_output_stream(f"{own}/{tile_id}_{x:.0f}_{y:.0f}.json") as out:
                out.write(json.dumps({"minx": x, "miny": y}).encode())
        return pd.DataFrame({"files": [len(pdf)]})

    return write


@query(oracle("select concat(tile_id, '.json') as name from fx_tiles", "fx_tiles"))
def src_expand_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per tile, in folders of about 1000, found again through their folder and a glob of it."""
    path = scratch_path(spark, "inputs")
    t = fixture(spark, sf_dir, "fx_tiles").select("tile_id", "minx", "miny")
    t = t.withColumn("part", F.pmod(F.xxhash64("tile_id", "minx", "miny"), F.lit(t.count() // 1000 + 1)))
    t = t.repartition(4 * spark.sparkContext.defaultParallelism, "part")  # a number, as rows are few beside the work on their files
    t.groupBy("part").applyInPandas(_write_inputs(path), "files long").write.format("noop").mode("overwrite").save()
    found = V.expand_inputs(spark, path, f"{path}/*/T000*", pattern="*.json")
    return found.select(F.concat(F.regexp_extract("path", r"([^/_]*)_[^/]*$", 1), F.lit(".json")).alias("name"))
