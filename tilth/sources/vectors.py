"""Vector sources: GeoJSON, WKT, and lists of input files."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from fnmatch import fnmatchcase
from functools import reduce
from itertools import islice

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilth.operators import geometry as G
from tilth.scratch import materialize

_RING = "array<array<double>>"
#: Coordinates are kept as text and read by type, since their depth depends on it.
FEATURE = "struct<type:string,properties:map<string,string>,geometry:string>"
COLLECTION = f"struct<type:string,features:array<{FEATURE}>>"
DEPTH = 3


def _points(polygons: Column) -> Column:
    """array of polygons of rings of [x, y, ...] to geom; heights are dropped."""
    return F.transform(polygons, lambda poly: F.transform(poly, lambda ring: F.transform(ring, lambda p: G.point(F.get(p, F.lit(0)), F.get(p, F.lit(1))))))


def _schema(depth: int) -> str:
    members = f",geometries:array<{_schema(depth - 1)}>" if depth else ""
    return f"struct<type:string,coordinates:string{members}>"


def _one(g: Column, depth: int) -> Column:
    """The polygons of a parsed GeoJSON geometry; collections down to ``depth``."""
    polygon = F.array(F.from_json(g["coordinates"], f"array<{_RING}>"))
    multi = F.from_json(g["coordinates"], f"array<array<{_RING}>>")
    out = F.when(g["type"] == "Polygon", _points(polygon)).when(g["type"] == "MultiPolygon", _points(multi))
    if depth:
        nested = F.flatten(F.filter(F.transform(g["geometries"], lambda m: _one(m, depth - 1)), lambda x: x.isNotNull()))
        out = out.when(g["type"] == "GeometryCollection", nested)
    return out.otherwise(F.lit(None).cast(G.TYPE))


def geojson_geometry(text: Column, depth: int = DEPTH) -> Column:
    """geom of a GeoJSON geometry; null if it has no polygon.

    Collections in collections are read down to ``depth`` levels.  The text is parsed once, and the polygons are made once.
    """
    made = F.transform(F.array(F.from_json(text, _schema(depth))), lambda g: _one(g, depth))
    return F.get(F.filter(made, lambda g: F.size(g) > 0), F.lit(0))


def read_geojson(spark: SparkSession, path: str, *, lines: bool = False) -> DataFrame:
    """(properties, geom, srid) of feature collections, or of one feature per line.

    The second form is split inside a file, so it is the one for large layers.
    Features without a polygon have a null geom.
    """
    if lines:
        f = spark.read.text(path).select(F.from_json("value", FEATURE).alias("f"))
    else:
        f = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", COLLECTION)["features"]).alias("f"))
    return f.select(F.col("f.properties").alias("properties"), geojson_geometry(F.col("f.geometry")).alias("geom"), F.lit(4326).alias("srid"))


def wkt_geometry(text: Column) -> Column:
    """geom of POLYGON and MULTIPOLYGON text; null for other types."""
    t = F.upper(F.trim(text))
    kind = F.regexp_extract(t, r"^(MULTIPOLYGON|POLYGON)\s*(?:Z|M|ZM)?\s*\(", 1)
    body = F.regexp_replace(F.regexp_replace(t, r"^[A-Z ]*\(", ""), r"\)\s*$", "")
    body = F.when(kind == "POLYGON", F.concat(F.lit("("), body, F.lit(")"))).otherwise(body)
    polygons = F.split(F.regexp_replace(body, r"^\s*\(\s*\(|\)\s*\)\s*$", ""), r"\)\s*\)\s*,\s*\(\s*\(")
    rings = F.transform(polygons, lambda p: F.transform(F.split(p, r"\)\s*,\s*\("), lambda r: F.transform(F.split(r, ","), lambda q: F.split(F.trim(q), r"\s+"))))
    geom = F.transform(rings, lambda poly: F.transform(poly, lambda ring: F.transform(ring, lambda q: G.point(F.get(q, F.lit(0)).try_cast("double"), F.get(q, F.lit(1)).try_cast("double")))))
    return F.when(kind != "", geom)


def read_wkt(spark: SparkSession, path: str, *, column: str | None = None, schema: str = "") -> DataFrame:
    """(path, geom, srid) of text files with one geometry each.

    With a ``column``, the files are tab-separated tables with that column of geometries, and
    the other columns of ``schema`` are kept; such files are split, so it is the form for large layers.
    """
    if column is None:
        return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), wkt_geometry(F.col("value")).alias("geom"), F.lit(4326).alias("srid"))
    rows = spark.read.schema(schema).csv(path, sep="\t", quote="")
    return rows.select(*[c for c in rows.columns if c != column], wkt_geometry(F.col(column)).alias("geom"), F.lit(4326).alias("srid"))


LISTED = "path string, rest array<string>, file boolean"


def _alternatives(text: str) -> list[str]:
    """A glob without braces for each choice of its {a,b}."""
    if not (m := re.search(r"\{([^{}]*)\}", text)):
        return [text]
    return [t for part in m[1].split(",") for t in _alternatives(text[: m.start()] + part + text[m.end() :])]


def _opened(path: str) -> tuple[fs.FileSystem, str, str]:
    """The file system of a path or URI, the path in it, and what stands before that in a URI."""
    if path.startswith("file:") or "://" not in path:
        own = re.sub("^file:(//)?(?=/)", "", path)
        return fs.LocalFileSystem(), os.path.abspath(own), "file:"
    files, own = fs.FileSystem.from_uri(path)
    return files, own, path[: path.rstrip("/").rindex(own)]


def _listed(pattern: str):
    """Lists folders: a file that is found, or a folder with the parts of its glob that are still to be matched."""
    names = _alternatives(pattern)
    hidden = lambda name: name.startswith(".") or (name.startswith("_") and "=" not in name)

    def entries(folder: str, rest: list[str]) -> Iterator[tuple[str, list[str], bool]]:
        files, own, head = _opened(folder)
        root = files.get_file_info(own)
        if root.type == fs.FileType.NotFound:
            if not rest:
                raise FileNotFoundError(folder)
            return
        if root.type == fs.FileType.File:
            if not rest and any(fnmatchcase(root.base_name, n) for n in names):
                yield head + root.path, [], True
            return
        for info in files.get_file_info(fs.FileSelector(own)):
            if not (fnmatchcase(info.base_name, rest[0]) if rest else not hidden(info.base_name)):
                continue
            if info.type == fs.FileType.Directory:
                yield head + info.path, rest[1:], False
            elif len(rest) < 2 and any(fnmatchcase(info.base_name, n) for n in names):
                yield head + info.path, [], True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = pa.string(), pa.list_(pa.string()), pa.bool_()
        for batch in batches:
            for folder, rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = entries(folder, rest)
                while some := list(islice(found, 10_000)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), types, strict=True)], ["path", "rest", "file"])

    return run


def expand_inputs(spark: SparkSession, *inputs: str, pattern: str = "*.gpkg") -> DataFrame:
    """The distinct files of directories, with those below them, and globs, in order; none is an error.

    Only paths are read, not contents.  Tasks list the folders, one level of them in each round, so the driver holds
    no list of files.  Hidden files and folders (``.x``, ``_x``) count only if a glob names them.
    """
    if not inputs:
        raise ValueError("no input given")
    starts = []
    for text in (t for i in inputs for t in _alternatives(i)):
        parts = text.split("/")
        plain = next((k for k, p in enumerate(parts) if re.search(r"[*?\[]", p)), len(parts))
        starts.append(("/".join(parts[:plain]) or ("/" if text.startswith("/") else "."), [p for p in parts[plain:] if p]))
    for folder, rest in starts:
        files, own, _ = _opened(folder)
        if not rest and files.get_file_info(own).type == fs.FileType.NotFound:
            raise FileNotFoundError(f"no such input: {folder}")
    level, found = spark.createDataFrame(starts, "path string, rest array<string>"), []
    while not level.isEmpty():
        listed = materialize(level.repartition(4 * spark.sparkContext.defaultParallelism, "path").mapInArrow(_listed(pattern), LISTED), "inputs")
        found.append(listed.filter("file").select("path"))
        level = listed.filter("not file").select("path", "rest")
    files = reduce(DataFrame.union, found).distinct().orderBy("path")
    if files.isEmpty():
        raise ValueError(f"no file matches {pattern} in {inputs}")
    return files
