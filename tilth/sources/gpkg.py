"""GeoPackage tables as a Spark data source.

:func:`read_gpkg` reads a folder or a glob; columns id, geom, srid and the box.  The driver lists
files and opens none.  On a path that tasks can open, a Spark job finds each file's layer and rows, and a partition is a range of
rows.  A file in a store is one partition, so it is fetched once, through ``pyarrow.fs``, by the task that reads it.
A filter on the box is pushed to the file's rtree where it has one.
"""

from __future__ import annotations

import contextlib
import json
import os
import sqlite3
import struct
import tempfile
from collections.abc import Iterator
from fnmatch import fnmatch

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, Filter, GreaterThanOrEqual, InputPartition, LessThanOrEqual
from pyspark.sql.types import StructType

SCHEMA = "source string, layer string, id string, srid int, minx double, miny double, maxx double, maxy double, geom array<array<array<struct<x:double,y:double>>>>"
ROWS = 50_000
#: Bytes of the envelope by its code in the blob header.
ENVELOPES = {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}
#: Names of the id column, in order of preference.
ID_COLUMNS = ("Name", "name", "tile_id", "tile", "MGRS_TILE", "mgrs_tile", "s2:mgrs_tile")


def header_size(blob: bytes) -> int:
    code = blob[3] >> 1 & 7
    if code not in ENVELOPES:
        raise ValueError(f"unsupported envelope code {code}")
    return 8 + ENVELOPES[code]


def _polygons(data: bytes, at: int) -> tuple[list, int]:
    """Polygons of a WKB geometry and where it ends; heights are dropped."""
    order = "<" if data[at] else ">"
    (kind,) = struct.unpack_from(order + "I", data, at + 1)
    flags, kind = kind >> 29, kind & 0x1FFFFFFF
    if flags & 1:
        at += 4  # an srid follows the type
    size = 2 + (flags >> 2 & 1) + (flags >> 1 & 1)
    if kind >= 1000:
        size = {1: 3, 2: 3, 3: 4}[kind // 1000]
    kind %= 1000
    at += 5
    if kind == 1:
        return [], at + 8 * size
    (n,) = struct.unpack_from(order + "I", data, at)
    at += 4
    if kind == 2:
        return [], at + 8 * size * n
    out: list = []
    if kind == 3:
        rings = []
        for _ in range(n):
            (m,) = struct.unpack_from(order + "I", data, at)
            values = struct.unpack_from(f"{order}{m * size}d", data, at + 4)
            at += 4 + 8 * size * m
            rings.append(list(zip(values[::size], values[1::size], strict=True)))
        return ([rings] if rings else []), at
    for _ in range(n):  # multi geometries and collections
        some, at = _polygons(data, at)
        out += some
    return out, at


def decode(blob: bytes | None) -> list | None:
    """A GeoPackage blob as geom; None without a polygon."""
    if not blob:
        return None
    return _polygons(bytes(blob), header_size(blob))[0] or None


def quoted(name: str) -> str:
    """A name for SQLite, which doubles quotes inside quotes."""
    return f'"{name.replace(chr(34), chr(34) * 2)}"'


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), os.path.abspath(path))


def _files(path: str) -> list[str]:
    """The GeoPackages of a folder, or the files that a glob names, with their scheme."""
    files, root = _store(path.split("*")[0] if "*" in path else path)
    scheme = path[: path.find(root)] if root in path else ""
    info = files.get_file_info(root)
    if "*" not in path and info.type == fs.FileType.File:
        found = [root]
    else:
        folder = root if info.type == fs.FileType.Directory else os.path.dirname(root)
        name = path.rpartition("/")[2] if "*" in path else "*.gpkg"
        found = [x.path for x in files.get_file_info(fs.FileSelector(folder)) if fnmatch(x.base_name, name)]
    return [scheme + x for x in sorted(found)]


@contextlib.contextmanager
def _opened(path: str) -> Iterator[sqlite3.Connection]:
    """The database of a file; one in a store is copied beside the task while it is read."""
    files, root = _store(path)
    with contextlib.ExitStack() as stack:
        if not isinstance(files, fs.LocalFileSystem):
            own = f"{stack.enter_context(tempfile.TemporaryDirectory())}/x.gpkg"
            with files.open_input_stream(root) as source, open(own, "wb") as out:
                while some := source.read(1 << 20):
                    out.write(some)
            root = own
        yield stack.enter_context(contextlib.closing(sqlite3.connect(f"file:{root}?mode=ro", uri=True)))


class Part(InputPartition):
    """A range of rows of a layer; without a range, all rows of the layer that is found when the file is read."""

    def __init__(self, file: str, layer: str | None = None, geometry: str = "", srid: int = 0, first: int = 0, last: int = 0):
        self.file, self.layer, self.geometry, self.srid, self.first, self.last = file, layer, geometry, srid, first, last


def find_layer(db: sqlite3.Connection, file: str, layer: str | None) -> tuple[str, str, int]:
    """(table, geometry column, srid) of the layer asked for, or of the first feature table."""
    known = db.execute("select table_name, column_name, srs_id from gpkg_geometry_columns order by table_name").fetchall()
    found = [k for k in known if layer in (None, k[0])]
    if not found:
        raise ValueError(f"{file} has no feature table {layer or ''}")
    return found[0]


def _ranges(layer: str | None):
    """The parts of each file of a batch as JSON."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for file in batch.column("file").to_pylist():
                with _opened(file) as db:
                    name, column, srid = find_layer(db, file, layer)
                    low, high = db.execute(f"select min(rowid), max(rowid) from {quoted(name)}").fetchone()
                out.append(json.dumps([(file, name, column, srid, i, i + ROWS) for i in range(low, high + 1, ROWS)] if low is not None else []))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["parts"])

    return run


def id_column(columns: list[str], requested: str | None) -> str:
    """The id column asked for, or the first known one; raises if there is none."""
    if requested is not None and requested not in columns:
        raise ValueError(f"no column {requested}; there are {', '.join(columns)}")
    found = requested or next((c for c in ID_COLUMNS if c in columns), None)
    if found is None:
        raise ValueError(f"no id column found; there are {', '.join(columns)}")
    return found


class GpkgReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options, self.box = options, {}

    def partitions(self) -> list[Part]:
        if plan := self.options.get("plan"):
            return [Part(*p) for p in json.loads(plan)]
        files = _files(self.options["path"])
        if not files:
            raise ValueError(f"no GeoPackage at {self.options['path']}")
        return [Part(f) for f in files]

    def read(self, part: Part) -> Iterator[tuple]:
        with _opened(part.file) as db:
            if part.layer is None:
                name, column, srid = find_layer(db, part.file, self.options.get("layer"))
                part = Part(part.file, name, column, srid, -(1 << 63), (1 << 63) - 1)
            columns = [r[1] for r in db.execute(f"pragma table_info({quoted(part.layer)})")]
            what = f"t.{quoted(id_column(columns, self.options.get('id')))}"
            sql, values = f"select {what}, t.{quoted(part.geometry)} from {quoted(part.layer)} t where t.rowid >= ? and t.rowid < ?", [part.first, part.last]
            rtree = f"rtree_{part.layer}_{part.geometry}"
            if self.box and db.execute("select 1 from sqlite_master where name = ?", (rtree,)).fetchone():
                tests = [f"{c} {'>=' if c.startswith('max') else '<='} ?" for c in self.box]
                sql += f" and t.rowid in (select id from {quoted(rtree)} where {' and '.join(tests)})"
                values += list(self.box.values())
            for name, blob in db.execute(sql, values):
                geom = decode(blob)
                points = [p for poly in geom or [] for ring in poly for p in ring]
                xs, ys = [p[0] for p in points], [p[1] for p in points]
                yield part.file, part.layer, None if name is None else str(name), part.srid, min(xs, default=None), min(ys, default=None), max(xs, default=None), max(ys, default=None), geom


class PushingGpkgReader(GpkgReader):
    """For sessions that push filters to Python data sources."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else ""
            if isinstance(f, GreaterThanOrEqual) and name in ("maxx", "maxy") or isinstance(f, LessThanOrEqual) and name in ("minx", "miny"):
                self.box[name] = f.value
            yield f  # rtree boxes are rounded outwards, so Spark filters again


class GpkgDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "gpkg"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> GpkgReader:
        options = dict(self.options)
        return (PushingGpkgReader if options.get("pushdown", "false") == "true" else GpkgReader)(options)


def read_gpkg(spark: SparkSession, path: str, *, layer: str | None = None, id: str | None = None) -> DataFrame:
    """The features at ``path``, with filters on the box pushed down.

    Switches the session's pushdown to Python data sources on.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(GpkgDataSource)
    named = {k: v for k, v in (("layer", layer), ("id", id)) if v is not None}
    files = _files(path)
    if not files:
        raise ValueError(f"no GeoPackage at {path}")
    if isinstance(_store(files[0])[0], fs.LocalFileSystem):
        table = spark.createDataFrame([(f,) for f in files], "file string")
        planned = table.repartition(min(len(files), 4 * spark.sparkContext.defaultParallelism)).mapInArrow(_ranges(layer), "parts string")
        parts = sorted(p for r in planned.collect() for p in json.loads(r["parts"]))  # a row per file
        if not parts:  # files without rows
            return spark.createDataFrame([], SCHEMA)
        named["plan"] = json.dumps(parts)
    return spark.read.format("gpkg").options(pushdown="true", **named).load(path)
