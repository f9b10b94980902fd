"""GeoJSON feature collections split inside one file, and the AOI loader with its guards.

Spark's text reader cuts a file into records at closing braces, block by block and in any store.  Whether a
block starts inside a string, and how deep, depends on all before it, so there are two passes: the first counts, for
both cases, the quotes and brackets of each block; sums over a file's blocks tell where each one starts.  The
second pass emits the features, and the pieces of those that cross blocks are put together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilth.operators import geometry as G
from tilth.scratch import materialize
from tilth.sources.vectors import FEATURE, geojson_geometry, wkt_geometry

_ESCAPE = re.compile(r"\\.", re.S)
_TOKEN = re.compile(r'["{\[\]]')
COUNTS = "file string, block long, quotes long, braces0 long, brackets0 long, braces1 long, brackets1 long"
PIECES = "file string, block long, part int, text string"
WHOLE, HEAD, MIDDLE, TAIL = range(4)


def _records(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, text): what lies between closing braces, in order within a block."""
    return spark.read.option("lineSep", "}").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("text"))


def _outside(text: str, quoted: int) -> tuple[str, int]:
    """What of a text is outside of strings, and its number of quotes; ``quoted`` is 1 if it starts in a string."""
    parts = (_ESCAPE.sub("__", text) if "\\" in text else text).split('"')
    return "".join(parts[quoted::2]), len(parts) - 1


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in COUNTS.split(", ")]
    rows: dict[tuple, list[int]] = {}
    for batch in batches:
        for file, block, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            own = rows.setdefault((file, block), [0] * 5)
            for quoted in (0, 1):
                out, quotes = _outside(text, (own[0] + quoted) % 2)
                closes = (own[0] + quoted + quotes) % 2 == 0
                own[1 + 2 * quoted] += out.count("{") - closes
                own[2 + 2 * quoted] += out.count("[") - out.count("]")
            own[0] += quotes
    if rows:  # one row per block of a task
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*((*k, *v) for k, v in rows.items()), strict=True)], names)


@dataclass
class _Block:
    """Where a block of a file stands, and the open feature's text."""

    quoted: int
    braces: int
    brackets: int
    held: list[str]
    first: bool = True

    def take(self, text: str) -> tuple[int, str] | None:
        """Goes on to the next closing brace; a feature that it closes, or the rest of one of an earlier block."""
        at = 0 if self.braces > 1 else self._start(text)
        if at is not None:
            out, quotes = _outside(text[at:], self.quoted)
            self.braces += out.count("{")
            self.brackets += out.count("[") - out.count("]")
            self.quoted = (self.quoted + quotes) % 2
            self.held.append(text[at:] + "}")
        if not self.quoted:
            self.braces -= 1
            if self.braces == 1 and at is not None:
                done = (HEAD if self.first else WHOLE), "".join(self.held)
                self.held, self.first = [], False
                return done
        return None

    def _start(self, text: str) -> int | None:
        """Where a feature starts: a brace in an array of the outermost object."""
        plain = _ESCAPE.sub("__", text)
        for m in _TOKEN.finditer(plain):
            c = m[0]
            if c == '"':
                self.quoted ^= 1
            elif self.quoted:
                continue
            elif c == "{":
                if self.braces == 1 and self.brackets == 1:
                    self.first = False
                    return m.start()
                self.braces += 1
            else:
                self.brackets += 1 if c == "[" else -1
        return None


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, at, state = [c.split()[0] for c in PIECES.split(", ")], None, None

    def rest(rows: list) -> None:
        if state is not None and state.held:
            rows.append((*at, MIDDLE if state.first else TAIL, "".join(state.held)))

    def made(rows: list) -> pa.RecordBatch:
        types = pa.string(), pa.int64(), pa.int32(), pa.string()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    for batch in batches:
        rows: list[tuple] = []
        for file, block, text, quotes, braces, brackets in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (file, block) != at:
                rest(rows)
                if quotes is None:
                    raise ValueError(f"{file} was cut differently when it was read again")
                at, state = (file, block), _Block(quotes % 2, braces, brackets, [])
                state.first = braces > 1
            if got := state.take(text):
                rows.append((*at, *got))
        if rows:
            yield made(rows)
    rows = []
    rest(rows)
    if rows:
        yield made(rows)


def collection_features(spark: SparkSession, path: str) -> DataFrame:
    """(file, text): the features of feature collections as JSON texts; every file is split.

    Defined results: white space, line feeds and the order of members do not matter; braces and quotes in strings are
    part of them; members of the outermost object that are arrays of other objects are left out.
    """
    records = _records(spark, path)
    counts = materialize(records.mapInArrow(_counted, COUNTS), "geojson-blocks")
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    prior = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    starts = counts.withColumn("before", prior("quotes")).withColumns({c: F.when(F.col("before") % 2 == 0, F.col(f"{c}0")).otherwise(F.col(f"{c}1")) for c in ("braces", "brackets")})
    # a row per block of a file: its quotes, braces and brackets so far
    starts = starts.select("file", "block", F.col("before").alias("quotes"), prior("braces").alias("braces"), prior("brackets").alias("brackets"))
    placed = records.join(F.broadcast(starts), ["file", "block"], "left").select("file", "block", "text", "quotes", "braces", "brackets")
    pieces = materialize(placed.mapInArrow(_cut, PIECES), "geojson-pieces")
    order = W.partitionBy("file").orderBy("block", "part").rowsBetween(W.unboundedPreceding, 0)
    # of a block there are a head and a tail at most, or a middle
    split = pieces.filter(F.col("part") != WHOLE).withColumn("nth", F.sum((F.col("part") == TAIL).cast("int")).over(order))
    joined = split.groupBy("file", "nth").agg(F.array_sort(F.collect_list(F.struct("block", "part", "text"))).alias("p")).select("file", F.array_join(F.col("p.text"), "").alias("text"))
    whole = pieces.filter(F.col("part") == WHOLE).select("file", "text").unionByName(joined)
    return whole.filter(F.get_json_object("text", "$.type") == "Feature")


def read_collection(spark: SparkSession, path: str) -> DataFrame:
    """(file, properties, geom, srid) of all features; those without a polygon have a null geom."""
    f = collection_features(spark, path).select("file", F.from_json("text", FEATURE).alias("f"))
    return f.select("file", F.col("f.properties").alias("properties"), geojson_geometry(F.col("f.geometry")).alias("geom"), F.lit(4326).alias("srid"))


def load_aoi(spark: SparkSession, path: str) -> DataFrame:
    """(geom, srid) of an AOI file: one geometry as WKT in .wkt and .txt files, else a feature collection.

    Raises FileNotFoundError for a missing file, and ValueError for a file without features or without a geometry
    that is not empty.
    """
    try:
        if path.lower().endswith((".wkt", ".txt")):
            found = spark.read.text(path, wholetext=True).select(wkt_geometry(F.regexp_replace("value", r"^\s+|\s+$", "")).alias("geom"), F.lit(4326).alias("srid"))
        else:
            found = read_collection(spark, path).select("geom", "srid")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or ""):
            raise FileNotFoundError(f"AOI not found: {path}") from e
        raise
    found = materialize(found, "aoi")
    if found.isEmpty():
        raise ValueError(f"AOI file contains no features: {path}")
    found = found.filter(G.nonempty(F.col("geom")))
    if found.isEmpty():
        raise ValueError(f"AOI has no valid geometries: {path}")
    return found
