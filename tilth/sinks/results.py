"""Sinks: GeoJSON, KML, CSV and JSON rows, and gallery cards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilth.functions.scalars import relative_to, stem
from tilth.operators import crs
from tilth.operators import geometry as G

#: Columns of the summary table, in order.
SUMMARY_COLUMNS = ("source", "layer", "crs", "feature_count", "total_area_ha", "median_area_ha")


def features(table: DataFrame, properties: Sequence[str], srid: int = 4326) -> DataFrame:
    """``value``: one GeoJSON feature per row, in EPSG:4326."""
    geometry = G.geojson(crs.to_crs(F.col("geom"), srid, 4326))
    head = F.to_json(F.struct(*properties)) if properties else F.lit("{}")
    text = F.concat(F.lit('{"type":"Feature","properties":'), head, F.lit(',"geometry":'), F.coalesce(geometry, F.lit("null")), F.lit("}"))
    return table.withColumn("value", text)


def write_geojson(table: DataFrame, path: str, properties: Sequence[str], *, srid: int = 4326, by: Sequence[str] = ()) -> None:
    """Newline-delimited features, partitioned by ``by``."""
    features(table, properties, srid).select("value", *by).write.mode("overwrite").partitionBy(*by).text(path)


def _kml_ring(ring: Column) -> Column:
    return F.concat(F.lit("<LinearRing><coordinates>"), F.array_join(F.transform(ring, lambda p: F.concat_ws(",", p["x"].cast("string"), p["y"].cast("string"))), " "), F.lit("</coordinates></LinearRing>"))


def _escaped(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def placemarks(table: DataFrame, name: str, srid: int = 4326) -> DataFrame:
    """``value``: one KML Placemark per row; null without a geometry."""

    def polygon(poly: Column) -> Column:
        outer = F.concat(F.lit("<outerBoundaryIs>"), _kml_ring(F.get(poly, F.lit(0))), F.lit("</outerBoundaryIs>"))
        holes = F.transform(F.slice(poly, F.lit(2), F.greatest(F.size(poly) - 1, F.lit(0))), lambda r: F.concat(F.lit("<innerBoundaryIs>"), _kml_ring(r), F.lit("</innerBoundaryIs>")))
        return F.concat(F.lit("<Polygon>"), outer, F.array_join(holes, ""), F.lit("</Polygon>"))

    shapes = F.array_join(F.transform(crs.to_crs(F.col("geom"), srid, 4326), polygon), "")
    text = F.concat(F.lit("<Placemark><name>"), _escaped(F.col(name).cast("string")), F.lit("</name><MultiGeometry>"), shapes, F.lit("</MultiGeometry></Placemark>"))
    return table.withColumn("value", F.when(G.nonempty(F.col("geom")), text))


KML_HEAD = '<?xml version="1.0" encoding="UTF-8"?>\n<kml xmlns="http://www.opengis.net/kml/2.2"><Document>'
KML_TAIL = "</Document></kml>"


def write_kml(table: DataFrame, path: str, name: str, *, by: str = "source", srid: int = 4326) -> None:
    """One KML document for each value of ``by``, in a folder of its own.

    A document is one sorted stream of lines from its head to its tail, so a large one
    is not held in memory.  Rows without a geometry have no placemark.
    """
    marks = placemarks(table, name, srid).filter("value is not null").select(by, F.lit(1).alias("part"), F.col(name).cast("string").alias("name"), "value")
    kinds = table.select(by).distinct()
    line = lambda part, text: kinds.select(by, F.lit(part).alias("part"), F.lit("").alias("name"), F.lit(text).alias("value"))
    lines = marks.unionByName(line(0, KML_HEAD)).unionByName(line(2, KML_TAIL))
    lines.repartition(by).sortWithinPartitions(by, "part", "name").select(by, "value").write.mode("overwrite").partitionBy(by).text(path)


def write_summary_csv(summary: DataFrame, path: str) -> None:
    """The summary as one CSV file with a header; it has a row per result file."""
    summary_csv(summary).orderBy("source", "layer").coalesce(1).write.mode("overwrite").csv(path, header=True)


def tile_csv(tiles: DataFrame) -> DataFrame:
    return tiles.select("tile_id").orderBy("tile_id")


def write_tile_csv(tiles: DataFrame, path: str) -> None:
    """One CSV file with a header, in tile order; a manifest is small."""
    tile_csv(tiles).coalesce(1).write.mode("overwrite").csv(path, header=True)


def summary_csv(summary: DataFrame) -> DataFrame:
    """The six columns in order, missing ones blank; extra ones are left out."""
    blank = F.lit("")
    return summary.select(*[(F.coalesce(F.col(c).cast("string"), blank) if c in summary.columns else blank).alias(c) for c in SUMMARY_COLUMNS])


def summary_json(summary: DataFrame) -> DataFrame:
    """``value``: one JSON object per row; maps, arrays and nulls are kept."""
    return summary.select(F.to_json(F.struct(*summary.columns), {"ignoreNullFields": "false"}).alias("value"))


def write_exports_json(summary: DataFrame, path: str, order: Sequence[str] = ("source",)) -> None:
    """One document ``{"exports": [...]}`` with an object per row, in order of columns that name a row.

    It is a sorted stream of lines from head to tail, so the list is never one value.
    """
    own = F.to_json(F.struct(*summary.columns), {"ignoreNullFields": "false"})
    first = summary.agg(F.min(F.struct(*order))).scalar()
    rows = summary.select(F.lit(1).alias("part"), F.struct(*order).alias("key"), own.alias("value"))
    rows = rows.withColumn("value", F.concat(F.when(F.col("key") == first, "").otherwise(","), F.col("value")))
    line = lambda part, text: summary.sparkSession.range(1).select(F.lit(part).alias("part"), F.lit(None).cast(rows.schema["key"].dataType).alias("key"), F.lit(text).alias("value"))
    lines = rows.unionByName(line(0, '{"exports": [')).unionByName(line(2, "]}"))
    lines.repartition(1).sortWithinPartitions("part", "key").select("value").write.mode("overwrite").text(path)


def run_summaries(ledger: DataFrame) -> DataFrame:
    """(run_id, value): a JSON object per run with the last state of its steps, in order of their start.

    ``ledger`` has a row per run and step; a run has few steps.
    """
    step = F.struct(F.col("step").alias("name"), "status", F.date_format("started_at", "yyyy-MM-dd'T'HH:mm:ss").alias("started_at"), "duration_seconds")
    runs = ledger.groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct("started_at", "seq", step.alias("s")))).alias("all"), F.sum("failures").alias("failures"))
    status = F.when(F.col("failures") > 0, "failed").otherwise("completed")
    return runs.select("run_id", F.to_json(F.struct("run_id", status.alias("status"), F.col("all.s").alias("steps")), {"ignoreNullFields": "false"}).alias("value"))


def cards(summary: DataFrame, root: str) -> DataFrame:
    """Gallery cards: title, image, links where present, text."""
    at = lambda name: relative_to(F.col("exports")[name], root)
    links = F.array_compact(F.array(*[F.when(F.col("exports")[key].isNotNull(), F.concat(F.lit(label + ": "), at(key))) for label, key in (("GeoJSON", "geojson"), ("KML", "kml"), ("Summary", "summary"))]))
    area = F.when(F.col("total_area_ha").isNotNull(), F.concat(F.format_number("total_area_ha", 1), F.lit(" ha")))
    text = F.concat_ws(" | ", F.concat(F.format_number(F.col("feature_count"), 0), F.lit(" features")), area)
    return summary.select(stem(F.col("source")).alias("title"), F.coalesce(at("overlay"), at("boundaries")).alias("image"), links.alias("links"), text.alias("text"))
