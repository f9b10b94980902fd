"""Manifests, ledgers and pending work as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_path(table: DataFrame) -> DataFrame:
    """One row per tile id of (tile_id, path): a tile listed several times has one output, the greatest path."""
    return table.groupBy("tile_id").agg(F.max("path").alias("path"))


def with_raster(summary: DataFrame, rasters: DataFrame) -> DataFrame:
    """Each summary row with its tile's raster; absent stays null."""
    return summary.join(one_path(rasters), "tile_id", "left")


def staged(tiles: DataFrame, **stages: DataFrame) -> DataFrame:
    """Each row of ``tiles`` once, with the path of each stage's output, null where absent.

    Every stage is a table of (tile_id, path).
    """
    out = tiles.select("tile_id")
    for name, table in stages.items():
        out = out.join(one_path(table).withColumnRenamed("path", name), "tile_id", "left")
    return out


def latest_output(files: DataFrame, started: DataFrame, slack_seconds: int = 5) -> DataFrame:
    """Per key the newest path, at most ``slack_seconds`` older than the start."""
    f = files.join(started, "key").filter(F.col("modified") >= F.col("started") - F.make_interval(secs=F.lit(slack_seconds)))
    return f.groupBy("key").agg(F.max_by("path", F.struct("modified", "path")).alias("path"))


def pending(tiles: DataFrame, finished: DataFrame, *, overwrite: bool = False, resume: bool = True) -> DataFrame:
    """Tiles still to do: those without a finished output, or all."""
    return tiles if overwrite or not resume else tiles.join(finished.select("tile_id").distinct(), "tile_id", "left_anti")


def ledger(events: DataFrame) -> DataFrame:
    """The last state of each (run, step): status, start, duration to 3 decimals."""
    last = F.max_by(F.struct("status", "started_at", F.round("duration_seconds", 3).alias("duration_seconds"), "seq"), "seq")
    totals = [F.count(F.lit(1)).alias("events"), F.count_if(F.col("status") == "failed").alias("failures")]
    return events.groupBy("run_id", "step").agg(last.alias("last"), *totals).select("run_id", "step", "last.*", "events", "failures")
