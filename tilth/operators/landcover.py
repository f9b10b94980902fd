"""Land-cover labels: modal class, histogram, pixel grid and masks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The classes of the label band, in order.
CLASSES = ("water", "trees", "grass", "flooded_vegetation", "crops", "shrub_and_scrub", "built", "bare", "snow_and_ice")
FILTER_CLASSES = (0, 1, 2, 3, 5, 6, 7, 8)
CLIP_CLASSES = (0, 6, 7, 8)


def classes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(CLASSES)), "label long, class_name string")


def known(labels: DataFrame) -> DataFrame:
    """Labels outside the class range are rejected."""
    return labels.filter(F.col("label").between(0, len(CLASSES) - 1))


def mode(labels: DataFrame, by: Sequence[str] = ("tile_id", "px", "py")) -> DataFrame:
    """The most frequent label, the smallest on a tie."""
    return known(labels).groupBy(*by).agg(F.mode("label", True).alias("label"))


def histogram(labels: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Count and share of each class; the class table is a fixed dimension."""
    n = known(labels).groupBy(*by, "label").agg(F.count(F.lit(1)).alias("n"))
    total = known(labels).groupBy(*by).agg(F.count(F.lit(1)).alias("total"))
    out = n.join(total, list(by)) if by else n.crossJoin(F.broadcast(total))
    return out.join(F.broadcast(classes(labels.sparkSession)), "label").select(*by, "label", "class_name", "n", (F.col("n") / F.col("total")).alias("share"))


def snap(x: Column, y: Column, ox: float, oy: float, r: float) -> tuple[Column, Column]:
    """Column and row of a point on a grid with its origin in the upper left."""
    return F.floor((x - ox) / r).cast("bigint"), F.floor((oy - y) / r).cast("bigint")


def clip_pixels(pixels: DataFrame, clip: Sequence[int] = CLIP_CLASSES) -> DataFrame:
    """Pixels of the listed classes leave their parcel."""
    return known(pixels).filter(~F.col("label").isin(list(clip)))


def filter_parcels(pixels: DataFrame, parcel: str, drop: Sequence[int] = FILTER_CLASSES) -> DataFrame:
    """Pixels of parcels whose majority class is not listed."""
    gone = mode(pixels, (parcel,)).filter(F.col("label").isin(list(drop))).select(parcel)
    return pixels.join(gone, parcel, "left_anti")
