"""What the operators share: the definition of a word and table reading."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


#: Bytes of one Arrow batch of texts, whatever their lengths.
BATCH_BYTES = 16 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches by bytes, so that long texts don't add up in a worker.

    Only the size of batches changes; a lower bound of the session's own stays.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if BATCH_BYTES < int(spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()):
        spark.conf.set(name, str(BATCH_BYTES))


_HOLDER: list = ["", None]


def hold_worker(owner: str, forget: Callable[[], object] = lambda: None) -> None:
    """Called where a task of an operator starts in a Python worker.

    What tasks of another operator remember there, between their own tasks, is forgotten first.
    """
    if _HOLDER[0] != owner:
        if _HOLDER[1] is not None:
            _HOLDER[1]()
        _HOLDER[:] = [owner, forget]


def carried(docs: DataFrame, text: str) -> Column:
    """All columns but the text under names of its own, to travel beside the text."""
    return F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != text]).alias("rest")


def restored(docs: DataFrame, text: str) -> Column:
    """The struct of the columns of ``docs``, from ``rest`` and ``text``."""
    return F.struct(*[(F.col("text") if c == text else F.col(f"rest.c{i}")).alias(c) for i, c in enumerate(docs.columns)]).alias("row")


def range_cuts(df: DataFrame, key: str, rows_per_shard: int, most: int = 20_000) -> list[int]:
    """Ascending keys that cut a table into shards of about equal rows.

    From a mergeable quantile sketch, ten times finer than the shards.  At most ``most`` cuts
    reach the driver; a table of more shards has as many, of more rows each.
    """
    rows = df.count()
    shards = min(most, max(1, -(-rows // rows_per_shard)))
    if shards == 1:
        return []
    found = df.select(F.percentile_approx(key, [i / shards for i in range(1, shards)], max(10_000, 10 * shards)).alias("c")).first()[0]
    return sorted(set(found or []))


def range_shard(key: Column, cuts: list[int]) -> Column:
    """The number of cuts up to ``key``, found in two steps; null belongs to none."""
    if not cuts:
        return F.lit(0)
    step = math.isqrt(len(cuts))
    longs = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    block = F.size(F.filter(longs(cuts[::step]), lambda c: c <= key)) - 1
    inner = F.size(F.filter(F.slice(longs(cuts), F.greatest(block, F.lit(0)) * step + 1, F.lit(step)), lambda c: c <= key))
    return F.when(block < 0, 0).otherwise(block * step + inner).cast("int")
