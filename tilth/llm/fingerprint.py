"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A fingerprint holds the k smallest hashes (the upper 40 of 64 bits) of a text's
distinct shingles.
The k smallest of a union are among those of its parts, so fingerprints merge
across parts; from two of them follow resemblance, containment and the number of
distinct shingles.  With fewer than k shingles a fingerprint is the whole set
and the estimates are exact.

``edited_fingerprints`` pairs each document with the next one in ascending key.
Rows are dealt into key ranges, sorted, and streamed; the first document of each
range is also sent to the range before it, so no task needs more than its own
range and one more row.

Defined results: a null text is empty; an empty text has an empty fingerprint,
and two empty ones resemble each other fully; rows with the same key are
ordered by text, rows without a key come last; a lone document follows itself; an
empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.llm import shingles as S
from tilth.llm.text import bound_batches, range_cuts, range_shard

#: Hashes in a fingerprint; the standard error of a resemblance is at most 0.5 / sqrt(K).
K = 256
BITS = 40
SHARD_ROWS = 8_000


def sketch(text: str | None, k: int = K) -> np.ndarray:
    return np.unique(S.shingle_set(text)[: k + 8] >> np.uint64(64 - BITS))[:k]


def encode(s: np.ndarray) -> str:
    return base64.b64encode(s.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - BITS // 8 :].tobytes()).decode()


def decode(s: str) -> np.ndarray:
    if not s:
        return np.empty(0, np.uint64)
    low = np.frombuffer(base64.b64decode(s), np.uint8).reshape(-1, BITS // 8)
    return np.pad(low, ((0, 0), (8 - BITS // 8, 0))).view(">u8").ravel().astype(np.uint64)


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated size of the intersection over the size of the union."""
    both = merge(a, b, k)
    if not len(both):
        return 1.0
    return float((np.isin(both, a, assume_unique=True) & np.isin(both, b, assume_unique=True)).sum() / len(both))


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) / (float(a[k - 1]) / 2.0**BITS)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the first's shingles that the second has."""
    if not len(a):
        return 1.0
    return min(1.0, resemblance(a, b, k) * distinct(merge(a, b, k), k) / distinct(a, k))


def fingerprints(docs: DataFrame, *, key: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """(key, fingerprint) of every row, without a shuffle."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([encode(sketch(t, k)) for t in batch.column(1).to_pylist()], pa.string())], [key, "fingerprint"])

    bound_batches(docs.sparkSession)
    slim = docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias("text"))
    return slim.mapInArrow(made, f"`{key}` {docs.schema[key].dataType.simpleString()}, fingerprint string")


def merge_fingerprints(parts: DataFrame, by: str, *, fingerprint: str = "fingerprint", k: int = K, salts: int = 64) -> DataFrame:
    """One fingerprint per value of ``by``, merged per batch, per salt and per key."""

    def of(pdf: pd.DataFrame, names: list[str]) -> pd.DataFrame:
        def one(values: pd.Series) -> str:
            return encode(np.unique(np.concatenate([decode(v) for v in values]))[:k])

        return pdf.groupby(names, dropna=False, sort=False)["fingerprint"].agg(one).reset_index().astype({"by": object, "fingerprint": object})

    kind = parts.schema[by].dataType.simpleString()
    slim = parts.select(F.col(f"`{by}`").alias("by"), F.col(f"`{fingerprint}`").alias("fingerprint"))
    slim = slim.filter("fingerprint is not null").withColumn("salt", F.pmod(F.xxhash64("fingerprint"), F.lit(salts)).cast("int"))
    schema = f"`by` {kind}, salt int, fingerprint string"
    slim = slim.mapInPandas(lambda frames: (of(pdf, ["by", "salt"]) for pdf in frames if len(pdf)), schema)
    slim = slim.groupBy("by", "salt").applyInPandas(lambda pdf: of(pdf, ["by", "salt"]), schema)
    out = slim.groupBy("by").applyInPandas(lambda pdf: of(pdf, ["by"]), f"`by` {kind}, fingerprint string")
    return out.withColumnRenamed("by", by)


def edited(text: str, after: str) -> str:
    """The text with its last quarter replaced by as much of the next one's start."""
    n = len(text) // 4
    return text[: len(text) - n] + after[:n]


def _pairs(k: int):
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple | None = None
        for batch in batches:
            rows = []
            for key, kind, text in zip(batch.column("key").to_pylist(), batch.column("kind").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if kind == 1 and before is None:
                    continue
                own = sketch(text, k)
                if before is not None:
                    last, last_text, last_own = before
                    changed = edited(last_text, text)
                    other = sketch(changed, k)
                    rows.append((last, len(last_text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), encode(last_own), encode(other), resemblance(last_own, other, k), resemblance(last_own, own, k)))
                before = (key, text, own) if kind == 0 else None
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return made


def edited_fingerprints(docs: DataFrame, *, key: str = "doc_id", text: str = "text", k: int = K, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Fingerprints of each document, of its edited text, and their likeness."""
    bound_batches(docs.sparkSession)
    slim = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    cuts = range_cuts(slim.select("key"), "key", shard_rows)
    shard = F.when(F.col("key").isNull(), len(cuts)).otherwise(range_shard(F.col("key"), cuts)).cast("int")
    heads = {r["shard"]: r["least"] for r in slim.groupBy(shard.alias("shard")).agg(F.min("key").alias("least")).collect()}  # one row per shard
    full = sorted(heads)
    first = F.array(*[F.lit(heads.get(s)).cast("long") for s in range(len(cuts) + 1)])
    before = F.array(*[F.lit(full[full.index(s) - 1] if s in heads else 0) for s in range(len(cuts) + 1)])
    rows = slim.withColumn("shard", shard)
    own = F.struct(F.col("shard").alias("shard"), F.lit(0).alias("kind"))
    to = F.struct(F.get(before, F.col("shard")).alias("shard"), F.lit(1).alias("kind"))
    is_head = F.get(first, F.col("shard")).eqNullSafe(F.col("key"))
    rows = rows.withColumn("to", F.explode(F.when(is_head, F.array(own, to)).otherwise(F.array(own)))).select("to.shard", "to.kind", "key", "text")
    dealt = rows.repartitionById(len(cuts) + 1, F.col("shard")).sortWithinPartitions("kind", F.col("key").asc_nulls_last(), "text")
    return dealt.select("key", "kind", "text").mapInArrow(_pairs(k), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
