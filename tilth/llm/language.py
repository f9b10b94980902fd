"""Language ID by Bayesian fusion of evidence.

The text's likelihood comes from multinomial models over hashed byte trigrams of
letters, one per declared language, however rare, fitted on a bounded sample of its
rows; a language of few rows is smoothed more by the same half count a bucket.  Three more sources of evidence are learnt by grouped aggregation over
all rows, with each row's most likely language by text alone as its label: how
often a language is declared as another (markup language), how often it is found
under an address suffix, and priors of hosts.  A host's prior is smoothed by
its domain's, and the domain's by the prior of the whole table.

A background model stands for text in none of the languages; where it or no
language has most of the posterior, a document is rejected.

Defined results: null or empty text, or one without letters, has no language and is
rejected; a declaration of ``und`` counts as null; a null declaration, address or host gives no evidence of its own; rows
are judged one by one, repeated or not; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from tilth.llm.text import bound_batches, carried, hold_worker, restored
from tilth.scratch import materialize

BUCKETS = 1 << 14
#: Rows with a declared language that a model is fitted on, in expectation.
SAMPLE_PER_LANGUAGE = 2000
#: Every language has a model; a table with more than fit in this many bytes is refused, none is left out.
MODEL_BYTES = 64 << 20
#: Overlapping trigrams are not independent: each counts for a third.
TEMPER = 1 / 3
#: Rows that a parent's prior counts for.
STRENGTH = 20.0
MIN_POSTERIOR = 0.5
NO_LANGUAGE = "und"
_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
_PIECE = 1 << 22


def trigrams(text: str | None) -> Iterator[np.ndarray]:
    """Bucket numbers of the text's trigrams, piece by piece."""
    data = b" " + (text or "").encode("utf-8", "surrogatepass").lower().translate(_LETTERS) + b" "
    for at in range(0, max(1, len(data) - 2), _PIECE):
        b = np.frombuffer(data, np.uint8)[at : at + _PIECE + 2].astype(np.uint32)
        x = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
        middle = b[1:-1] != 32  # runs of blanks say nothing
        yield (x[middle] * np.uint32(0x9E3779B1)) >> np.uint32(18)


@dataclass
class TextModel:
    languages: list[str]
    logs: np.ndarray  # language x bucket, the last row is the background

    def score(self, text: str | None) -> list[float] | None:
        total, n = np.zeros(len(self.logs)), 0
        for ids in trigrams(text):
            total += self.logs[:, ids].sum(axis=1, dtype=float) if len(ids) < BUCKETS else (self.logs * np.bincount(ids, minlength=BUCKETS)).sum(axis=1, dtype=float)
            n += len(ids)
        return (total * TEMPER).tolist() if n else None


def _tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hold_worker("language")
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            counts = held.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for ids in trigrams(text):
                counts += np.bincount(ids, minlength=BUCKETS)
    for lang, counts in held.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], ["lang", "bucket", "n"])


def train(rows: DataFrame, declared: str, text: str, draw: Column, sample: int = SAMPLE_PER_LANGUAGE) -> TextModel:
    """Fits the trigram models on about ``sample`` rows of each declared language.

    ``draw`` is a hash of the whole row: reruns agree, and equal texts are drawn one by one.
    """
    slim = rows.select(F.col(declared).alias("lang"), F.col(text).alias("text"), draw.alias("draw")).filter("lang is not null")
    most = MODEL_BYTES // (4 * BUCKETS)
    many = {r["lang"]: r["n"] for r in slim.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(most + 1).collect()}
    languages = sorted(many)
    if len(languages) > most:
        raise ValueError(f"models of more than {most} declared languages do not fit in {MODEL_BYTES} bytes")
    if not languages:
        return TextModel([], np.zeros((1, BUCKETS), np.float32))
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, sample / many[lang]))])
    chosen = slim.filter(F.pmod("draw", F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000).select("lang", "text")
    counts = chosen.mapInArrow(_tallied, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    table = np.full((len(languages), BUCKETS), 0.5)
    at = pc.index_in(counts["lang"], pa.array(languages, pa.string())).to_numpy()
    table[at, counts["bucket"].to_numpy()] += counts["n"].to_numpy()  # a bucket of a language is one row
    logs = np.log(table / table.sum(axis=1, keepdims=True))
    return TextModel(languages, np.vstack([logs, np.full(BUCKETS, -np.log(BUCKETS))]).astype(np.float32))


def _scored(model: Broadcast):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_worker("language")
        for batch in batches:
            scores = [model.value.score(t) for t in batch.column("text").to_pylist()]
            yield batch.append_column("scores", pa.array(scores, pa.list_(pa.float64())))

    return made


def _argmax(values: Column) -> Column:
    return F.array_position(values, F.array_max(values)) - 1


def _counts(n: int) -> Column:
    return F.array(*[F.col(f"c{k}") for k in range(n)])


def _smoothed(counts: Column, parent: Column) -> Column:
    """Counts with a parent's shares as ``STRENGTH`` more rows."""
    total = F.aggregate(counts, F.lit(STRENGTH), lambda acc, c: acc + c)
    return F.zip_with(counts, parent, lambda c, p: (c + STRENGTH * p) / total)


def identify(docs: DataFrame, *, text: str = "text", declared: Column | None = None, host: Column | None = None, domain: Column | None = None, suffix: Column | None = None, sample: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """``row`` (the columns of ``docs``), language, posterior and kept for every row."""
    none = F.lit(None).cast("string")
    rows = docs.select(
        carried(docs, text),
        F.col(f"`{text}`").alias("text"),
        *[(none if c is None else c.cast("string")).alias(a) for a, c in (("declared", declared), ("host", host), ("domain", domain), ("suffix", suffix))],
    )
    rows = rows.withColumn("declared", F.nullif("declared", F.lit(NO_LANGUAGE)))
    spark = docs.sparkSession
    bound_batches(spark)
    model = train(rows, "declared", "text", F.xxhash64("rest", "text"), sample)
    n = len(model.languages) + 1
    names = F.array(*[F.lit(x) for x in model.languages], F.lit(NO_LANGUAGE))
    sent = spark.sparkContext.broadcast(model)

    scores = StructField("scores", ArrayType(DoubleType()))

    # 1: labels by text alone, all rows, and what is counted from them
    slim = rows.drop("rest")
    slim = slim.mapInArrow(lambda it: (b.drop_columns(["text"]) for b in _scored(sent)(it)), slim.drop("text").schema.add(scores))
    labelled = slim.filter("scores is not null").withColumn("label", _argmax(F.col("scores"))).drop("scores")
    counts = labelled.groupBy("domain", "host", "declared", "suffix", "label").agg(F.count(F.lit(1)).alias("rows"))
    counts = materialize(counts, "language-counts")
    weigh = [F.sum(F.when(F.col("label") == k, F.col("rows")).otherwise(0).cast("double")).alias(f"c{k}") for k in range(n)]
    whole = counts.agg(*weigh).first()
    total = sum(whole[f"c{k}"] or 0.0 for k in range(n))
    prior = F.array(*[F.lit(((whole[f"c{k}"] or 0.0) + 1.0) / (total + n)) for k in range(n)])

    def given(value: str) -> DataFrame:
        t = counts.filter(F.col(value).isNotNull()).groupBy(value).agg(*weigh).select(F.col(value).alias("value"), _counts(n).alias("c"))
        kinds = t.count()
        sums = [float(whole[f"c{k}"] or 0.0) for k in range(n)]
        return t.select(F.col("value").alias(value), F.transform("c", lambda c, k: F.log((c + 1) / (F.get(F.array(*[F.lit(s) for s in sums]), k) + 1 + kinds))).alias(f"{value}_logs"))

    domains = counts.filter("domain is not null").groupBy("domain").agg(*weigh).select("domain", _smoothed(_counts(n), prior).alias("domain_prior"))
    hosts = counts.filter("host is not null").groupBy("domain", "host").agg(*weigh).select("domain", "host", _counts(n).alias("c"))
    hosts = hosts.join(domains, "domain", "left").select(F.struct("domain", "host").alias("place"), _smoothed(F.col("c"), F.coalesce("domain_prior", prior)).alias("host_prior"))

    # 2: the posterior of every row
    full = rows.mapInArrow(_scored(sent), StructType([*rows.schema.fields, scores]))
    full = full.withColumn("place", F.struct("domain", "host")).join(hosts, "place", "left")
    prior_of = F.coalesce("host_prior", prior)
    logs = F.zip_with("scores", prior_of, lambda s, p: s + F.log(p))
    if declared is not None:
        full = full.join(given("declared"), "declared", "left")
        logs = F.when(F.col("declared_logs").isNull(), logs).otherwise(F.zip_with(logs, "declared_logs", lambda a, b: a + b))
    if suffix is not None:
        full = full.join(given("suffix"), "suffix", "left")
        logs = F.when(F.col("suffix_logs").isNull(), logs).otherwise(F.zip_with(logs, "suffix_logs", lambda a, b: a + b))
    full = full.withColumn("logs", logs)
    best = F.array_max("logs")
    posterior = 1 / F.aggregate("logs", F.lit(0.0), lambda acc, x: acc + F.exp(x - best))
    language = F.get(names, _argmax(F.col("logs")).cast("int"))
    full = full.select(restored(docs, text), F.coalesce(language, F.lit(NO_LANGUAGE)).alias("language"), F.coalesce(posterior, F.lit(0.0)).alias("posterior"))
    return full.withColumn("kept", (F.col("language") != NO_LANGUAGE) & (F.col("posterior") >= MIN_POSTERIOR))


def identify_documents(docs: DataFrame, *, declared: str = "lang", host: str = "source", text: str = "text") -> DataFrame:
    """Documents: the declared language and the source as host; no address."""
    return identify(docs, text=text, declared=F.col(f"`{declared}`"), host=F.col(f"`{host}`"))


def accepted(docs: DataFrame, *, declared: str = "lang", **options) -> DataFrame:
    """The documents that have a language, which becomes their declared one."""
    found = identify_documents(docs, declared=declared, **options).filter("kept")
    return found.select(*[(F.col("language") if c == declared else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
