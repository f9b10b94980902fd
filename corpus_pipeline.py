"""The corpus pipeline: language ID, near-dedup, secret scans, mixing, packing.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet
and read again as the next one's documents.  All but the last return the columns
of ``documents``, and more columns of any name travel with them.

Defined results: a document without text, or with nothing but blanks, has no language
and goes in the first stage; a row without doc_id stays, is nobody's near-duplicate and is
mixed and packed like others; of rows that repeat a document one stays; a document without a
source is of a source of its own; a document of any length stays whole until it is packed in
pieces; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilth.llm import language, mixing, neardup, packing, secrets
from tilth.llm.text import table, word_count
from tilth.scratch import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language go; the others carry the language found."""
    return language.accepted(docs)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the row with the smallest doc_id stays."""
    return neardup.without_duplicates(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; every document stays."""
    return secrets.redacted(docs, path=F.col("source"))


def file_order(docs: DataFrame) -> list[Column]:
    """The place of a row in the files of a written table; none for other frames.

    Files are in the order of their numbers, which have more than five digits from the hundred thousandth file on.
    """
    number = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).try_cast("long")
    place = [number, F.col("_metadata.file_path"), F.col("_metadata.row_index")]
    try:
        docs.select(*place)
    except AnalysisException:  # not read from files
        return []
    return place


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per copy that the mix takes, in training order."""
    return mixing.mixed_documents(docs, word_count(F.col("text")), weights=(5, 2, 1), max_epochs=3)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences, in the order of the mix; see ``packing.SCHEMA``.

    The mix wrote its rows in training order, so the place in its files is that order.
    """
    from public_tokenizers import path

    return packing.pack_documents(docs, path("word_bpe_49k.json"), order=file_order(docs))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("minhash_near_dedup", remove_near_duplicates),
    ("secret_scan", mask_secrets),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL has neither the language model, nor the forest, nor the tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
