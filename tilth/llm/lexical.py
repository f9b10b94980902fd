"""Ranked lexical search by a length-stratified index.

A document's normaliser m depends on its length alone and takes few values, so documents of equal m
form a stratum.  Within it a posting list is ordered by tf, and the impact of a term, which
depends on tf and m only, is computed once per tf.  Strata are cut into pieces of bounded
documents and postings, so no length and no frequent term makes a large group.

A term's greatest tf in a stratum bounds its impact there, and so every item's score; these bounds
order the visits.  A first round scores each item in the pieces of its highest bounds.  The k-th score found is
a threshold: the second round visits the pieces whose bounds reach it and no others, and
returns no lower scores, so nothing is lost and little is returned.

The index posts the terms that the items ask for, over all documents.  Items are taken
in blocks of bounded text; each block is one scan of the documents.

Scores are 64-bit integers, see ``rank``.  Defined results: a document or item without a term is in no
result; a null text has none; rows that repeat a document or an item are ranked each, under
their own key; equal scores are ordered by ascending key, null last; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tilth.llm.text import bound_batches
from tilth.scratch import materialize

#: ASCII letters and digits make terms, with all characters beyond ASCII; A-Z are lower-cased.
_TERM = bytes(ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(128)) + bytes(range(128, 256))
#: Bytes of items in one block.
BLOCK_BYTES = 1 << 20
#: Documents and postings of a piece.
PIECE_DOCS, PIECE_POSTINGS = 2048, 1 << 18
#: Strata whose sizes are broadcast, 12 bytes each.
STRATA_AT_ONCE = 100_000
#: The share of documents, and the least number, in the strata of an item's first round.
FIRST_SHARE, FIRST_DOCS = 1 / 16, 1000
SCALE, TF, LENGTH = 1_000_000_000, 1000, 12
POSTED = "place long, doc_id long, n long, terms array<int>, tfs array<int>"
PIECE = "m long, piece int, docs array<long>, terms array<int>, sizes array<int>, run_terms array<int>, run_tfs array<int>, run_sizes array<int>, at array<int>"


def terms_of(data: bytes | None) -> list[bytes]:
    return data.translate(_TERM).split() if data else []


@dataclass
class Items:
    """A block of items: their keys, and per item the ids of its terms and how often it has each."""

    keys: list
    terms: list[bytes]
    ids: list[np.ndarray]
    times: list[np.ndarray]


def block_of(rows: Sequence[tuple]) -> Items:
    keys, known, ids, times = [], {}, [], []
    for key, data in rows:
        if got := Counter(terms_of(data)):
            keys.append(key)
            ids.append(np.array([known.setdefault(t, len(known)) for t in sorted(got)], np.int64))
            times.append(np.array([got[t] for t in sorted(got)], np.int64))
    return Items(keys, list(known), ids, times)


def _posting(terms: Sequence[bytes]):
    """Per document its length, and of the asked terms those it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = {t: i for i, t in enumerate(terms)}
        place = TaskContext.get().partitionId() << 33
        for batch in batches:
            rows = []
            for key, data in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if words := terms_of(data):
                    has = [(ids[t], c) for t, c in Counter(words).items() if t in ids]
                    rows.append((place, key, len(words), [x[0] for x in has], [x[1] for x in has]))
                place += 1
            if rows:
                types = pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], [c.split()[0] for c in POSTED.split(", ")])

    return run


def _piece(key: tuple, table: pa.Table) -> pa.Table:
    """Posting lists by tf of one piece: a run is a term and a tf, ``at`` the places of its documents."""
    m, piece = (x.as_py() for x in key)
    lists = table.column("terms").combine_chunks()
    term, tf = lists.flatten().to_numpy(), table.column("tfs").combine_chunks().flatten().to_numpy()
    doc = np.repeat(np.arange(len(table), dtype=np.int32), lists.value_lengths().to_numpy())
    order = np.lexsort((doc, tf, term))
    term, tf, doc = term[order], tf[order], doc[order]
    run = np.flatnonzero(np.diff(term, prepend=-1) | np.diff(tf, prepend=-1))
    own = np.flatnonzero(np.diff(term, prepend=-1))
    size = lambda starts: np.diff(starts, append=len(term))
    cells = [table.column("doc_id").to_pylist(), term[own], size(own), term[run], tf[run], size(run), doc]
    types = [pa.int64(), *[pa.int32()] * 6]
    return pa.table([pa.array([m], pa.int64()), pa.array([piece], pa.int32()), *(pa.array([c], pa.list_(t)) for c, t in zip(cells, types, strict=True))], names=[c.split()[0] for c in PIECE.split(", ")])


def build_index(docs: DataFrame, terms: Sequence[bytes], *, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, int, int]:
    """The pieces of all documents that have terms, with the number of these documents and of all their terms.

    ``terms`` are those posted.  A piece is one row of schema ``PIECE``.
    """
    bound_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(list(terms))
    slim = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("text"))
    posted = materialize(slim.mapInArrow(lambda batches: _posting(held.value)(batches), POSTED), "lexical-posted")
    n_docs, words = posted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_docs:
        return docs.sparkSession.createDataFrame([], PIECE), 0, 0
    posted = posted.withColumn("m", F.expr(f"75L + (25L * n * {n_docs}L) div {words}L"))
    sizes = posted.groupBy("m").agg(F.count("*").alias("docs"), F.sum(F.size("terms")).alias("postings"))
    sizes = sizes.select("m", F.greatest(F.ceil(F.col("docs") / PIECE_DOCS), F.ceil(F.col("postings") / PIECE_POSTINGS), F.lit(1)).cast("int").alias("pieces"))
    sizes = materialize(sizes, "lexical-sizes")
    few = sizes.count() <= STRATA_AT_ONCE  # beyond, a stratum is a small share of a join that Spark may split
    dealt = posted.join(F.broadcast(sizes) if few else sizes, "m").withColumn("piece", F.pmod(F.xxhash64("place"), F.col("pieces")).cast("int"))
    pieces = dealt.select("m", "piece", "doc_id", "terms", "tfs").groupBy("m", "piece").applyInArrow(_piece, PIECE)
    return materialize(pieces, "lexical-pieces"), n_docs, words


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, m: np.ndarray | int) -> np.ndarray:
    tf = tf.astype(np.int64)
    return SCALE * tf // (TF * tf + LENGTH * m)


@dataclass
class Asked:
    """What tasks need of the items: the terms of all, one after another, and weights that hold repeats.

    Per item, pieces of bounds from ``since`` to under ``below`` are visited, and scores of ``least`` wanted.
    """

    terms: np.ndarray
    weights: np.ndarray
    starts: np.ndarray
    n_terms: int
    since: np.ndarray
    below: np.ndarray
    least: np.ndarray

    def bounds(self, terms: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The greatest score of each item where the terms have these impacts at most."""
        by_term = np.zeros(self.n_terms, np.int64)
        by_term[terms] = most
        return np.add.reduceat(self.weights * by_term[self.terms], self.starts)


def _bounding(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: Asked = held.value
        for batch in batches:
            for m, docs, most in zip(*(batch.column(c).to_pylist() for c in ("m", "docs", "most")), strict=True):
                got = asked.bounds(np.array([x["term"] for x in most]), impacts(np.array([x["tf"] for x in most]), m))
                found = np.flatnonzero(got)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(got[found]), pa.array(np.full(len(found), docs))], ["item", "bound", "docs"])

    return run


def _ranking(held, k: int):
    """Scores of every item in the pieces whose bounds are in its range, at most ``k`` a piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: Asked = held.value
        least = np.maximum(asked.least, 1)  # rises with what this task finds
        best = [np.empty(0, np.int64)] * len(least)
        ends = np.append(asked.starts[1:], len(asked.terms))
        for batch in batches:
            for at in range(batch.num_rows):
                cell = lambda c: batch.column(c)[at].values.to_numpy(zero_copy_only=False)  # noqa: B023, E731
                m, terms, tfs, docs = batch.column("m")[at].as_py(), cell("terms"), cell("run_tfs"), batch.column("docs")[at].values
                if not len(terms):
                    continue
                by_run = impacts(tfs, m)  # once per term and tf
                by_posting, doc = np.repeat(by_run, cell("run_sizes")), cell("at")
                begins = np.concatenate([[0], np.cumsum(cell("sizes"))])
                # runs ascend by tf, so the last of a term has its greatest impact
                bounds = asked.bounds(terms, by_posting[begins[1:] - 1])
                place = np.full(asked.n_terms, -1)
                place[terms] = np.arange(len(terms))
                keys = docs.to_numpy(zero_copy_only=False) if not docs.null_count else docs.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
                rows: list[tuple] = []
                for item in np.flatnonzero((bounds >= np.maximum(least, asked.since)) & (bounds < asked.below)):
                    score = np.zeros(len(docs), np.int64)
                    own = slice(asked.starts[item], ends[item])
                    for t, w in zip(place[asked.terms[own]], asked.weights[own], strict=True):
                        if t >= 0:
                            part = slice(begins[t], begins[t + 1])
                            score[doc[part]] += w * by_posting[part]
                    found = np.flatnonzero(score >= least[item])
                    if len(found) > k:
                        found = found[np.lexsort((keys[found], -score[found]))[:k]]
                    if len(found):
                        rows.append((item, score[found], found))
                        best[item] = np.sort(np.concatenate([best[item], score[found]]))[-k:]
                        if len(best[item]) == k:
                            least[item] = max(least[item], best[item][0])
                if rows:
                    item = np.repeat(np.array([r[0] for r in rows], np.int32), [len(r[1]) for r in rows])
                    found = pa.array(np.concatenate([r[2] for r in rows]))
                    yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(np.concatenate([r[1] for r in rows])), docs.take(found)], ["item", "score", "doc_id"])

    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: Items, k: int, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(item, rank, doc_id, score) of one block; ``item`` is the number of a key."""
    spark = docs.sparkSession
    pieces, n_docs, _ = build_index(docs, items.terms, key=key, text=text)
    schema = "item int, score long, doc_id long"
    each = pieces.select("m", F.explode(F.arrays_zip("run_terms", "run_tfs", "run_sizes")).alias("x"))
    strata = materialize(each.groupBy("m", F.col("x.run_terms").alias("term")).agg(F.max("x.run_tfs").alias("tf"), F.sum("x.run_sizes").alias("df")), "lexical-strata")
    # at most the terms of a block of items
    df = dict(strata.groupBy("term").agg(F.sum("df").alias("df")).collect())
    by_term = np.array([weight(n_docs, df.get(t, 0)) for t in range(len(items.terms))], np.int64)
    sizes = [len(x) for x in items.ids]
    ids = np.concatenate(items.ids)
    none, every = np.zeros(len(sizes), np.int64), np.full(len(sizes), np.iinfo(np.int64).max)
    asked = Asked(ids, by_term[ids] * np.concatenate(items.times), np.cumsum([0, *sizes[:-1]]), len(items.terms), none, every, none)
    send = spark.sparkContext.broadcast
    docs_of = pieces.groupBy("m").agg(F.sum(F.size("docs")).alias("docs"))
    most = strata.groupBy("m").agg(F.collect_list(F.struct("term", "tf")).alias("most"))  # at most a row per term
    bounds = docs_of.join(most, "m").mapInArrow(_bounding(send(asked)), "item int, bound long, docs long")
    order = Window.partitionBy("item").orderBy(F.col("bound").desc())
    before = F.sum("docs").over(order.rowsBetween(Window.unboundedPreceding, -1))
    first = bounds.withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < max(FIRST_DOCS, FIRST_SHARE * n_docs))
    since, least = none.copy(), none.copy()
    for item, bound in first.groupBy("item").agg(F.min("bound")).collect():  # a row per item of the block
        since[item] = bound
    one = materialize(_top(pieces.mapInArrow(_ranking(send(replace(asked, since=since)), k), schema), k), "lexical-first")
    for item, score in one.filter(F.col("rank") == k).select("item", "score").collect():
        least[item] = score
    two = pieces.mapInArrow(_ranking(send(replace(asked, below=since, least=least)), k), schema)
    return _top(one.drop("rank").unionByName(two), k)


def rank(docs: DataFrame, items: DataFrame, *, k: int = 20, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The ``k`` best documents of every item: (``item``, rank, doc_id, score).

    With N documents that have terms, L of their terms, and n of one document, a term of
    df documents weighs w = floor(1000 ln((2N + 2) / (2 df + 1))), a document's normaliser is
    m = 75 + 25 n N div L, and the score sums w * (10^9 tf div (1000 tf + 12 m)) over the item's terms, repeats included.
    """
    spark = docs.sparkSession
    kind = items.schema[item].dataType
    slim = items.select(F.col(f"`{item}`").alias("key"), F.col(f"`{item_text}`").cast("binary").alias("text")).filter("length(text) > 0")
    total = slim.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // BLOCK_BYTES))
    out = None
    for b in range(blocks):
        part = slim.filter(F.pmod(F.xxhash64("key", "text"), F.lit(blocks)) == b)
        block = block_of([(r["key"], bytes(r["text"])) for r in part.orderBy("key", "text").collect()])
        if not block.keys:
            continue
        keys = spark.createDataFrame(list(enumerate(block.keys)), f"item int, `{item}` {kind.simpleString()}")
        got = search(docs, block, k, key=key, text=text).join(F.broadcast(keys), "item").select(F.col(f"`{item}`"), "rank", "doc_id", "score")
        out = got if out is None else out.unionByName(got)
    return spark.createDataFrame([], f"`{item}` {kind.simpleString()}, rank int, doc_id long, score long") if out is None else out
