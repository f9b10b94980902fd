"""Alignment of two tokenizers' tokens of the same texts.

Both tokenizers encode a blank and the text.  Where a token of each ends at the same byte
there is a shared cut; cuts part a text into groups, and the two tokens that end at a cut
are linked.  Cuts are found by divide and conquer (``shared_cuts``): a common end near the middle is
located by bisection, both sides are done likewise, and an interval without a common end is a group.

A vocabulary that never joins a visible character with white space after it has a cut there in
every text.  If both are so, texts are divided at these cuts first, and a worker remembers the
alignment of each such cell; otherwise a text is one cell.  How many links of the whole corpus hold
a pair of ids is counted by Spark; the counts come back to the documents in blocks of pairs.

Defined results: a null or empty text, and one that the tokens of a tokenizer do not spell again
byte by byte, has no tokens; strings of special tokens are plain text; a null key is carried;
repeated rows are aligned each and counted each; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.llm.text import bound_batches, hold_worker
from tilth.scratch import materialize

SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, groups string, pairs array<long>, times array<int>"
#: Cells, and the longest of them in characters, that a worker remembers.
REMEMBERED, LONGEST = 200_000, 48
#: Bytes of groups in one batch of results.
OUT_BYTES = 16 << 20
#: Counted pairs of ids that a worker holds at once.
PAIRS_AT_ONCE = 4_000_000
#: Fixed value: how byte-level vocabularies split texts.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of texts whose new cells are encoded together.
TOGETHER = 1 << 18
#: A blank or line feed after a visible character starts a cell.
CELL = re.compile(r"[ \n]\s*\S*(?:[^\S \n]\s*\S*)*")
#: The bit of a cell that is not spelt as it was, above its two counts of tokens.
_ALTERED = 1 << 80


@dataclass
class Vocabulary:
    """``encode`` gives the ids of texts that start with a blank or a line feed; ``data`` are the bytes of each id."""

    encode: Callable[[Sequence[str]], list[list[int]]]
    data: list[bytes]
    #: No token holds a visible character and a blank or line feed after it.
    parts_at_blanks: bool

    def __post_init__(self) -> None:
        self.texts = list(map(str, range(len(self.data))))  # ids in decimals


def _byte_level(path: str) -> Vocabulary:
    """Texts of a few letters are encoded by ranks, which gives the same ids where merges are numbered in their order."""
    from tiktoken import Encoding
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    spec = json.loads(t.to_str())
    # the 188 printable bytes stand for themselves, the others for the code points from 256 on
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)).difference(plain)))}
    data = [b""] * t.get_vocab_size()
    for entry, i in t.get_vocab(with_added_tokens=False).items():
        data[i] = bytes(byte[c] for c in entry)
    first = spec["pre_tokenizer"] or {}
    parts = spec["normalizer"] is None and first.get("type") == "ByteLevel" and first["use_regex"] and not first["add_prefix_space"]
    vocab, model = t.get_vocab(with_added_tokens=False), spec["model"]
    merged = [vocab["".join(m)] for m in (x if isinstance(x, list) else x.split(" ") for x in model["merges"])]
    if parts and merged == list(range(256, 256 + len(merged))) and not (model["dropout"] or model["ignore_merges"] or model["continuing_subword_prefix"] or model["end_of_word_suffix"]):
        encode = Encoding("ranks", pat_str=SPLIT, mergeable_ranks={data[i]: i for i in vocab.values() if i < 256 + len(merged)}, special_tokens={}).encode_ordinary
        return Vocabulary(lambda texts: list(map(encode, texts)), data, True)
    return Vocabulary(lambda texts: [x.ids for x in t.encode_batch_fast(list(texts), add_special_tokens=False)], data, bool(parts))


def _pieces(path: str) -> Vocabulary:
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    data = [bytes([int(p[3:-1], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]

    def encode(texts: Sequence[str]) -> list[list[int]]:
        """It puts a blank before what it encodes, which is a token of its own before a line feed."""
        got = sp.encode([x[1:] if x.startswith(" ") else x for x in texts], num_threads=1)
        return [ids if x.startswith(" ") else ids[1:] for ids, x in zip(got, texts, strict=True)]

    return Vocabulary(encode, data, not any(re.search("[^▁]▁|\n", p) for p in pieces))


def load(path: str) -> Vocabulary:
    """A byte-level vocabulary (``.json``) or a model of pieces (``.model``)."""
    return _pieces(path) if path.endswith(".model") else _byte_level(path)


def shared_cuts(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """How many tokens of each side lie before each cut, in order.

    ``a`` and ``b`` are the ascending ends of tokens; the last ends must be equal.
    """
    cuts, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        low = high = (a0 + a1) >> 1
        last = b1 - 1
        # outwards from the middle, a token on either side at a time
        while last > b0 and (low > a0 or high < a1):
            if low > a0:
                j = bisect_left(b, a[low - 1], b0, last)
                if j < last and b[j] == a[low - 1] and low < a1:
                    todo += [(low, a1, j + 1, b1), (a0, low, b0, j + 1)]
                    break
                low -= 1
            high += 1
            if high < a1:
                j = bisect_left(b, a[high - 1], b0, last)
                if j < last and b[j] == a[high - 1]:
                    todo += [(high, a1, j + 1, b1), (a0, high, b0, j + 1)]
                    break
        else:
            cuts.append((a1, b1))
    return cuts


@dataclass
class Aligner:
    """Two vocabularies and the cells that this worker remembers: counts, groups and links of each."""

    a: Vocabulary
    b: Vocabulary
    known: dict[str, tuple[int, bytes, bytes]] = field(default_factory=dict)
    older: dict[str, tuple[int, bytes, bytes]] = field(default_factory=dict)

    def cells(self, text: str) -> list[str]:
        return CELL.findall(text) if self.a.parts_at_blanks and self.b.parts_at_blanks else [text]

    def aligned(self, cells: Sequence[str]) -> Iterator[tuple[int, bytes, bytes]]:
        da, db, ta, tb = self.a.data, self.b.data, self.a.texts, self.b.texts
        for cell, ia, ib in zip(cells, self.a.encode(cells), self.b.encode(cells), strict=True):
            xa, xb, data = [da[i] for i in ia], [db[i] for i in ib], cell.encode()
            if b"".join(xa) != data or b"".join(xb) != data:
                yield _ALTERED, b"", b""
                continue
            groups, links, i0, j0 = [], [], 0, 0
            for i, j in shared_cuts(list(accumulate(map(len, xa))), list(accumulate(map(len, xb)))) if len(xa) > 1 < len(xb) else ((len(xa), len(xb)),):
                left = ta[ia[i0]] if i - i0 == 1 else ",".join([ta[x] for x in ia[i0:i]])
                groups.append(f"{left}|{tb[ib[j0]]}" if j - j0 == 1 else f"{left}|{','.join([tb[x] for x in ib[j0:j]])}")
                links.append(ia[i - 1] << 32 | ib[j - 1])
                i0, j0 = i, j
            yield len(ia) << 40 | len(ib), ";".join(groups).encode(), array("q", links).tobytes()

    def remember(self, cells: set[str]) -> None:
        """Makes ``known`` hold these cells; frequent ones come back from the older half."""
        new = cells.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.older, self.known = self.known, {}
            new = cells
        back = {x: self.older[x] for x in new if x in self.older}
        self.known.update(back)
        rest = list(new.difference(back))
        self.known.update(zip(rest, self.aligned(rest), strict=True))

    def documents(self, texts: Sequence[str | None]) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
        """Of each text the tokens of each side, the groups, and the links as pairs of ids in one number."""
        some, size = [], 0
        for text in texts:
            some.append(text)
            size += len(text or "")
            if size >= TOGETHER:
                yield from self._documents(some)
                some, size = [], 0
        yield from self._documents(some)

    def _documents(self, texts: Sequence[str | None]) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
        split = [self.cells(" " + t) if t else [] for t in texts]
        every = set().union(*split)
        long = [x for x in every if len(x) > LONGEST]
        every.difference_update(long)
        if not every <= self.known.keys():
            self.remember(every)
        own = dict(zip(long, self.aligned(long), strict=True)) if long else {}
        for text, cells in zip(texts, split, strict=True):
            got = [self.known.get(x) or own[x] for x in cells] if own else list(map(self.known.__getitem__, cells))
            counts = sum([x[0] for x in got])
            if counts >= _ALTERED:  # perhaps only cell by cell
                got = list(self.aligned([" " + text]))
                if (counts := got[0][0]) >= _ALTERED:
                    got, counts = [], 0
            yield counts >> 40, counts & (1 << 40) - 1, b";".join([x[1] for x in got]), np.frombuffer(b"".join([x[2] for x in got]), np.int64)


_LOADED: dict[tuple[str, str], Aligner] = {}


def aligner(a: str, b: str) -> Aligner:
    if (a, b) not in _LOADED:
        _LOADED[a, b] = Aligner(load(a), load(b))
    return _LOADED[a, b]


def _task(a: str, b: str):
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        keys, n_a, n_b, n_links, groups, pairs, times = zip(*rows, strict=True)
        offsets = pa.array(np.cumsum([0, *map(len, pairs)]), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x), t)) for x, t in ((pairs, pa.int64()), (times, pa.int32()))]
        plain = [pa.array(x, pa.int64()) for x in (keys, n_a, n_b, n_links)]
        return pa.RecordBatch.from_arrays([*plain, pa.array([x.decode() for x in groups], pa.string()), *lists], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_worker("alignment", _LOADED.clear)
        own = aligner(a, b)
        for batch in batches:
            rows, held = [], 0
            for key, (n_a, n_b, groups, links) in zip(batch.column("doc_id").to_pylist(), own.documents(batch.column("text").to_pylist()), strict=True):
                pairs, times = np.unique(links, return_counts=True)
                rows.append((key, n_a, n_b, len(links), groups, pairs, times))
                held += len(groups) + 12 * len(pairs)
                if held >= OUT_BYTES:
                    yield made(rows)
                    rows, held = [], 0
            if rows:
                yield made(rows)

    return run


def align_documents(docs: DataFrame, a: str, b: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document; ``a`` and ``b`` are paths of vocabulary files on every node.

    ``groups`` has the ids of both sides in order, as ``a1,a2|b1;a3|b2,b3``.  ``pairs`` are the
    different linked pairs, A's id in the upper 32 bits and B's in the lower, and ``times`` how
    often each is linked here.  Nothing is shuffled.
    """
    bound_batches(docs.sparkSession)
    slim = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return slim.mapInArrow(_task(a, b), SCHEMA)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, best): links of the corpus that hold a pair, and whether no pair of its B id has more."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("count"))
    each = each.withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF).cast("long")))
    most = each.groupBy("b").agg(F.max("count").alias("most"))
    return each.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def _scored(block, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, count, best = block.value
        for batch in batches:
            lists = batch.column("pairs")
            asked, times = lists.flatten().to_numpy(zero_copy_only=False), batch.column("times").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.minimum(np.searchsorted(pair, asked), len(pair) - 1)
            times[pair[at] != asked] = 0  # of another block
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            added = {}
            for name, values in (("n_best", times * best[at]), ("count_sum", times * count[at])):
                upto = np.concatenate([[0], np.cumsum(values)])
                added[name] = batch.column(name).to_numpy(zero_copy_only=False) + upto[ends] - upto[np.concatenate([[0], ends[:-1]]).astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(added[f.name], pa.int64()) if f.name in added else batch.column(f.name) for f in schema], schema.names)

    return run


def with_corpus_counts(aligned: DataFrame, *, at_once: int = PAIRS_AT_ONCE) -> DataFrame:
    """``aligned`` with ``n_best`` and ``count_sum`` over each row's links.

    ``aligned`` is read more than once and should be a written table.  Pairs come to the workers
    in blocks of about ``at_once``; each block adds its part to the sums of every row.
    """
    spark = aligned.sparkSession
    counts = materialize(pair_counts(aligned), "pair-counts")
    blocks = max(1, -(-counts.count() // at_once))
    out = aligned.withColumns({"n_best": F.lit(0).cast("long"), "count_sum": F.lit(0).cast("long")})
    fields = pa.schema([(c, pa.int64()) for c in out.columns])  # names and their order; types are Spark's
    for k in range(blocks):
        part = counts.filter(F.pmod(F.xxhash64("pair"), F.lit(blocks)) == k).toArrow().sort_by("pair")
        if part.num_rows:
            held = spark.sparkContext.broadcast(tuple(part.column(c).to_numpy() for c in ("pair", "count", "best")))
            out = out.mapInArrow(_scored(held, fields), out.schema)
            out = materialize(out, "pair-sums") if k < blocks - 1 else out
    return out
