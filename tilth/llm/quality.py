"""Quality rules by n-gram perplexity, after a base of counting rules.

A text is read as a stream of letters with one mark between words, so contexts reach
from a word into the next.  The stream is counted in pieces, which repeat more than texts do:
each word between its marks, and each joint of two words, the last letters of
one and the first of the next.  Spark counts the pieces over all documents and languages;
their n-grams, each of which lies in one piece only, give an interpolated modified
Kneser-Ney model (Chen & Goodman 1998): raw counts at the highest order,
continuation counts below, three discounts per order and language from counts
of counts.  The model is a set of sorted hash arrays, one of n-gram
probabilities and one of context weights per order, looked up by binary search.
A text's score is its cross-entropy in bits per letter, that is the logarithm
of its perplexity.

Each language has a lower and an upper band, quartiles of its own scores
widened by ``BAND`` times their distance; texts outside it are rejected.  All
documents take part in the counts and in the bands, and both follow the input.

The arrays are sorted by kind, language and hash and cut into shards of about ``SHARD_ENTRIES``
entries, a file each in the shared scratch folder.  Tasks know where each shard begins and read
those that their texts ask for; a worker holds at most ``HELD_ENTRIES`` of them and lets the one go that was
used longest ago.  So neither the driver nor any task holds the whole model, whatever its size.

Defined results: a null text has no words, zero counts and fails the base rules;
a null language is a language of its own, and so is an empty one; a language whose scores are all alike
rejects nothing that has this score; repeated rows count each; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilth.llm import shingles as S
from tilth.llm.text import bound_batches, hold_worker
from tilth.llm.warc import store
from tilth.scratch import discard, materialize

ORDER = 4
#: Entries of a shard of the model, and of the shards that a worker holds (12 bytes each).
SHARD_ENTRIES = 1 << 20
HELD_ENTRIES = 8 << 20
#: Of the labelled documents of sf0.1 that pass the base rules, 13 % of the poor and 0.9 % of the good are
#: outside; of texts of shuffled or random letters all are, of shuffled words 5 %.
BAND = 4.0
MIN_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8
#: Languages whose figures are broadcast; more are joined by shuffle.
BROADCAST_LANGUAGES = 10_000
#: Pieces that a task counts, or a worker remembers, before it starts anew.
HELD = 200_000
#: Documents that are counted or scored at once.
CHUNK = 512
#: Characters of a part of a text.
PART = 1 << 19
#: Stands before, between and after words.
MARK = "\x02"
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_SPACE = re.compile(r"\s")
_LINE = re.compile(r"[^\x20\x09-\x0D]")


@dataclass
class Part:
    """Words of a text in a row, with the one before them."""

    row: int
    before: str
    words: list[str]


def parts(row: int, text: str | None) -> Iterator[Part]:
    """A text's lower-cased words, at most about ``PART`` characters at a time."""
    text = (text or "").lower().replace(MARK, "\x01")
    at, before = 0, ""
    while at < len(text):
        space = _SPACE.search(text, at + PART)
        end = space.start() if space else len(text)
        if words := text[at:end].split():
            yield Part(row, before, words)
            before = words[-1]
        at = end


def chunks(rows: list[int], texts: list[str | None]) -> Iterator[list[Part]]:
    """The parts of texts in lists of bounded rows and characters."""
    out: list[Part] = []
    size = 0
    for row in rows:
        for part in parts(row, texts[row]):
            out.append(part)
            size += PART // CHUNK + min(PART, len(texts[row] or ""))
            if size >= PART:
                yield out
                out, size = [], 0
    if out:
        yield out


class Joints:
    """The joints of words with those before them: ``reach`` symbols on each side of a mark.

    Before the first word and after a short one there are more marks.  ``marks`` has the
    mark of each joint in ``points``, in the order of parts and words.  Without a reach there
    is nothing in a joint.
    """

    def __init__(self, some: list[Part], reach: int):
        self.reach = reach
        counts = [len(p.words) for p in some]
        #: The part of each word, and its letters with the mark after it.
        self.owner = np.repeat(np.arange(len(some)), counts)
        self.sizes = np.fromiter(map(len, chain.from_iterable([p.words for p in some])), np.int64, sum(counts)) + 1
        self.stream = "".join([f"{p.before[-reach:] if reach else '':{MARK}>{reach}}{MARK}{MARK.join(p.words)}{MARK * reach}" for p in some])
        self.points = np.frombuffer(self.stream.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        self.marks = np.cumsum(self.sizes) - self.sizes + reach * (2 * self.owner + 1)
        h = np.zeros(len(self.marks), np.uint64)
        for i in range(-reach, reach + 1):
            h += self.points[self.marks + i] * S._STEP[i + reach]
        _, first, self.kind, self.counts = np.unique(S.mixed(h), return_index=True, return_inverse=True, return_counts=True)
        #: The mark of one joint of each kind.
        self.first = self.marks[first]

    def names(self) -> list[str]:
        return [self.stream[i - self.reach : i + self.reach + 1] for i in self.first.tolist()]


def pieces(texts: list[str | None], order: int = ORDER, rows: list[int] | None = None) -> Counter:
    """The pieces of texts, or of some rows of them, and how often they occur; a word is one between two marks."""
    out: Counter = Counter()
    for some in chunks(list(range(len(texts))) if rows is None else rows, texts):
        for w, n in Counter(chain.from_iterable([p.words for p in some])).items():
            out[f"{MARK}{w}{MARK}"] += n
        joints = Joints(some, order - 2)
        for name, n in zip(joints.names(), joints.counts.tolist(), strict=True):
            if joints.reach:
                out[name] += n
    return out


def _counted(order: int):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            langs, names = zip(*held, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(names, pa.string()), pa.array(list(held.values()), pa.int64())], ["lang", "piece", "n"])

        held: dict[tuple[str, str], int] = {}
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for lang, rows in _by_value(batch.column("lang").to_pylist()).items():
                for at in range(0, len(rows), CHUNK):
                    for piece, n in pieces(texts, order, rows[at : at + CHUNK]).items():
                        key = (lang, piece)
                        held[key] = held.get(key, 0) + n
                    if len(held) > HELD:
                        yield out()
                        held = {}
        if held:
            yield out()

    return made


def _by_value(values: list[str]) -> dict[str, list[int]]:
    out: dict[str, list[int]] = {}
    for i, v in enumerate(values):
        out.setdefault(v, []).append(i)
    return out


def _grams(order: int) -> Column:
    """The n-grams of a piece."""
    n = F.length("piece") - (order - 1)
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.substring("piece", i, F.lit(order))))


def _by_language(df: DataFrame) -> DataFrame:
    """A table with one row per language, broadcast if these are few."""
    df = materialize(df, "ngram-languages")
    return F.broadcast(df) if df.count() <= BROADCAST_LANGUAGES else df


def kneser_ney(counted: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, kind, gram, value) from (lang, piece, n): natural logarithms.

    ``kind`` is the length of an n-gram for probabilities and minus the length of
    a context for its back-off weight; the unknown symbol has kind 0.
    """
    top = counted.select("lang", "n", F.explode(_grams(order)).alias("gram")).groupBy("lang", "gram").agg(F.sum("n").alias("c"))
    tables = {order: materialize(top, "ngram-counts")}
    for k in range(order - 1, 0, -1):
        tables[k] = materialize(tables[k + 1].groupBy("lang", F.substring("gram", 2, k).alias("gram")).agg(F.count(F.lit(1)).alias("c")), "ngram-counts")

    unknown = _by_language(tables[1].groupBy("lang").agg((-F.log(F.count(F.lit(1)) + 1.0)).alias("value")))
    parts = [unknown.select("lang", F.lit(0).alias("kind"), F.lit("").alias("gram"), "value")]
    lower = unknown.select("lang", F.lit("").alias("suffix"), F.exp("value").alias("below"))
    for k in range(1, order + 1):
        t = tables[k].select("lang", "gram", F.col("c").cast("double").alias("c"), F.substring("gram", 1, k - 1).alias("context"), F.substring("gram", 2, k - 1).alias("suffix"))
        ones = [F.sum((F.col("c") == i).cast("double")).alias(f"n{i}") for i in (1, 2, 3, 4)]
        y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))
        usual = {i: i - (i + 1) * y * F.try_divide(F.col(f"n{i + 1}"), F.col(f"n{i}")) for i in (1, 2, 3)}
        cuts = [F.when(d.isNull(), i / 2).otherwise(F.greatest(F.lit(0.1), F.least(F.lit(i - 0.1), d))).alias(f"d{i}") for i, d in usual.items()]
        discounts = _by_language(t.groupBy("lang").agg(*ones).select("lang", *cuts))
        d = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        t = t.join(discounts, "lang").withColumn("d", d)
        contexts = t.groupBy("lang", "context").agg(F.sum("c").alias("total"), F.sum("d").alias("freed"))
        if k == 1:  # one context and one suffix, both empty, in a language
            contexts = _by_language(contexts)
            t = t.join(contexts.drop("context"), "lang").join(lower.drop("suffix"), "lang")
        else:
            t = t.join(contexts, ["lang", "context"]).join(lower, ["lang", "suffix"])
        gamma = F.col("freed") / F.col("total")
        p = materialize(t.select("lang", "gram", ((F.col("c") - F.col("d")) / F.col("total") + gamma * F.col("below")).alias("p")), "ngram-order")
        parts.append(p.select("lang", F.lit(k).alias("kind"), "gram", F.log("p").alias("value")))
        parts.append(contexts.select("lang", F.lit(1 - k).alias("kind"), F.col("context").alias("gram"), F.log(gamma).alias("value")).filter(F.lit(k > 1)))
        lower = p.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("below"))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def _lang_seed(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little"))


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and each one's length."""
    sizes = np.array([len(t) for t in texts], np.int64)
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64), sizes


def _hashes(points: np.ndarray, ends: np.ndarray, k: int, seed) -> np.ndarray:
    """The hash of the k code points that end at each place."""
    h = np.zeros(len(ends), np.uint64) + seed + np.uint64(k)
    for i in range(k):
        h = h + points[ends - i] * S._STEP[i]
    return S.mixed(h)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kinds, langs, grams = batch.column("kind").to_numpy(zero_copy_only=False), batch.column("lang").to_pylist(), batch.column("gram").to_pylist()
        points, sizes = _points(grams)
        last = np.cumsum(sizes) - 1
        named = {x: _lang_seed(x) for x in set(langs)}
        seeds = np.array([named[x] for x in langs], np.uint64)
        h = np.zeros(len(kinds), np.uint64)
        for k in np.unique(sizes):
            at = np.flatnonzero(sizes == k)
            h[at] = _hashes(points, last[at], int(k), seeds[at])
        yield pa.RecordBatch.from_arrays([batch.column("kind"), pa.array(seeds.view(np.int64)), pa.array(h.view(np.int64)), pa.array(batch.column("value").to_numpy(zero_copy_only=False).astype(np.float32))], ["kind", "lang", "hash", "value"])


@dataclass(frozen=True)
class Slice:
    """The sorted entries of one kind and language in a shard: where they begin and end, and their least hash."""

    file: str
    begin: int
    end: int
    least: int


#: Shards that this worker read, by file; the one used last is last.
_SHARDS: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def _shard(file: str, held: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes and values of a shard, read if this worker does not hold it."""
    found = _SHARDS.pop(file, None)
    if found is None:
        files, path = store(file)
        with files.open_input_file(path) as f:
            got = pq.ParquetFile(f).read(columns=["hash", "value"], use_threads=False)
        found = got["hash"].to_numpy(), got["value"].to_numpy()
        while _SHARDS and sum(len(x) for x, _ in _SHARDS.values()) + len(found[0]) > held:
            del _SHARDS[next(iter(_SHARDS))]
    _SHARDS[file] = found
    return found


@dataclass
class Model:
    """Sorted hash arrays by kind and language, in shards; see :func:`store_model`."""

    order: int
    slices: dict[tuple[int, int], list[Slice]]
    held: int = HELD_ENTRIES

    def find(self, kind: int, seed: np.uint64, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes have an entry of a kind in a language, and their values, by binary search in each shard."""
        hit, values, h = np.zeros(len(h), bool), np.zeros(len(h)), h.view(np.int64)
        slices = self.slices.get((kind, int(seed.view(np.int64))), [])
        where = np.searchsorted(np.array([x.least for x in slices], np.int64), h, "right") - 1
        for i, part in enumerate(slices):
            mine = np.flatnonzero(where == i) if len(slices) > 1 else np.arange(len(h))
            if not len(mine):
                continue
            hashes, kept = _shard(part.file, self.held)
            known = hashes[part.begin : part.end]
            at = np.minimum(np.searchsorted(known, h[mine]), len(known) - 1)
            hit[mine], values[mine] = known[at] == h[mine], kept[part.begin : part.end][at]
        return hit, values

    def at(self, lang: str, points: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The logarithm of the probability of the symbols at ``ends``, after those before them."""
        seed = _lang_seed(lang)
        total, open_ = np.zeros(len(ends)), np.arange(len(ends))
        for k in range(self.order, 0, -1):
            if not len(open_):
                break
            hit, value = self.find(k, seed, _hashes(points, ends[open_], k, seed))
            total[open_[hit]] += value[hit]
            open_ = open_[~hit]
            if k > 1 and len(open_):
                seen, weight = self.find(1 - k, seed, _hashes(points, ends[open_] - 1, k - 1, seed))
                total[open_] += np.where(seen, weight, 0.0)
        if len(open_):
            hit, value = self.find(0, seed, _hashes(points, ends[open_], 0, seed))
            total[open_] += np.where(hit, value, -np.log(256.0))
        return total

    def words(self, lang: str, read: list[str]) -> np.ndarray:
        """Of each word and the mark after it, what its joint does not hold."""
        points, sizes = _points([f"{MARK}{w}{MARK}" for w in read])
        starts = np.cumsum(sizes) - sizes
        counts = np.maximum(sizes - (self.order - 1), 0)
        owner = np.repeat(np.arange(len(read)), counts)
        ends = np.arange(len(owner)) - (np.cumsum(counts) - counts)[owner] + starts[owner] + self.order - 1
        return np.bincount(owner, self.at(lang, points, ends), len(read))

    def joints(self, lang: str, joints: Joints) -> np.ndarray:
        """Of each joint, the symbols after its mark."""
        kinds = np.zeros(len(joints.first))
        for i in range(1, joints.reach + 1):
            kinds += self.at(lang, joints.points, joints.first + i)
        return kinds[joints.kind]


def _languages(docs: DataFrame, lang: str) -> Column:
    """The language as a string that is never null; "0" is null, "1" stands before others."""
    return F.coalesce(F.concat(F.lit("1"), F.col(f"`{lang}`").cast("string")), F.lit("0"))


def count_pieces(docs: DataFrame, text: str, lang: str, order: int = ORDER) -> DataFrame:
    """(lang, piece, n) over all documents."""
    slim = docs.select(_languages(docs, lang).alias("lang"), F.col(f"`{text}`").alias("text"))
    found = slim.mapInArrow(_counted(order), "lang string, piece string, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
    return materialize(found, "piece-counts")


def store_model(grams: DataFrame, order: int, shard: int = SHARD_ENTRIES, held: int = HELD_ENTRIES) -> Model:
    """Hash the n-grams of :func:`kneser_ney`, sort them and write them in shards; one row per kind and language of each comes back."""
    spark = grams.sparkSession
    table = materialize(grams.mapInArrow(_hashed, "kind int, lang long, hash long, value float"), "ngram-model")
    parts = max(1, -(-table.count() // shard))
    arrays = materialize(table.repartitionByRange(parts, "kind", "lang", "hash").sortWithinPartitions("kind", "lang", "hash"), "ngram-arrays")
    discard(spark, table.scratch)
    found = arrays.groupBy(F.col("_metadata.file_path").alias("file"), "kind", "lang").agg(F.min("hash").alias("least"), F.count(F.lit(1)).alias("n")).collect()
    slices: dict[tuple[int, int], list[Slice]] = {}
    file, end = None, 0
    for x in sorted(found, key=lambda x: (x["file"], x["kind"], x["lang"])):
        begin = end if x["file"] == file else 0
        file, end = x["file"], begin + x["n"]
        slices.setdefault((x["kind"], x["lang"]), []).append(Slice(file, begin, end, x["least"]))
    for some in slices.values():
        some.sort(key=lambda x: x.least)
    return Model(order, slices, held)


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    b = np.frombuffer(data, np.uint8)
    words = S.word_hashes(text, lower=False)
    chars = int((~S._SPACE[b] & ((b & 0xC0) != 0x80)).sum())
    lines = Counter(x for x in (text or "").split("\n") if _LINE.search(x))
    h = S.windows(words, WINDOW)
    covered = 0
    if len(h) > 1:
        _, where, many = np.unique(h, return_inverse=True, return_counts=True)
        twice = many[where] > 1
        if twice.any():
            edge = np.zeros(len(words) + 1, np.int64)
            at = np.flatnonzero(twice)
            edge[at] += 1
            edge[at + WINDOW] -= 1
            covered = int((np.cumsum(edge) > 0).sum())
    return len(words), chars, int(_SYMBOLS[b].sum()), sum(lines.values()) - len(lines), covered


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
COUNTS = ", ".join(f"{c} long" for c in NAMES)


def _base_columns(texts: list[str | None]) -> list[pa.Array]:
    cols = list(zip(*[base_counts(t) for t in texts], strict=True)) if texts else [[]] * len(NAMES)
    return [pa.array(c, pa.int64()) for c in cols]


def _scored(model: Broadcast[Model]):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_worker("quality", _SHARDS.clear)
        m = model.value
        known: dict[str, dict[str, float]] = {}  # words that were looked up before
        for batch in batches:
            texts = batch.column("text").to_pylist()
            logs, letters = np.zeros(len(texts)), np.zeros(len(texts))
            for lang, rows in _by_value(batch.column("lang").to_pylist()).items():
                for some in chunks(rows, texts):
                    if sum(map(len, known.values())) > HELD:
                        known.clear()
                    own = known.setdefault(lang, {})
                    counted = [Counter(p.words) for p in some]
                    if new := list(set().union(*counted).difference(own)):  # looked up at once
                        own.update(zip(new, m.words(lang, new).tolist(), strict=True))
                    joints = Joints(some, m.order - 2)
                    total = np.bincount(joints.owner, m.joints(lang, joints), len(some))
                    many = np.bincount(joints.owner, joints.sizes, len(some))
                    for p, found, log, n in zip(some, counted, total.tolist(), many.tolist(), strict=True):
                        logs[p.row] += log + math.sumprod(map(own.__getitem__, found), found.values())
                        letters[p.row] += n
            bits = [-log / n / math.log(2) if n else None for log, n in zip(logs.tolist(), letters.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("lang"), *_base_columns(texts), pa.array(bits, pa.float64())], ["key", "lang", *NAMES, "bits"])

    return made


def judge(docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", order: int = ORDER, band: float = BAND, shard: int = SHARD_ENTRIES, held: int = HELD_ENTRIES) -> DataFrame:
    """The counts, the score and the verdict of every row."""
    bound_batches(docs.sparkSession)
    slim = docs.select(F.col(f"`{key}`").cast("long").alias("key"), _languages(docs, lang).alias("lang"), F.col(f"`{text}`").alias("text"))
    if not 2 <= order <= 4:
        raise ValueError("the order is 2, 3 or 4: a joint must not reach past a word of one letter")
    counted = count_pieces(docs, text, lang, order)
    grams = kneser_ney(counted, order)
    model = docs.sparkSession.sparkContext.broadcast(store_model(grams, order, shard, held))
    scored = slim.mapInArrow(_scored(model), f"key long, lang string, {COUNTS}, bits double")
    scored = materialize(scored, "quality-scores")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    scored = scored.withColumn("base_failed", failed)
    quartiles = scored.filter(~F.col("base_failed")).groupBy("lang").agg(F.percentile_approx("bits", [0.25, 0.75], 10_000).alias("q"))
    low, high = F.get("q", F.lit(0)), F.get("q", F.lit(1))
    bands = _by_language(quartiles.select("lang", (low - band * (high - low)).alias("least_bits"), (high + band * (high - low)).alias("most_bits")))
    out = scored.join(bands, "lang", "left")
    kept = ~F.col("base_failed") & F.coalesce(F.col("bits").between(F.col("least_bits") - 1e-9, F.col("most_bits") + 1e-9), F.lit(True))
    return out.select(F.col("key").alias(key), *NAMES, "base_failed", kept.alias("kept"), "bits", F.when(F.col("lang") != "0", F.substring("lang", 2, 1 << 30)).alias("lang"))
