"""Secret scans: candidate strings, and a random forest that removes false ones.

Candidates come from patterns over the whole text: known key formats, passwords in
addresses, values assigned to telling names (which may end a longer name or a quoted
key), and long runs that mix letters and digits, joined by dots or not.  A quoted value goes to its closing
quote on the same line, whatever it holds; any other assigned value ends at white space, a quote or one of ``<>,;``.  An
assigned value has at least ``LEAST`` characters, and none has a greatest length.  The patterns run only where a white-space-separated string can start a
candidate; strings that cannot are remembered.  Each candidate is described by its length, its character transitions, its dictionary coverage, the
path it was found under and its neighbouring words.  A random forest trained by
Spark ML on labelled findings decides which candidates are secrets; its trees are
a few small arrays that go with the tasks, so texts are scanned and redacted
where they are read.

Findings are a table (candidate features, label) of the caller's.  Without one
they are labelled from the documents by the formats of ``LABELLED``; rows that no
format decides are not used.  Training takes at most about ``SAMPLE`` of them, half of
each label unless one has fewer, by a hash of the candidate, so that reruns agree; both
labels weigh the same.

Defined results: a null or empty text has no candidate; overlapping candidates
are one, the longest; repeated rows are scanned each; without any labelled finding
of both kinds a format that is certain decides alone; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tilth.llm.text import bound_batches, carried, hold_worker, restored
from tilth.scratch import materialize, scratch_path

#: Labelled findings that the forest is trained on, in expectation.
SAMPLE = 20_000
#: Most frequent words that make the dictionary.
DICTIONARY = 20_000
TREES, DEPTH, SEED = 20, 6, 7
THRESHOLD = 0.5
MASK = "[secret]"
#: Published prefixes of access keys, signed JSON tokens, and names that are given secrets.
PREFIXES = r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|xox[abprs]-[0-9A-Za-z-]{10,}|AIza[0-9A-Za-z_-]{35}|sk_live_[0-9a-zA-Z]{24,}|eyJ[0-9A-Za-z_-]{8,}(?:\.[0-9A-Za-z_-]+){1,4}"
NAMES = r"api[_-]?key|access[_-]?key|auth|credential|passphrase|password|passwd|private[_-]?key|pwd|secret|token"
#: Characters of a run, and of the segments of a token that are joined by dots.
_RUN, _SEGMENT = "0-9A-Za-z+/_=-", "0-9A-Za-z_=-"
_QUOTE = r"(?:\\?[\"'])?"
#: The least length of an assigned value.
LEAST = 6
#: What may stand between an opening quote and its like on the same line, where that is plain or escaped.
_QUOTED = {q: re.compile(rf"((?:\\.|[^\\\n{q}])*){q}") for q in "\"'"} | {"\\" + q: re.compile(rf"((?:\\[^{q}\n]|[^\\\n])*)\\{q}") for q in "\"'"}
# A name may end a longer one; what stands before it is taken from the start of the run on, as a run would
# start there too.  An assignment is looked for first, so that plain words are left at once.
_BEFORE_NAME = rf"(?:(?<![.{_RUN}])(?=[0-9A-Za-z+/_.-]*+{_QUOTE}[ \t]*+[=:])[.{_RUN}]*?|\b)"
#: What stands before the password in an address.
_ADDRESS = r"(?<![0-9A-Za-z+.-])[A-Za-z][0-9A-Za-z+.-]*+://[^\s/:@]*+:"
_CANDIDATE = re.compile(
    rf"(?P<key>(?<![0-9A-Za-z])(?:{PREFIXES})(?![0-9A-Za-z]))"
    rf"|(?P<address>{_ADDRESS}(?P<word>[^\s/@]+)@)"
    rf"|(?P<named>{_BEFORE_NAME}(?i:(?:{NAMES})\b){_QUOTE}[ \t]*(?:=>|=|:)[ \t]*(?:(?P<open>\\?[\"'])|(?P<value>[^\s\"'<>,;\\][^\s\"'<>,;]{{{LEAST - 1},}})))"
    # two or more long segments joined by dots are one token
    rf"|(?<![.@{_RUN}])(?:(?P<joined>(?=[A-Za-z_=.-]*[0-9])(?=(?:[{_SEGMENT}]++\.)*[{_SEGMENT}]{{16,}}\.(?:[{_SEGMENT}]++\.)*[{_SEGMENT}]{{16}})[{_SEGMENT}]+(?:\.[{_SEGMENT}]+)+(?![0-9A-Za-z@]))"
    rf"|(?P<run>(?=[A-Za-z+/_=-]*[0-9])[{_RUN}]{{16,}}(?![0-9A-Za-z@])))"
)
_PLAIN = re.compile(r"([^\s\"'<>,;]*)")
_NAME = re.compile(rf"(?i)(?:{NAMES})\b")
#: A string in which a candidate may start, and as many strings in a row as it may take.
_HOT = re.compile(rf"{PREFIXES}|(?i:(?:{NAMES})\b)|://[^/@]*@|(?<![.{_RUN}])(?=[A-Za-z+/_=.-]*+[0-9])[.{_RUN}]{{16}}")
_STRING, _STRINGS = re.compile(r"\S+"), re.compile(r"\S+(?:[ \t]+\S+){0,2}")
#: Strings that cannot start a candidate, as far as a worker remembers them.
_COLD: set[str] = set()
REMEMBERED = 200_000
#: (pattern of the candidate, pattern of the text before it, is a secret); the first that fits decides.
LABELLED = (
    (re.compile(rf"(?:{PREFIXES})"), None, True),
    (re.compile(r"(?i)(?:pass(?:word|wd)?|pwd|secret|example|changeme|placeholder|dummy|your[_-]?|x{6,}|\*{4,}).*"), None, False),
    (re.compile(r"[0-9a-f]{16,64}"), _NAME, True),
    (re.compile(r"\S{6,}"), re.compile(_ADDRESS + r"$"), True),
    (re.compile(r"[0-9][0-9 .-]*"), None, False),  # card, phone and account numbers, addresses
    (re.compile(r"[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}"), None, False),
    (re.compile(r"[A-Za-z]+"), None, False),
    (re.compile(r"[A-Za-z]+(?:[-_/][A-Za-z0-9]{1,12})+"), None, False),
)
FEATURES = ("length", "transitions", "classes", "entropy", "digits", "dictionary", "path_depth", "path_test", "name_before", "assigned", "quoted", "prose_near")
_WORD = re.compile(r"[^\W\d_]{3,}")


def _class(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


def features(value: str, before: str, after: str, path: str, dictionary: frozenset[str]) -> list[float]:
    """Numbers that describe a candidate, in the order of ``FEATURES``."""
    kinds = [_class(c) for c in value]
    counts = Counter(value)
    n = len(value)
    letters = [w.lower() for w in _WORD.findall(value)]
    near = [w.lower() for w in _WORD.findall(before)[-3:] + _WORD.findall(after)[:3]]
    return [
        float(n),
        sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / max(1, n - 1),
        float(len(set(kinds))),
        -sum(k / n * math.log2(k / n) for k in counts.values()),
        kinds.count(0) / n,
        sum(len(w) for w in letters if w in dictionary) / n,
        float(path.count("/")),
        float(bool(re.search(r"(?i)test|example|sample|doc", path))),
        float(bool(_NAME.search(before[-40:]))),
        float(bool(re.search(r"[=:]\s*[\"']?$", before))),
        float(before[-1:] in ("'", '"')),
        sum(w in dictionary for w in near) / max(1, len(near)),
    ]


def candidates(text: str | None) -> Iterator[tuple[int, int, bool, str, str]]:
    """(start, end, has a key's format, text before, text after), left to right."""
    text = text or ""
    strings = set(text.split()) - _COLD
    hot = {x for x in strings if _HOT.search(x)}
    if len(_COLD) > REMEMBERED:
        _COLD.clear()
    _COLD.update(strings - hot)
    at = 0
    for string in _STRING.finditer(text) if hot else ():
        if string.end() <= at or string.group() not in hot:
            continue
        at = max(at, string.start())
        # a name may be assigned what follows it; all else ends with its string
        end = _STRINGS.match(text, string.start()).end() if _NAME.search(string.group()) else string.end()
        while (m := _CANDIDATE.search(text, at, end)) and m.start() < string.end():
            start, stop = m.span("value" if m["value"] else "word" if m["word"] else 0)
            if m["open"]:
                start = m.end()
                own = _QUOTED[m["open"]].match(text, start) or _PLAIN.match(text, start)
                stop = own.end(1)
                if stop - start < LEAST:
                    at = m.end()
                    continue
            yield start, stop, m["key"] is not None, text[max(0, start - 60) : start], text[stop : stop + 40]
            at = max(stop, at + 1)


def labelled(value: str, before: str) -> bool | None:
    for pattern, context, verdict in LABELLED:
        if pattern.fullmatch(value) and (context is None or context.search(before[-40:])):
            return verdict
    return None


class Forest:
    """Trees as arrays: feature (-1 at a leaf), threshold, left, right, probability."""

    def __init__(self, trees: list[tuple[np.ndarray, ...]]):
        self.trees = trees

    def probability(self, x: np.ndarray, known: np.ndarray) -> np.ndarray:
        if not self.trees:
            return known.astype(float)
        total = np.zeros(len(x))
        for feature, threshold, left, right, leaf in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH + 1):
                f = feature[at]
                down = np.where(x[np.arange(len(x)), np.maximum(f, 0)] <= threshold[at], left[at], right[at])
                at = np.where(f < 0, at, down)
            total += leaf[at]
        return total / len(self.trees)


def dictionary_of(docs: DataFrame, text: str = "text", size: int = DICTIONARY) -> frozenset[str]:
    """The ``size`` most frequent words of all documents, counted by Spark."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for t in batch.column("text").to_pylist():
                held.update((t or "").lower().split())
            if len(held) > 200_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
                held = Counter()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    words = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(counted, "word string, n long")
    words = words.withColumn("word", F.regexp_extract("word", r"^\W*([\p{L}]{3,40})\W*$", 1)).filter("word <> ''")
    words = materialize(words.groupBy("word").agg(F.sum("n").alias("n")), "secret-words")
    # only words of the powers of two that hold the most frequent ones are sorted
    power = F.floor(F.log2("n")).cast("int")
    least, enough = 0, 0
    for r in words.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("power")).collect():  # at most 64 rows
        least, enough = r["power"], enough + r["words"]
        if enough >= size:
            break
    top = words.filter(power >= least).orderBy(F.desc("n"), "word").limit(size)
    return frozenset(r["word"] for r in top.select("word").collect())


def findings(docs: DataFrame, dictionary: Broadcast, text: str, path: Column, sample: int) -> DataFrame:
    """Labelled candidates of all documents: features, label; about ``sample`` of them."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_worker("secrets", _COLD.clear)
        for batch in batches:
            xs, ys, keys = [], [], []
            for t, p in zip(batch.column("text").to_pylist(), batch.column("path").to_pylist(), strict=True):
                for start, end, _, before, after in candidates(t):
                    y = labelled(t[start:end], before)
                    if y is not None:
                        xs.append(features(t[start:end], before, after, p or "", dictionary.value))
                        ys.append(float(y))
                        keys.append(t[start:end])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(xs, pa.list_(pa.float64())), pa.array(ys, pa.float64())], ["value", "x", "label"])

    slim = docs.select(F.col(f"`{text}`").alias("text"), path.cast("string").alias("path"))
    all_ = slim.mapInArrow(made, "value string, x array<double>, label double")
    all_ = materialize(all_.groupBy("value", "x", "label").agg(F.count(F.lit(1)).alias("copies")).select(F.xxhash64("value", "x").alias("order"), "x", "label"), "secret-findings")
    many = {r["label"]: r["n"] for r in all_.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    # each label has half of the sample, and what the other leaves
    total = sum(many.values())
    share = [F.when(F.col("label") == y, min(1.0, max(sample / 2, sample - (total - n)) / n) * 1_000_000) for y, n in sorted(many.items())]
    return all_.filter(F.pmod("order", F.lit(1_000_000)) < F.coalesce(*share, F.lit(0.0)))


def train(labelled_rows: DataFrame) -> Forest:
    """A random forest by Spark ML on (order, x, label), as arrays."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    spark = labelled_rows.sparkSession
    rows = labelled_rows.orderBy("order", "label").select("label", "x").collect()  # bounded by SAMPLE; one order, so reruns agree
    if len({r["label"] for r in rows}) < 2:
        return Forest([])
    # both labels weigh the same, so the forest does not depend on how rare one is
    many = Counter(r["label"] for r in rows)
    local = spark.createDataFrame([(r["label"], len(rows) / (len(many) * many[r["label"]]), r["x"]) for r in rows], "label double, weight double, x array<double>").coalesce(1)
    data = local.select("label", "weight", array_to_vector("x").alias("features"))
    model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, minInstancesPerNode=2, weightCol="weight").fit(data)
    saved = scratch_path(spark, "secret-forest")
    model.save(saved)
    nodes = spark.read.parquet(f"{saved}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
    trees = []
    for t in sorted({r["treeID"] for r in nodes}):
        own = [r for r in nodes if r["treeID"] == t]
        counts = np.array([r["impurityStats"] for r in own], float)
        split = [r["split"] for r in own]
        leaf = np.array([r["leftChild"] < 0 for r in own])
        feature = np.where(leaf, -1, [s["featureIndex"] for s in split])
        threshold = np.array([0.0 if end else s["leftCategoriesOrThreshold"][0] for end, s in zip(leaf, split, strict=True)])
        trees.append((feature, threshold, np.array([r["leftChild"] for r in own]), np.array([r["rightChild"] for r in own]), counts[:, 1] / counts.sum(axis=1)))
    return Forest(trees)


FOUND = "clean string, spans array<struct<start:long,length:long,probability:double,secret:boolean>>"


def _scanned(forest: Broadcast, dictionary: Broadcast):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("probability", pa.float64()), ("secret", pa.bool_())]))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_worker("secrets", _COLD.clear)
        for batch in batches:
            places, xs, sure = [], [], []
            texts = batch.column("text").to_pylist()
            for i, (t, p) in enumerate(zip(texts, batch.column("path").to_pylist(), strict=True)):
                for start, end, known, before, after in candidates(t):
                    places.append((i, start, end))
                    xs.append(features(t[start:end], before, after, p or "", dictionary.value))
                    sure.append(known)
            found: list[list[dict]] = [[] for _ in texts]
            if xs:
                for (i, start, end), p in zip(places, forest.value.probability(np.array(xs), np.array(sure)).tolist(), strict=True):
                    found[i].append({"start": start, "length": end - start, "probability": round(p, 6), "secret": p >= THRESHOLD})
            clean = []
            for t, spans in zip(texts, found, strict=True):
                hits = [s for s in spans if s["secret"]]
                for s in reversed(hits):
                    t = t[: s["start"]] + MASK + t[s["start"] + s["length"] :]
                clean.append(t if hits else None)
            yield pa.RecordBatch.from_arrays([batch.column("rest"), batch.column("text"), pa.array(clean, pa.string()), pa.array(found, kind)], ["rest", "text", "clean", "spans"])

    return made


def scan(docs: DataFrame, *, text: str = "text", path: Column | None = None, labelled_findings: DataFrame | None = None, sample: int = SAMPLE) -> DataFrame:
    """``row`` (the columns of ``docs``), ``clean`` (the redacted text) and ``spans``."""
    spark = docs.sparkSession
    bound_batches(spark)
    path = F.lit("") if path is None else path
    dictionary = spark.sparkContext.broadcast(dictionary_of(docs, text))
    rows = labelled_findings if labelled_findings is not None else findings(docs, dictionary, text, path, sample)
    forest = spark.sparkContext.broadcast(train(rows))
    full = docs.select(carried(docs, text), F.col(f"`{text}`").alias("text"), path.cast("string").alias("path"))
    out = full.mapInArrow(_scanned(forest, dictionary), StructType([*full.drop("path").schema.fields, *StructType.fromDDL(FOUND).fields]))
    return out.select(restored(docs, text), F.coalesce("clean", "text").alias("clean"), "spans")


def redacted(docs: DataFrame, *, text: str = "text", length: str = "n_chars", **options) -> DataFrame:
    """The documents with their secrets masked, with the columns of ``docs``."""
    out = scan(docs, text=text, **options)
    changed = {text: F.col("clean")}
    if length in docs.columns:
        hit = F.exists("spans", lambda s: s["secret"])
        changed[length] = F.when(hit, F.length("clean").cast(docs.schema[length].dataType)).otherwise(F.col(f"row.`{length}`"))
    return out.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
