"""Cost-balanced packing of tokenized documents into training sequences.

Every document becomes token ids and one end id.  The cost of a piece of n tokens
is linear plus quadratic in n (projections, attention).  Documents longer than
a sequence first fill whole sequences of their own; what is left of each goes,
in descending order, to the lowest-cost sequence with room for it, and is cut
where no sequence has room for all of it.  Capacities are fixed beforehand to
add up to the tokens exactly: sequences of full length, and powers of two for the
remainder, so nothing is padded.

A task packs its own rows in runs of bounded tokens: nothing is shuffled or
gathered, a hot source or a very long text stays where it is read, and a lost
task is simply packed again.  With an order, rows are range-sorted by it first, and
the sequences of a run come before those of the next, so a curriculum survives.

Ids equal the tokenizer's own ``encode`` of the whole text.  A vocabulary that splits at
white space and lower-cases before anything else is encoded by distinct parts; texts with one of its
added tokens, and all texts of other vocabularies, go through ``encode`` as they are.

Defined results: a null text is empty and gives the end id alone; a null key is
carried; repeated rows are packed each; an empty table gives no piece.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilth.llm.text import bound_batches, hold_worker

SEQUENCE = 4096
END_ID = 2
#: Tokens that one run of the packer holds.
RUN_TOKENS = 1 << 20
#: White-space-separated strings whose ids a worker remembers, and as many older ones.
REMEMBERED = 200_000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: A word of Latin-1 letters, which the vocabulary does not split; nor does a mark after it change its ids.
_PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)")
#: A mark that may join an ASCII letter before it to one character, in one case of the letter only.
_JOINING = re.compile("[\u0300-\u036f]")
#: Texts that show what a vocabulary does to capitals, white space, marks and joined characters.
_PROBES = ("Hello  World,\tIT'S 12 o'clock.\r\n", " A\x0bB\x0c", "\u00c9T\u00c9 e\u0301 H\u0331 h\u0331", "x\u00a0y \u2003z \u200b", "don't'll we've.", "\u4e2d\u6587 \ud55c\uad6d #$%", "")


@dataclass
class Vocabulary:
    """A tokenizer, what this worker remembers of it, and its spelling of letters.

    ``spelt`` is for vocabularies that spell bytes as letters: what their first
    steps make of each Latin-1 letter, so that a plain word goes straight to the
    model.  It is None for other vocabularies, and so is ``added``, the pattern of the
    added tokens, where texts can't be encoded part by part.
    """

    tokenizer: object
    added: re.Pattern | None = None
    spelt: dict[int, str] | None = None
    known: Parts | None = None


_KNOWN: dict[str, Vocabulary] = {}
_ID = attrgetter("id")


def _splits(t) -> bool:
    """Whether a vocabulary is of the kind that is encoded part by part: white space is one
    blank, capitals are lower-cased, and words are split off without their blanks."""
    spec = json.loads(t.to_str())
    kinds = lambda part, steps: [x["type"] for x in (part or {}).get(steps, [])]
    if kinds(spec["normalizer"], "normalizers") != ["NFC", "Replace", "Lowercase"] or kinds(spec["pre_tokenizer"], "pretokenizers") != ["Split", "ByteLevel"]:
        return False
    blank, split = spec["normalizer"]["normalizers"][1], spec["pre_tokenizer"]["pretokenizers"][0]
    return (blank["pattern"], blank["content"], split["behavior"], split["invert"]) == ({"Regex": r"\s+"}, " ", "Removed", True)


def _loaded(path: str) -> Vocabulary:
    if path not in _KNOWN:
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        v = Vocabulary(t)
        if _splits(t):
            letters = [c for c in map(chr, range(256)) if c.isalpha() and c == c.lower() and c not in "\u00aa\u00b5\u00ba"]
            spelt = {}
            for c in letters:
                made = t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(c))
                spelt[c] = made[0][0] if len(made) == 1 else ""
            word = "".join(letters)
            plain = all(spelt[c] == c for c in letters if c < "\x80") and t.encode(f"{word} {word}.", add_special_tokens=False).ids == _spelt_ids(t, spelt, word) * 2 + t.encode(".", add_special_tokens=False).ids
            v.spelt = {ord(k): x for k, x in spelt.items()} if plain else None
            names = [x.content for x in t.get_added_tokens_decoder().values()]
            v.added = re.compile("(?i)" + ("|".join(map(re.escape, names)) or "(?!)"))  # lower-casing must not make one
            if any(x.tolist()[:-1] != t.encode(probe, add_special_tokens=False).ids for x, probe in zip(_part_ids(v, _PROBES, array("I", [END_ID]).tobytes()), _PROBES, strict=True)):
                v.added = None
        _KNOWN[path] = v
    return _KNOWN[path]


def _spelt_ids(t, spelt: dict[str, str], word: str) -> list[int]:
    return [x.id for x in t.model.tokenize("".join(spelt[c] for c in word))]


class Parts(dict):
    """The ids of white-space-free parts as bytes, found when they are first asked for.

    At most ``REMEMBERED`` are held, and as many older ones, from which frequent parts come back.
    """

    def __init__(self, tokenizer, spelt: dict[int, str] | None) -> None:
        super().__init__()
        self.tokenizer, self.spelt, self.older = tokenizer, spelt, {}
        self.tokenize = tokenizer.model.tokenize
        self.mark = {m: self.whole(m) for m in (".", ",")}

    def __missing__(self, part: bytes) -> bytes:
        got = self.older.get(part)
        if got is None:
            if self.spelt and part.isalpha():  # ASCII letters are spelt as themselves
                got = array("I", map(_ID, self.tokenize(part.decode().lower()))).tobytes()
            else:
                got = self.found(part)
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[part] = got
        return got

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def found(self, part: bytes) -> bytes:
        text = part.decode("utf-8", "surrogatepass")
        mark = self.mark.get(text[-1])
        # a mark after a letter stands alone
        if self.spelt and mark is not None and (part[-2:-1].isalpha() or _PLAIN.fullmatch(text, 0, len(text) - 1)):
            return self[part[:-1]] + mark
        if self.spelt and _PLAIN.fullmatch(text):
            return array("I", map(_ID, self.tokenize(text.lower().translate(self.spelt)))).tobytes()
        return self.whole(text)


def _part_ids(v: Vocabulary, texts: Sequence[str | None], end: bytes) -> Iterator[np.ndarray]:
    if v.known is None:
        v.known = Parts(v.tokenizer, v.spelt)
    for text in texts:
        text = text or ""
        if v.added.search(text):
            yield _whole_ids(v, text, end)
            continue
        data = text.encode("utf-8", "surrogatepass")
        parts = (data if _JOINING.search(text) else data.lower()).split()
        yield np.frombuffer(b"".join([*map(v.known.__getitem__, parts), end]), "<u4")


def _whole_ids(v: Vocabulary, text: str, end: bytes) -> np.ndarray:
    return np.frombuffer(array("I", v.tokenizer.encode(text, add_special_tokens=False).ids).tobytes() + end, "<u4")


def token_ids(texts: Sequence[str | None], path: str, end_id: int = END_ID) -> Iterator[np.ndarray]:
    """The ids of each text, with the end id."""
    v = _loaded(path)
    end = array("I", [end_id]).tobytes()
    if v.added is not None:
        yield from _part_ids(v, texts, end)
    else:
        yield from (_whole_ids(v, text or "", end) for text in texts)


def capacities(tokens: int, sequence: int = SEQUENCE) -> list[int]:
    """Sequence lengths that add up to ``tokens``: full ones, then powers of two."""
    rest = tokens % sequence
    return [sequence] * (tokens // sequence) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def pack(lengths: list[int], sequence: int = SEQUENCE, linear: float = 1.0, quadratic: float = 1.0 / SEQUENCE) -> Iterator[tuple[int, int, int, int, int]]:
    """Yields (document, start, length, sequence, offset) for documents of these lengths."""
    at = 0
    rests = []
    for d, n in enumerate(lengths):
        for start in range(0, n - n % sequence, sequence):
            yield d, start, sequence, at, 0
            at += 1
        if n % sequence:
            rests.append((n % sequence, d, n - n % sequence))
    caps = np.array(capacities(sum(r[0] for r in rests), sequence), np.int64)
    room, cost = caps.copy(), np.zeros(len(caps))
    for n, d, start in sorted(rests, key=lambda r: (-r[0], r[1])):
        while n:
            fits = room >= n
            s = int(np.argmin(np.where(fits if fits.any() else room > 0, cost, np.inf)))
            take = int(min(n, room[s]))
            yield d, start, take, at + s, int(caps[s] - room[s])
            room[s] -= take
            cost[s] += linear * take + quadratic * take * take
            n, start = n - take, start + take


def _packer(path: str, sequence: int, end_id: int):
    def run(keys: list, ids: list[np.ndarray], first: int) -> tuple[pa.RecordBatch, int]:
        rows, most = [], first
        for d, start, n, s, offset in pack([len(x) for x in ids], sequence):
            rows.append((keys[d], start, n, zlib.crc32(ids[d][start : start + n].tobytes()), len(ids[d]), first + s, offset))
            most = max(most, first + s + 1)
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names), most

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_worker("packing", _KNOWN.clear)
        at = TaskContext.get().partitionId() << 40
        keys, ids, held = [], [], 0
        for batch in batches:
            for key, got in zip(batch.column("doc_id").to_pylist(), token_ids(batch.column("text").to_pylist(), path, end_id), strict=True):
                keys.append(key)
                ids.append(got)
                held += len(got)
                if held >= RUN_TOKENS:
                    out, at = run(keys, ids, at)
                    yield out
                    keys, ids, held = [], [], 0
        if keys:
            yield run(keys, ids, at)[0]

    return packed


def pack_documents(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", sequence: int = SEQUENCE, end_id: int = END_ID, order: Sequence[Column] = ()) -> DataFrame:
    """One row per piece; ``tokenizer`` is the path of a vocabulary file on every node.

    Without an ``order``, rows are packed where they are read.  With one, sequence ids
    ascend with it from run to run.
    """
    bound_batches(docs.sparkSession)
    slim = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.struct(*order).alias("order") if order else F.lit(0).alias("order"))
    if order:
        slim = slim.repartitionByRange("order").sortWithinPartitions("order")
    return slim.select("doc_id", "text").mapInArrow(_packer(tokenizer, sequence, end_id), SCHEMA)
