"""Cross-tokenizer alignment, ranked search and shards against brute force."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from pyspark.sql import functions as F

from tilth.llm import alignment, lexical, sharding
from tilth.llm.queries import QUERIES
from tilth.scratch import materialize

A, B = path("byte_bpe_50k.json"), path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, size long, row string, part int, item string, at long, n long"
ODD = [
    None, "", " ", "\n", "  two  blanks  ", "tab\tand\x0bother\x0c white\r\n\r\nspace \n x", "<|endoftext|> </s><s><unk> <0x41>", "café é naïve 漢字かな 한국어 \U0001f600‍\U0001f525",
    "▁ marks ▁▁inside", "no break  em　wide", "a\x00b \x1c\x1d\x85", "x" * 3000, "word " * 4000, "it's don't THEY'LL 12345 ---=== #@!\n\n\nend\n",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None, None, "r", 1, None, 7, 7) for i, t in enumerate(ODD)]
    rows += [(100 + i, f"the {w} of the river and the old bridge number {i}", "en", i, "r", None, "x", 0, None) for i, w in enumerate(["town", "storm", "night", "storm", "town"] * 8)]
    rows += [(101, "the storm of the river and the old bridge number 1", None, None, None, None, None, None, None)] * 2 + [(None, "a null key in the storm", None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# -- alignment


@given(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.lists(st.integers(1, 4), min_size=1, max_size=60))
def test_shared_cuts_are_all_common_ends(a, b):
    ends = [list(np.cumsum(x)) for x in (a, b)]
    last = max(ends[0][-1], ends[1][-1]) + 1
    ends = [e + [last] for e in ends]
    common = sorted(set(ends[0]) & set(ends[1]))
    assert alignment.shared_cuts(*ends) == [(ends[0].index(c) + 1, ends[1].index(c) + 1) for c in common]


def test_long_cutless_and_dense_texts_are_quick():
    n = 200_000
    assert alignment.shared_cuts(list(range(2, 2 * n, 2)) + [2 * n], list(range(1, 2 * n, 2)) + [2 * n]) == [(n, n + 1)]
    assert len(alignment.shared_cuts(list(range(1, n)), list(range(1, n)))) == n - 1


class Whole:
    """Both tokenizers over whole texts, and what the contract derives from them."""

    def __init__(self):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}

    def sides(self, text):
        ia, ib = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        xa = [bytes(self.byte[c] for c in self.a.id_to_token(i)) for i in ia]
        xb = [bytes([int(self.b.id_to_piece(i)[3:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        return ia, ib, xa, xb

    def groups(self, text):
        """[(A ids, B ids)] or none."""
        if not text:
            return []
        ia, ib, xa, xb = self.sides(text)
        if not b"".join(xa) == b"".join(xb) == (" " + text).encode():
            return []
        ea, eb = np.cumsum([len(x) for x in xa]), np.cumsum([len(x) for x in xb])
        out, i0, j0 = [], 0, 0
        for c in sorted(set(ea.tolist()) & set(eb.tolist())):
            i, j = int(np.searchsorted(ea, c)) + 1, int(np.searchsorted(eb, c)) + 1
            out.append((ia[i0:i], ib[j0:j]))
            i0, j0 = i, j
        return out


_WHOLE = Whole()


@pytest.fixture(scope="module")
def whole():
    return _WHOLE


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t\r 　\x1c'sdt▁<>|ab1.éé漢\U0001f600"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_cells_align_as_the_whole_text(text):
    own = alignment.aligner(A, B)
    want = _WHOLE.groups(text)
    n_a, n_b, groups, links = next(own.documents([text]))
    assert groups.decode() == ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in want)
    assert (n_a, n_b, len(links)) == (sum(len(a) for a, _ in want), sum(len(b) for _, b in want), len(want))


@pytest.mark.parametrize("at_once", [alignment.PAIRS_AT_ONCE, 20])
def test_alignment_equals_brute_force(docs, whole, at_once):
    aligned = materialize(alignment.align_documents(docs, A, B), "test-aligned")
    got = alignment.with_corpus_counts(aligned, at_once=at_once).collect()
    each = [(r["doc_id"], whole.groups(r["text"])) for r in docs.collect()]
    counts = Counter((a[-1], b[-1]) for _, gs in each for a, b in gs)
    most: dict[int, int] = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))

    def row(key, gs):
        links = [(a[-1], b[-1]) for a, b in gs]
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in gs)
        return key, sum(len(a) for a, _ in gs), sum(len(b) for _, b in gs), len(gs), text, sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links)

    assert Counter((r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["groups"], r["n_best"], r["count_sum"]) for r in got) == Counter(row(*x) for x in each)


def test_a_small_memory_gives_the_same(docs, monkeypatch):
    texts = [r["text"] for r in docs.collect()]
    own = alignment.Aligner(alignment.load(A), alignment.load(B))
    want = [x[2] for x in own.documents(texts)]
    monkeypatch.setattr(alignment, "REMEMBERED", 5)
    monkeypatch.setattr(alignment, "LONGEST", 6)
    own = alignment.Aligner(alignment.load(A), alignment.load(B))
    assert [x[2] for x in own.documents(texts)] == want


def test_alignment_of_nothing(empty):
    aligned = materialize(alignment.align_documents(empty, A, B), "test-none")
    assert alignment.with_corpus_counts(aligned).count() == 0


def test_op11_digests_the_groups(spark, tmp_path):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(30)
    d.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in QUERIES["op11_cross_tokenizer_alignment"](spark, str(tmp_path)).collect()}
    for r in d.collect():
        gs = _WHOLE.groups(r["text"])
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in gs)
        assert got[r["doc_id"]]["groups_sha256"] == (hashlib.sha256(text.encode()).hexdigest() if gs else "")
        assert got[r["doc_id"]]["n_links"] == len(gs)


# -- ranked search

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(docs, items, k):
    split = lambda t: TERMS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    own = [(key, Counter(ts), len(ts)) for key, t in docs if (ts := split(t))]
    n_docs, words = len(own), sum(x[2] for x in own)
    df = Counter(t for _, c, _ in own for t in c)
    out = []
    for item, text in items:
        found = []
        for key, c, n in own:
            m = 75 + 25 * n * n_docs // words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in split(text) if c[t])
            if score > 0:
                found.append((-score, key is None, key or 0, key))
        out += [(item, i, key, -s) for i, (s, _, _, key) in enumerate(sorted(found)[:k], 1)]
    return Counter(out)


ITEMS = [(1, "The STORM in the night"), (2, "bridge bridge bridge"), (3, None), (4, "..."), (5, "café 漢字かな x"), (None, "number 7 of the town"), (6, "nothing-known here"), (1, "word a word"), (7, "word " * 50)]


@pytest.mark.parametrize("sizes", [None, (3, 9, 20)])
def test_ranks_equal_brute_force(spark, docs, monkeypatch, sizes):
    if sizes:
        for name, v in zip(("PIECE_DOCS", "PIECE_POSTINGS", "FIRST_DOCS"), sizes, strict=True):
            monkeypatch.setattr(lexical, name, v)
        monkeypatch.setattr(lexical, "BLOCK_BYTES", 40)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = lexical.rank(docs, items, k=7)
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and dict(got.dtypes)["rank"] == "int"
    want = ranked([(r["doc_id"], r["text"]) for r in docs.collect()], ITEMS, 7)
    assert Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got.collect()) == want


def test_ranks_of_nothing(spark, docs, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.rank(empty, items).count() == 0
    assert lexical.rank(docs, items.filter("item_id in (3, 4)")).count() == 0
    assert lexical.rank(docs, items.limit(0)).count() == 0


def test_pieces_are_bounded_and_whole(spark, monkeypatch):
    monkeypatch.setattr(lexical, "PIECE_DOCS", 50)
    same = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("a b c a").alias("text"))
    pieces, n_docs, words = lexical.build_index(same, [b"a", b"c"])
    got = pieces.collect()
    assert (n_docs, words, len({r["m"] for r in got})) == (1000, 4000, 1)
    assert len(got) == 20 and max(len(r["docs"]) for r in got) < 90
    assert sorted(d for r in got for d in r["docs"]) == list(range(1000))
    assert all(r["run_tfs"] == [2, 1] and r["run_sizes"] == [len(r["docs"])] * 2 for r in got)


# -- shards


def minimax(sizes, shards):
    """The smallest capacity by trying all that matter, and greedily counted shards."""

    def needs(c):
        n, held = 1, 0
        for x in sizes:
            if held and held + x > c:
                n, held = n + 1, 0
            held += x
        return n

    sums = sorted({sum(sizes[i:j]) for i in range(len(sizes)) for j in range(i + 1, len(sizes) + 1)})
    low, high = 0, len(sums) - 1
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if max(sizes) <= sums[mid] and needs(sums[mid]) <= shards else (mid + 1, high)
    return sums[low]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50) | st.sampled_from([400, 900]), min_size=1, max_size=80), st.integers(1, 12), st.integers(1, 15))
def test_search_finds_the_minimax_partition(sizes, shards, at_once):
    ends = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    held = []

    def read(spans, step):
        got = [(x, i) for i, x in enumerate(ends) if i % step == 0 and any(a < x < b for a, b in spans)]
        held.append(len(got))
        return got

    line = sharding.Line(ends[-1], len(sizes), read, at_once)
    large = line.large(shards)
    left = [x for x, e in zip(sizes, ends, strict=False) if (e, e + x) not in large]
    assert sorted(set(large)) == large and len(large) < shards
    fair = sum(left) / (shards - len(large))
    assert all(x <= fair for x in left) and all(b - a > fair for a, b in large)
    capacity, cuts = line.without(large).partition(shards - len(large))
    ends = np.concatenate([[0], np.cumsum(left)]).astype(int).tolist()
    assert len(cuts) == shards - len(large) - 1 and all(c in ends for c in cuts) and cuts == sorted(cuts)
    if left:
        own = np.diff([0, *cuts, ends[-1]])
        assert own.max() == capacity == minimax(left, shards - len(large))
    assert max(held, default=0) <= at_once + 4 * shards + 8


def test_shards_hold_groups_and_slots(docs, empty):
    text = F.coalesce("text", F.lit(""))
    run = lambda d, n: sharding.shard_documents(d, shards=n, size=(F.octet_length(text) + 16), group=F.unhex(F.md5(text)), columns=d.columns, ends_at_once=6)
    out = run(docs, 5)
    rows = [r.asDict(recursive=True) for r in out.rows.collect()]
    assert Counter(r["row"]["doc_id"] for r in rows) == Counter(r["doc_id"] for r in docs.collect())
    where: dict[str, set] = {}
    by: dict[int, list] = {}
    for r in rows:
        assert r["size"] == len((r["row"]["text"] or "").encode()) + 16 and r["row"]["row"] in ("r", None)
        where.setdefault(r["row"]["text"] or "", set()).add(r["shard"])
        by.setdefault(r["shard"], []).append(r)
    assert all(len(x) == 1 for x in where.values())
    assert all(sorted(r["slot"] for r in x) == list(range(len(x))) for x in by.values())
    sizes: dict[bytes, int] = {}
    for r in rows:
        sizes[r["group"]] = sizes.get(r["group"], 0) + r["size"]
    large = {g for x in by.values() if len({r["group"] for r in x}) == 1 for g in [x[0]["group"]] if sizes[g] > out.capacity}
    assert max(sum(r["size"] for r in x) for x in by.values() if x[0]["group"] not in large) == out.capacity == minimax([sizes[g] for g in sorted(sizes) if g not in large], 5 - len(large))
    many = run(docs, 200).rows
    assert many.select("shard").distinct().count() == len(sizes) == many.select("group").distinct().count()
    assert run(empty, 5).rows.count() == 0
    again = run(docs.repartition(7), 5).rows
    key = lambda x: Counter((r["row"]["doc_id"], r["row"]["text"], r["shard"], r["slot"]) for r in x)
    assert {k[:3] for k in key(again.collect())} == {k[:3] for k in key(out.rows.collect())}


def test_a_group_of_a_third_leaves_the_others_equal(spark):
    rows = spark.range(9000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "copy").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"))
    out = sharding.shard_documents(rows, shards=20, size=F.octet_length("text"), group=F.unhex(F.md5("text"))).rows
    by = {r["shard"]: r["b"] for r in out.groupBy("shard").agg(F.sum("size").alias("b")).collect()}
    assert len(by) == 20 and max(by.values()) == 12_000
    rest = sorted(by.values())[:-1]
    assert rest[-1] - rest[0] <= 12
    assert rows.count() == out.count()


def test_op13_is_near_equal(spark):
    got = QUERIES["op13_minimax_shards"](spark, "/root/testdata/sf0.01").toPandas()
    by = got.groupby("shard")["size"].sum()
    assert sorted(by.index) == list(range(40)) and (got["law"] == "bytes").all() and got["grown_shard"].isna().all()
    assert by.max() - by.min() <= 2 * got["size"].max()
    assert (got.groupby("shard")["slot"].max() + 1 == got.groupby("shard").size()).all()
