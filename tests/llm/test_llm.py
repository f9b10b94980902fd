"""The training-data operators on small tables, against brute force and round trips."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tilth.llm import fingerprint, language, licenses, mixing, neardup, packing, quality, secrets, urlfilter, warc
from tilth.llm import shingles as S
from tilth.llm.queries import ORACLES, QUERIES, RULES
from tilth.llm.text import bound_batches, word_count
from tilth.scratch import materialize

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, row string, target int"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = {
    "en": "the people of the town went down to the river and they saw that the water was high and the old bridge had gone with the storm in the night",
    "de": "die leute aus der stadt gingen zum fluss hinunter und sahen dass das wasser hoch stand und die alte brücke in der nacht mit dem sturm verschwunden war",
    "fr": "les gens de la ville sont descendus à la rivière et ils ont vu que l'eau était haute et que le vieux pont avait disparu avec la tempête dans la nuit",
}


def prose(lang: str, seed: int, n: int) -> str:
    words = PROSE[lang].split()
    rng = np.random.default_rng(seed)
    return " ".join(words[i] for i in rng.integers(0, len(words), n))


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls in every column, empty and long texts, ties, repeats, clashing extra columns."""
    rows = []
    for i in range(40):
        lang = list(PROSE)[i % 3]
        rows.append((i, prose(lang, i, 30 + 5 * i), lang, f"s{i % 4}", None, "x", "y", i))
    rows += [(40, rows[3][1], "en", "s0", 5, None, None, None), (41, rows[3][1] + " and one more word", "de", "s0", 5, None, None, None)]
    rows += [(42, None, "en", "s1", None, None, None, None), (43, "", None, None, 0, None, None, None), (44, " \t\n", "fr", "s2", 3, None, None, None)]
    rows += [(None, prose("en", 99, 60), None, None, None, None, None, None), (45, "one two", "en", None, 7, None, None, None), (45, "one two", "en", None, 7, None, None, None)]
    rows += [(46, "long " * 20_000 + prose("fr", 7, 3000), "fr", "s3", None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# -- mixing


def test_mix_meets_targets_and_reruns_agree(docs):
    run = lambda d: mixing.mix(d, word_count(F.col("text")), rows_per_bucket=4).select("row.doc_id", "row.source", "size", "source_size", "target", "taken", "copies").toPandas()
    a, b = run(docs), run(docs.repartition(3))
    key = ["doc_id", "source", "size", "taken"]
    assert a[key].sort_values(key).reset_index(drop=True).equals(b[key].sort_values(key).reset_index(drop=True))
    by = a.groupby("source", dropna=False).agg(size=("size", "sum"), taken=("taken", "sum"), target=("target", "first"), own=("source_size", "first")).reset_index()
    names = sorted(x for x in by["source"] if isinstance(x, str))
    weight = {**{n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}, None: (5, 2, 1)[len(names) % 3]}
    left, full, total = set(weight), set(), float(by["size"].sum())
    sizes = {(s if isinstance(s, str) else None): n for s, n in zip(by["source"], by["size"])}
    while True:
        level = (total - sum(3 * sizes[s] for s in full)) / sum(weight[s] for s in left)
        over = {s for s in left if weight[s] * level > 3 * sizes[s]}
        if not over:
            break
        left, full = left - over, full | over
    for r in by.itertuples():
        s = r.source if isinstance(r.source, str) else None
        assert r.target == pytest.approx(3 * sizes[s] if s in full else weight[s] * level)
        assert r.taken == round(r.target) and r.own == r.size
    assert (a["taken"] <= 3 * a["size"]).all()
    assert all(0 <= c["position"] <= 1 for cs in a["copies"] for c in cs)


def test_mix_positions_follow_the_schedule(spark):
    d = spark.createDataFrame([(i, "w " * 10, "a") for i in range(2000)], "doc_id long, text string, source string")
    m = mixing.mix(d, word_count(F.col("text")), weights=(1,), shapes=(mixing.FADING,)).select(F.explode("copies").alias("c")).select("c.position").toPandas()["position"]
    # the integral of 1.5 - t up to a half is 0.625
    assert (m < 0.5).mean() == pytest.approx(0.625, abs=0.02)


def test_mixed_documents_are_whole_or_cut(docs, empty):
    out = mixing.mixed_documents(docs, word_count(F.col("text")))
    assert out.columns == docs.columns
    m = mixing.mix(docs, word_count(F.col("text"))).agg(F.sum("taken")).first()[0]
    assert out.agg(F.sum(word_count(F.col("text")))).first()[0] == m
    assert mixing.mixed_documents(empty, word_count(F.col("text"))).count() == 0


# -- WARC


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://h{i}.org/é\r\nx", f"<p>{i % 7}</p>" * (i % 5), "k") for i in range(60)]
    rows += [(60, None, None, "k"), (61, "http://a", "", "k"), (None, "http://b", "<p>1</p>", "k"), (5, "http://c", "<p>5</p>" * 0, "k"), (62, "u", "é" * 300_000, "k"), (62, "u", "é" * 300_000, "k")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, shard string")


def test_warc_round_trip(spark, pages, tmp_path):
    folder = str(tmp_path / "w")
    manifest = warc.write_warc(pages, folder, roll_bytes=4000, shard_rows=20)
    got = warc.read_warc(manifest, folder).toPandas()
    assert manifest.agg(F.sum("records")).first()[0] == pages.count() == len(got) and manifest.count() > 3
    data = [(r["page_id"], r["html"] or "") for r in pages.collect()]
    first: dict[str, int] = {}
    for i, h in data:
        if i is not None:
            first[h] = min(i, first.get(h, i))
    want = Counter((i, len(h.encode()), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()) for i, h in data)
    none = lambda v: None if v is None or v != v else int(v)
    assert Counter((none(a), b, c) for a, b, c in zip(got.page_id, got.payload_bytes, got.payload_digest)) == want
    for r in got.itertuples():
        if r.record_type == "response":
            assert none(r.refers_to) is None and len(r.payload) == r.payload_bytes
    assert Counter(got.payload_digest[(got.record_type == "response") & got.page_id.notna()]).most_common(1)[0][1] == 1
    assert all(none(r.refers_to) == first[{base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(): h for _, h in data}[r.payload_digest]] for r in got.itertuples() if r.record_type == "revisit")


def test_warc_reruns_agree_and_leave_nothing(spark, pages, tmp_path):
    sums = []
    for name in ("a", "b"):
        m = warc.write_warc(pages.repartition(3 if name == "a" else 5), str(tmp_path / name), roll_bytes=9000, shard_rows=25)
        sums.append(sorted((r["name"], r["sha1"]) for r in m.collect()))
        assert not list((tmp_path / name).glob("_tmp-*"))
    assert sums[0] == sums[1]


def test_warc_of_nothing_and_damage(spark, pages, tmp_path):
    m = warc.write_warc(pages.limit(0), str(tmp_path / "e"))
    assert m.count() == 0 and warc.read_warc(m, str(tmp_path / "e")).count() == 0
    m = warc.write_warc(pages.filter("page_id < 9"), str(tmp_path / "d"), min_revisit=1 << 30)
    got = warc.read_warc(m, str(tmp_path / "d"))
    assert {r["record_type"] for r in got.collect()} == {"response"}
    head, block = warc.parse_record(b"WARC/1.1\r\nWARC-Type: x\r\nContent-Length: 2\r\n\r\nab\r\n\r\n")
    assert head["WARC-Type"] == "x" and block == b"ab"


# -- secrets


def test_secrets_are_masked_and_others_stay(spark, docs, empty):
    rng = np.random.default_rng(0)
    hexa = lambda n: "".join(rng.choice(list("0123456789abcdef"), n))
    rows = []
    for i in range(60):
        kind = i % 4
        value = [f'token = "{hexa(40)}"', "".join(map(str, rng.integers(0, 10, 16))), "AKIA" + "".join(rng.choice(list("ABCDEFGHIJ234567"), 16)), f"see {hexa(8)}-{hexa(4)}-{hexa(4)}-{hexa(4)}-{hexa(12)}"][kind]
        rows.append((i, f"{prose('en', i, 20)} {value} {prose('en', i + 500, 9)}", "src/app"))
    d = spark.createDataFrame(rows, "doc_id long, text string, clean string")
    out = secrets.scan(d, path=F.col("clean")).select("row.doc_id", "row.text", "clean", "spans").collect()
    for r in out:
        assert (secrets.MASK in r["clean"]) == (r["doc_id"] % 4 in (0, 2)), r["text"]
    red = secrets.redacted(docs)
    assert red.columns == docs.columns and red.count() == docs.count()
    assert secrets.redacted(empty).count() == 0


def test_secret_held_out_accuracy(spark):
    """Findings of sf0.1 in two halves by hash: trained on one, judged on the other."""
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    sent = spark.sparkContext.broadcast(secrets.dictionary_of(d))
    rows = secrets.findings(d, sent, "text", F.col("source"), secrets.SAMPLE).collect()
    hits = misses = false = 0
    for part in (0, 1):
        seen = spark.createDataFrame([r for r in rows if r["order"] % 2 == part], "order long, x array<double>, label double")
        held = [r for r in rows if r["order"] % 2 != part]
        p = secrets.train(seen).probability(np.array([r["x"] for r in held]), np.zeros(len(held), bool)) >= secrets.THRESHOLD
        y = np.array([r["label"] for r in held]) == 1
        hits, misses, false = hits + (p & y).sum(), misses + (~p & y).sum(), false + (p & ~y).sum()
    print(f"held out: {hits} found, {misses} missed, {false} false")
    assert hits >= 50 and hits / (hits + misses) >= 0.9 and hits / (hits + false) >= 0.9


def test_a_forest_is_its_trees():
    tree = (np.array([0, -1, -1]), np.array([0.5, 0, 0]), np.array([1, 0, 0]), np.array([2, 0, 0]), np.array([0.0, 0.1, 0.9]))
    x = np.zeros((2, len(secrets.FEATURES)))
    x[1, 0] = 1
    assert secrets.Forest([tree]).probability(x, np.array([True, False])).tolist() == [0.1, 0.9]
    assert secrets.Forest([]).probability(x, np.array([False, True])).tolist() == [0.0, 1.0]
    assert list(secrets.candidates(None)) == [] and list(secrets.candidates("plain words only")) == []


def test_the_forest_answers_as_the_fitted_model(spark, monkeypatch, tmp_path):
    from pyspark.ml.classification import RandomForestClassificationModel
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rng = np.random.default_rng(4)
    x = rng.random((600, len(secrets.FEATURES))).round(2)
    rows = [(i, float(r[0] + r[3] * r[5] > 0.9), r.tolist()) for i, r in enumerate(x)]
    findings = spark.createDataFrame(rows, "order long, label double, x array<double>")
    monkeypatch.setattr(secrets, "scratch_path", lambda *_: str(tmp_path / "forest"))
    forest = secrets.train(findings)
    model = RandomForestClassificationModel.load(str(tmp_path / "forest"))
    want = model.transform(findings.select("order", array_to_vector("x").alias("features"))).orderBy("order").select(vector_to_array("probability")[1].alias("p")).collect()
    got = forest.probability(x, np.zeros(len(x), bool))
    assert got == pytest.approx([r["p"] for r in want], abs=1e-12) and 0.05 < (got > 0.5).mean() < 0.95


@pytest.mark.parametrize("size", [1, 3, 10, 500])
def test_the_dictionary_is_the_most_frequent_words(spark, size):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"{'abcdefghij'[int(k) % 10]}{'klmnopqrst'[int(k) // 10]}word" for k in rng.zipf(1.3, 50) % 100) for _ in range(40)]
    d = spark.createDataFrame([(t,) for t in texts], "text string")
    counts = Counter(w for t in texts for w in t.split())
    assert secrets.dictionary_of(d, size=size) == {w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:size]}


def test_batches_are_bounded_and_a_lower_bound_stays(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(name)
    bound_batches(spark)
    assert spark.conf.get(name) == str(16 << 20)
    spark.conf.set(name, "1000000")
    bound_batches(spark)
    assert spark.conf.get(name) == "1000000"
    spark.conf.unset(name)


HEX640 = "0123456789abcdef" * 40
JWT = "eyJhbGciOiJIUzI1NiIsInR5cCI6IkpXVCJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5N_XgL0n3I9PlFUP0THsR8U"


@pytest.mark.parametrize(
    ("text", "value"),
    [
        (f'token = "{HEX640}" end', HEX640),
        (f"see {HEX640} end", HEX640),
        (f"Bearer {JWT} end", JWT),
        ("key MTk4NjIyNDgzNDcxOTI1MjQ4.Cl2FMQ.ZnCjm1XVW7vRze4b7Cq4se7kKWs end", "MTk4NjIyNDgzNDcxOTI1MjQ4.Cl2FMQ.ZnCjm1XVW7vRze4b7Cq4se7kKWs"),
        ('{"password": "Tr0ub4dor&3xyz"}', "Tr0ub4dor&3xyz"),
        ('{\\"password\\": \\"Tr0ub4dor&3xyz"}', "Tr0ub4dor&3xyz"),
        ("DB_PASSWORD=Tr0ub4dor&3xyz", "Tr0ub4dor&3xyz"),
        ("conf/db.userToken=Tr0ub4dor&3xyz", "Tr0ub4dor&3xyz"),
        ("password => Tr0ub4dor&3xyz", "Tr0ub4dor&3xyz"),
        ("password\t=  Tr0ub4dor&3xyz", "Tr0ub4dor&3xyz"),
        ("see postgres://admin:hunter22-xyz@db.example.com:5432/app end", "hunter22-xyz"),
        ("redis://:s3cr3tpassw0rd@cache", "s3cr3tpassw0rd"),
        ('password = "abcdefgh,ijklmnop;qrst" and', "abcdefgh,ijklmnop;qrst"),
        ('password = "abc,defghijk"', "abc,defghijk"),
        ("pwd: s3cr3t7", "s3cr3t7"),
        ('password = "correct horse battery staple 99" end', "correct horse battery staple 99"),
        ("secret: 'a<b>c;d,e \"f\"' end", 'a<b>c;d,e "f"'),
        ('token="with \\" a quote" end', 'with \\" a quote'),
        ('{\\"token\\": \\"two words, one\\"}', "two words, one"),
        ('token = "unclosed-here12 and\nmore"', "unclosed-here12"),
        ("token=abcdef,next=1", "abcdef"),
    ],
)
def test_candidates_are_whole(text, value):
    assert [text[start:end] for start, end, *_ in secrets.candidates(text)] == [value]


def test_ordinary_text_gives_no_candidate_and_scans_are_linear():
    assert list(secrets.candidates('password = "" and pwd = "abcde" and token: abcde')) == []
    assert list(secrets.candidates("a tokenizer: something, https://www.example.com/path/12/foo-bar-baz and 3.14")) == []
    start = time.perf_counter()
    for text in ("http://" * 30_000, "a://b:" * 30_000, "token " * 40_000, "token = " * 30_000, "a." * 100_000, "token" * 40_000, "a1" * 100_000 + "@", "token=" * 30_000, "abcdefghijklmnop1." + "b." * 100_000, "token='" * 30_000, "token=\"a " * 30_000, "token=\\'" * 30_000, "token=\"" + "token=\\'a " * 30_000, "token='" + "\\" * 200_000):
        list(secrets.candidates(text))
    assert time.perf_counter() - start < 10


def test_long_values_and_tokens_are_masked_whole(spark):
    rng = np.random.default_rng(5)
    hexa = lambda n: "".join(rng.choice(list("0123456789abcdef"), n))
    rows = [(i, f"{prose('en', i, 20)} " + (f'token = "{hexa(40)}"' if i % 2 else "".join(map(str, rng.integers(0, 10, 16)))) + " end") for i in range(60)]
    rows += [(100, f'the token = "{HEX640}" end'), (101, f"the header {JWT} end"), (102, f"the DB_TOKEN={hexa(40)} end"), (103, f'the "token": "{hexa(40)}" end')]
    clean = {r["doc_id"]: r["clean"] for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).select("row.doc_id", "clean").collect()}
    assert [clean[i] for i in (100, 101, 102, 103)] == ['the token = "[secret]" end', "the header [secret] end", "the DB_TOKEN=[secret] end", 'the "token": "[secret]" end']


def test_few_secrets_among_many_findings_are_learnt(spark):
    rng = np.random.default_rng(6)
    hexa = lambda n: "".join(rng.choice(list("0123456789abcdef"), n))
    rows = [(i, f"{prose('en', i, 9)} " + "".join(map(str, rng.integers(0, 10, 16))) + " end") for i in range(4000)]
    rows += [(10_000 + i, f'{prose("en", i, 9)} token = "{hexa(40)}" end') for i in range(6)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    sent = spark.sparkContext.broadcast(secrets.dictionary_of(d))
    labels = Counter(r["label"] for r in secrets.findings(d, sent, "text", F.lit(""), 200).collect())
    assert labels[1.0] == 6 and 120 < labels[0.0] < 280
    out = secrets.scan(d, sample=200).select("row.doc_id", "clean").collect()
    assert all((secrets.MASK in r["clean"]) == (r["doc_id"] >= 10_000) for r in out)


# -- URL filters


def brute_judge(url, rules):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1], m[2]) if m else ("", "")
    host = "".join(chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch for ch in host)
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


URLS = ["http://EXAMPLE.com/en/7?x", "https://a.b.example.com/en/71#y", "x://example.com/en", "http://notexample.com/en/7", "ftp://example.net/de/8", "http://org/es/", None, "", "no scheme", "://", "http://com/en/", "http://ex.com?/en/", "a://b://com/en/", "http://" + "a." * 3000 + "com/en/", "http://É.org/es/ü"]


@pytest.mark.parametrize("limit", [100, 0])
def test_urls_equal_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(urlfilter, "BROADCAST_RULES", limit)
    d = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS + URLS)], "page_id long, url string, host string")
    rules = [*RULES, ("example.com", "/en/7", "allow"), ("com", "", "allow"), ("org", "/es/ü", "block")]
    out = urlfilter.judge(d, urlfilter.rules_frame(spark, rules)).select("row.page_id", "host", "path", "rule", "verdict").collect()
    assert len(out) == len(URLS) * 2
    for r in out:
        assert tuple(r)[1:] == brute_judge((URLS + URLS)[r["page_id"]], rules)


def test_ten_thousand_rule_shapes(spark):
    shape = spark.range(10_000).select(F.concat(F.lit("h"), F.expr("repeat('a', cast(id % 100 as int))"), F.lit(".com")).alias("host"), F.concat(F.lit("/"), F.expr("repeat('b', cast(id div 100 as int))")).alias("path"), F.lit("block").alias("verdict"))
    urls = [f"http://x.h{'a' * (i % 120)}.com/{'b' * (i % 130)}{'/c' * (i % 2)}" for i in range(400)] + ["http://" + "a." * 20_000 + "ha.com/b" + "b" * 50_000]
    start = time.perf_counter()
    got = urlfilter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), shape).select("row.page_id", "rule", "verdict").collect()
    assert time.perf_counter() - start < 60 and len(got) == len(urls)
    for r in got[:400]:
        i = r["page_id"]
        if i < 400:
            n, m = i % 120, min(i % 130, 99)
            assert (r["rule"], r["verdict"]) == ((f"h{'a' * n}.com/{'b' * m}", "block") if n < 100 else (None, "allow"))
    assert {r["page_id"]: r["rule"] for r in got}[400] == "ha.com/" + "b" * 99


def test_urls_without_rules(spark):
    d = spark.createDataFrame([(1, "http://a/b")], "page_id long, url string")
    assert urlfilter.judge(d, urlfilter.rules_frame(spark, [("x", "/", "block")]).limit(0)).first()["verdict"] == "allow"
    assert urlfilter.judge(d.limit(0), urlfilter.rules_frame(spark, RULES)).count() == 0


# -- shingles and fingerprints


def brute_shingles(text):
    w = WORDS.findall((text or "").translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", "b", "É", "\x1c", "word", "\u3000", "x" * 1500]), max_size=40), st.sampled_from([" ", "\t", "\n\n", " \x0b"]))
def test_shingle_sets_match(words, gap):
    text = gap.join(words)
    assert len(S.shingle_set(text)) == len(brute_shingles(text))


def test_long_texts_in_pieces(monkeypatch):
    text = prose("en", 1, 3000)
    whole = S.word_hashes(text)
    monkeypatch.setattr(S, "_CHUNK", 64)
    assert (S.word_hashes(text) == whole).all()


@pytest.mark.parametrize("rows", [3, 1000])
def test_edited_fingerprints(docs, empty, rows):
    got = fingerprint.edited_fingerprints(docs, shard_rows=rows).collect()
    data = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in docs.collect()))
    assert len(got) == len(data)
    want = Counter()
    for (no, i, t), (_, _, after) in zip(data, data[1:] + data[:1]):
        e = fingerprint.edited(t, after)
        want[None if no else i, len(t), hashlib.sha256(e.encode()).hexdigest()] += 1
        a, b = brute_shingles(t), brute_shingles(e)
        true = len(a & b) / len(a | b) if a | b else 1.0
        row = next(r for r in got if r["doc_id"] == (None if no else i) and r["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest())
        assert abs(row["near_edited"] - true) < 0.12
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == want
    assert fingerprint.edited_fingerprints(empty).count() == 0


def test_sketches_merge_and_estimate(spark):
    a, b = (" ".join(f"w{i}" for i in range(*r)) for r in ((0, 3000), (1000, 3000)))
    x, y = fingerprint.sketch(a), fingerprint.sketch(b)
    assert (fingerprint.decode(fingerprint.encode(x)) == x).all()
    assert abs(fingerprint.distinct(x) / 2996 - 1) < 0.25
    assert abs(fingerprint.containment(y, x) - 1) < 0.15 and abs(fingerprint.resemblance(x, y) - 0.667) < 0.12
    d = spark.createDataFrame([("g", a), ("g", b), ("h", None), (None, b)], "g string, text string")
    parts = fingerprint.fingerprints(d, key="g")
    out = {r["g"]: r["fingerprint"] for r in fingerprint.merge_fingerprints(parts, "g").collect()}
    assert out["g"] == fingerprint.encode(x) and out["h"] == "" and out[None] == fingerprint.encode(y)


# -- language


def test_language_of_prose_and_junk(docs, empty):
    out = {(r["doc_id"], r["i"]): r for r in language.identify(docs, declared=F.col("lang"), host=F.col("source"), sample=1000).select("row.doc_id", F.col("row.target").alias("i"), "language", "posterior", "kept").collect()}
    for i in range(40):
        assert out[i, i]["language"] == list(PROSE)[i % 3] and out[i, i]["kept"]
    for i in (42, 43, 44):
        assert out[i, None]["language"] == language.NO_LANGUAGE and not out[i, None]["kept"]
    kept = language.accepted(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 3
    assert language.accepted(empty).count() == 0


def test_host_and_declaration_decide_where_text_cannot(spark):
    rows = [(i, prose("fr", i, 40), "fr", "h.fr", "fr", "fr") for i in range(30)] + [(i, prose("en", i, 40), "en", "h.uk", "uk", "uk") for i in range(30, 60)]
    rows += [(60, "e", None, "h.fr", "fr", "fr"), (61, "e", None, "h.uk", "uk", "uk"), (62, "e", "fr", None, None, None)]
    d = spark.createDataFrame(rows, "id long, text string, decl string, host string, dom string, suf string")
    out = {r["id"]: r["language"] for r in language.identify(d, declared=F.col("decl"), host=F.col("host"), domain=F.col("dom"), suffix=F.col("suf")).select("row.id", "language").collect()}
    assert (out[60], out[61], out[62]) == ("fr", "en", "fr")


def test_every_declared_language_has_a_model(spark, monkeypatch):
    rows = []
    for k in range(40):
        rng = np.random.default_rng(k)
        words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(12)]
        rows += [(f"l{k:02}", " ".join(rng.choice(words, 40))) for _ in range(6)]
    d = spark.createDataFrame(rows, "lang string, text string")
    model = language.train(d, "lang", "text", F.xxhash64("text"))
    assert model.languages == sorted({lang for lang, _ in rows})
    assert all(model.languages[int(np.argmax(model.score(text)[:-1]))] == lang for lang, text in rows)
    monkeypatch.setattr(language, "MODEL_BYTES", 39 * 4 * language.BUCKETS)
    with pytest.raises(ValueError, match="do not fit"):
        language.train(d, "lang", "text", F.xxhash64("text"))


def brute_posteriors(rows):
    """(language, posterior) of (text, declared, host) rows: the definition, word for word."""

    def buckets(text):
        data = b" " + (text or "").encode().lower() + b" "
        data = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in data)
        return [((a << 16 | b << 8 | c) * 0x9E3779B1 % 2**32) >> 18 for a, b, c in zip(data, data[1:], data[2:]) if b != 32]

    def logs(total, n):
        return [math.log(x / total) for x in n]

    langs = sorted({lang for _, lang, _ in rows if lang is not None})
    models = []
    for lang in langs:
        n = [0.5] * language.BUCKETS
        for text, own, _ in rows:
            if own == lang:
                for b in buckets(text):
                    n[b] += 1
        models.append(logs(sum(n), n))
    models.append([-math.log(language.BUCKETS)] * language.BUCKETS)
    scores = [[sum(m[b] for b in buckets(t)) / 3 for m in models] if buckets(t) else None for t, _, _ in rows]
    label = [None if s is None else s.index(max(s)) for s in scores]
    k = len(models)
    whole = [sum(x == i for x in label) for i in range(k)]
    prior = [(whole[i] + 1) / (sum(whole) + k) for i in range(k)]
    kinds = len({lang for (_, lang, _), x in zip(rows, label) if lang is not None and x is not None})
    out = []
    for (_, lang, host), s in zip(rows, scores):
        if s is None:
            out.append(("und", 0.0))
            continue
        own = [sum(x == i and h == host for (_, _, h), x in zip(rows, label)) for i in range(k)]
        p = [(own[i] + 20 * prior[i]) / (sum(own) + 20) for i in range(k)] if host is not None else prior
        total = [s[i] + math.log(p[i]) for i in range(k)]
        if lang is not None:
            given = [sum(x == i and d == lang for (_, d, _), x in zip(rows, label)) for i in range(k)]
            if any(given):
                total = [total[i] + math.log((given[i] + 1) / (whole[i] + 1 + kinds)) for i in range(k)]
        best = total.index(max(total))
        out.append(([*langs, "und"][best], 1 / sum(math.exp(x - total[best]) for x in total)))
    return out


def test_posteriors_equal_brute_force(spark):
    rows = [(prose(lang, i, 3 + i), lang, f"h{i % 3}") for i, lang in enumerate(["en", "de", "fr"] * 5)]
    rows += [(prose("en", 90 + i, 6), "de", "h1") for i in range(6)]  # declared wrongly in bulk
    rows += [("zq xj vw", None, None), (prose("de", 99, 4), None, "h1"), ("die", "fr", None), ("", "en", "h1"), (None, None, None), ("12 34", "rare", "h2"), (prose("fr", 98, 9), "other", "h2")]
    d = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: (r["language"], r["posterior"]) for r in language.identify_documents(d).select("row.doc_id", "language", "posterior").collect()}
    for i, (lang, p) in enumerate(brute_posteriors(rows)):
        assert got[i][0] == lang and got[i][1] == pytest.approx(p, abs=1e-4), rows[i]
    assert got[len(rows) - 4][0] == "und"


def test_declarations_named_like_no_language(spark):
    rows = [(i, prose("en", i, 30), "und", "s") for i in range(9)] + [(i, prose("fr", i, 30), "other", "s") for i in range(9, 18)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumns({"rest": F.lit(1), "none": F.lit(2), "scores": F.lit(3)})
    out = language.accepted(d)
    assert out.columns == d.columns and {r["doc_id"]: r["lang"] for r in out.collect() if r["doc_id"] >= 9} == {i: "other" for i in range(9, 18)}


# -- licenses


def brute_license(text):
    norm = lambda s: re.sub(r"[\W_]+", " ", s.lower()).split()
    grams = lambda s: set(zip(norm(s), norm(s)[1:]))
    best = None
    lines = (text or "").split("\n")
    for k, line in [*enumerate(lines), *([(10**9, text)] if len(lines) > 1 else [])]:
        a = grams(line)
        for name, notice in licenses.TEMPLATES:
            b = grams(notice)
            if a and 2 * len(a & b) / (len(a) + len(b)) >= 0.75:
                best = min(best or (9,), (-2 * len(a & b) / (len(a) + len(b)), k, name))
    return best and best[2]


def test_licenses_equal_brute_force(spark, empty):
    notice = licenses.TEMPLATES[3][1]
    texts = [None, "", "MIT", "Released under the MIT License.", "released  under THE mit-license", notice, notice.replace(" may", "\nmay"), "x\n" + notice + "\ny", "Licensed under CC BY 4.0.\nLicensed under CC BY-NC 4.0.", prose("en", 1, 5000), notice + " " + prose("en", 2, 9)]
    d = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, license string")
    for r in licenses.scan(d).select("row.doc_id", "license").collect():
        assert r["license"] == brute_license(texts[r["doc_id"]]), texts[r["doc_id"]]
    assert licenses.scan(empty).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(d, templates=[])


def brute_windows(text, templates=licenses.TEMPLATES):
    """The best Dice and the license of any window, with its first line, by trying all of them."""
    at = [(w, k) for k, line in enumerate(text.split("\n")) for w in re.sub(r"[\W_]+", " ", line.lower()).split()]
    grams = [(a[0], b[0]) for a, b in zip(at, at[1:])]
    best = None
    for name, notice in templates:
        norm = re.sub(r"[\W_]+", " ", notice.lower()).split()
        b = set(zip(norm, norm[1:]))
        for i in range(len(grams)):
            if grams[i] in b:
                for j in range(i + 1, min(len(grams), i + int(len(b) / 0.6 + 1e-9)) + 1):
                    a = set(grams[i:j])
                    dice = 2 * len(a & b) / (len(a) + len(b))
                    if dice >= 0.75:
                        best = min(best or (0,), (-dice, at[i][1], name))
    return best


def test_wrapped_and_embedded_licenses(spark):
    def wrapped(notice, n):
        w = notice.split()
        return "\n".join(" ".join(w[i : i + n]) for i in range(0, len(w), n))

    long = prose("en", 3, 400)
    texts = [f"{long}\n{wrapped(n, 7)}\n{long}" for _, n in licenses.TEMPLATES] + [f"{long}. {n} {long}" for _, n in licenses.TEMPLATES]
    texts += [f"{long}\n\n{wrapped(dict(licenses.TEMPLATES[16:18])['GPL-3.0'].replace('program', 'small library').replace('either', 'in'), 6)} {long}", f"{long} this is licensed under the terms of the house {long}", "Licensed under CC BY-NC 4.0. Licensed under CC BY 4.0. " + long]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan(d).select("row.doc_id", "license", "dice", "line").collect()}
    for i, t in enumerate(texts):
        want = brute_windows(t)
        assert (got[i]["license"], got[i]["dice"], got[i]["line"]) == ((want[2], round(-want[0], 9), want[1]) if want else (None, None, None)), t
    n = len(licenses.TEMPLATES)
    assert [got[i]["license"] for i in range(2 * n)] == [name for name, _ in licenses.TEMPLATES] * 2 and got[2 * n]["license"] == "GPL-3.0" and got[2 * n + 1]["license"] is None


def test_windows_over_repeated_and_shuffled_notices(spark):
    """Few words in any order, so that windows hold bigrams many times and runs are longer than windows."""
    templates = [("A", "a b a c a d b c d"), ("B", "a b c d a"), ("C", "x a b y c d x b")]
    rng = random.Random(7)
    texts = ["\n".join(" ".join(rng.choices("abcdxyz"[: rng.choice([2, 4, 7])], k=rng.randint(1, 9))) for _ in range(rng.randint(2, 12))) for _ in range(300)]
    texts += ["\n".join([rng.choice(templates)[1]] * rng.randint(2, 9)) for _ in range(30)] + ["a b " * 40 + "\n" + t + " d\n" + "c a " * 30 for _, t in templates]
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), templates=templates)
    for r in got.select("row.doc_id", "license", "dice", "line").collect():
        t = texts[r["doc_id"]]
        want = min(filter(None, [brute_windows(t, templates), *brute_units(t, templates)]), default=None)
        assert (r["license"], r["dice"], r["line"]) == ((want[2], round(-want[0], 9), -1 if want[1] == 2**31 - 1 else want[1]) if want else (None, None, None)), t


def brute_units(text, templates):
    for k, line in [*enumerate(text.split("\n")), *([(2**31 - 1, text)] if "\n" in text else [])]:
        w = line.split()
        a = set(zip(w, w[1:]))
        for name, notice in templates:
            b = set(zip(notice.split(), notice.split()[1:]))
            if a and 2 * len(a & b) / (len(a) + len(b)) >= 0.75:
                yield -2 * len(a & b) / (len(a) + len(b)), k, name


def test_a_text_of_a_thousand_licenses_takes_time_by_its_length(spark):
    """A megabyte in one row; each window of all would be a billion comparisons."""
    name, notice = max((t for t in licenses.TEMPLATES if t[0] == "MIT"), key=lambda t: len(t[1]))
    many = "\n".join(notice.replace("Software", f"Software{i % 7}", 1) for i in range(1000))
    d = spark.createDataFrame([(0, many), (1, many.replace("\n", " "))], "doc_id long, text string")
    start = time.monotonic()
    got = licenses.scan(d).select("row.doc_id", "license", "dice", "line").collect()
    assert [(r["license"], r["line"]) for r in got] == [(name, 0)] * 2 and all(r["dice"] > 0.97 for r in got)
    assert time.monotonic() - start < 120


def test_whole_license_texts(spark):
    """A license file as it is written: a head, a copyright line and wrapped paragraphs."""
    texts = {name: text for name, text in licenses.TEMPLATES if name in ("MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Zlib")}  # the last of a name is whole
    rows = [(name, f"{name} License\n\nCopyright (c) 2020 Some One\n\n" + re.sub(r"(.{50,70}) ", r"\1\n", text) + "\n") for name, text in texts.items()]
    got = licenses.scan(spark.createDataFrame(rows, "name string, text string")).select("row.name", "license", "dice").collect()
    assert all(r["license"] == r["name"] and r["dice"] > 0.95 for r in got)


# -- near duplicates


def brute_components(rows):
    sets = [(i, frozenset(brute_shingles(t))) for i, t in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b) and None not in (sets[x][0], sets[y][0]):
                parent[find(x)] = find(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            least[find(x)] = min(i, least.get(find(x), i))
    return Counter((i, len(s), None if i is None else least[find(x)]) for x, (i, s) in enumerate(sets))


@pytest.mark.parametrize("block", [1024, 3])
def test_near_duplicates_equal_brute_force(spark, docs, empty, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK_ROWS", block)
    rng = np.random.default_rng(1)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for g in range(4):  # groups of near copies, a chain among them
        words = [f"g{g}w{k}" for k in range(120)]
        for k in range(12):
            if g < 2:
                words = words[:]
                words[rng.integers(0, 120)] = f"new{g}{k}"
                rows.append((1000 + g * 100 + k, " ".join(words)))
            else:
                mine = words[:]
                mine[rng.integers(0, 120)] = f"new{g}{k}"
                rows.append((1000 + g * 100 + k, " ".join(mine)))
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_components(rows)
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in got)
    if block == 1024:
        assert neardup.near_duplicates(empty).count() == 0
        kept = neardup.without_duplicates(docs)
        assert kept.columns == docs.columns and {40, 41} - {r["doc_id"] for r in kept.collect()} == {40, 41} and kept.filter("doc_id is null").count() == 1


def test_rows_with_the_same_key_are_kept_by_their_own_text(spark):
    a, b, c = (prose(lang, 900, 60) for lang in PROSE)
    d = prose("en", 901, 60)
    rows = [(3, a, "x"), (5, b, "x"), (5, a, "x"), (5, d, "x"), (7, c, "x"), (7, c, "x"), (7, c, "y"), (8, "", "x"), (8, "", "x"), (9, c, "x"), (None, a, "x")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.lit(c) for c in ("gone_key", "node", "set_key", "row", "order", "a b")})
    kept = neardup.without_duplicates(table)
    assert kept.columns == table.columns
    kept = kept.collect()
    got = Counter((r["doc_id"], r["text"]) for r in kept)
    assert got == Counter([(3, a), (5, b), (5, d), (7, c), (8, ""), (8, ""), (None, a)])


# -- packing


@pytest.fixture(scope="module")
def vocabulary():
    from public_tokenizers import path

    return path("word_bpe_49k.json")


def test_packing_covers_every_id_once(docs, empty, vocabulary):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary)
    out = packing.pack_documents(docs, vocabulary).toPandas()
    ids = [(r["doc_id"], np.array([*t.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")) for r in docs.collect()]
    assert out["length"].sum() == sum(len(x) for _, x in ids)
    for r in out.itertuples():
        assert any((i == r.doc_id or (i is None and r.doc_id != r.doc_id)) and len(x) == r.doc_tokens and zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for i, x in ids)
    for _, s in out.sort_values("offset").groupby("sequence_id"):
        assert (s["offset"] == s["length"].cumsum() - s["length"]).all()
        assert s["length"].sum() <= 4096 and (s["length"].sum() & (s["length"].sum() - 1)) == 0
    assert packing.pack_documents(empty, vocabulary).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 300), max_size=30))
def test_packs_are_full_and_exact(lengths):
    pieces = list(packing.pack(lengths, 64))
    for d, n in enumerate(lengths):
        mine = sorted((s, k) for e, s, k, _, _ in pieces if e == d)
        assert sum(k for _, k in mine) == n and all(a + k == b for (a, k), (b, _) in zip(mine, mine[1:]))
    sums = Counter()
    for _, _, k, s, _ in pieces:
        sums[s] += k
    assert all(v <= 64 and v & (v - 1) == 0 for v in sums.values())


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["A", "b", "\u00c9", "e\u0301", "H\u0331", "h", "\u0331", "\u00df", "\u0130", "\u03a3", "Hello", "the", "don't", "'LL", " ", "  ", "\t", "\n", "\x0b", "\x0c", "\x1c", "\x85", "\u00a0", "\u2003", ".", ",", "<|", "<|endoftext|>", "<|EndOfText|>", "<|startoftext|>", "12", "\u4e2d", "\uac00", "_", "$"]), max_size=12))
def test_ids_equal_the_tokenizer(name, parts):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    text = "".join(parts)
    t = _TOKENIZERS.setdefault(name, Tokenizer.from_file(path(name)))
    assert next(packing.token_ids([text], path(name))).tolist() == [*t.encode(text, add_special_tokens=False).ids, 2]


_TOKENIZERS: dict = {}


@pytest.fixture
def many_tasks(spark):
    """Small partitions stay apart, as large ones would."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_packing_keeps_an_order(spark, vocabulary, many_tasks):
    d = spark.createDataFrame([(i, prose("en", i, 400), -i) for i in range(300)], "doc_id long, text string, place long").repartition(7)
    out = packing.pack_documents(d, vocabulary, order=[F.col("place")]).toPandas()
    first = out.groupby("doc_id")["sequence_id"].min().to_dict()
    run = {i: s >> 40 for i, s in first.items()}  # the partition
    assert len(set(run.values())) > 1 and all(run[i] <= run[i - 1] for i in range(1, 300))


def test_forgotten_words_are_encoded_again(vocabulary, monkeypatch):
    texts = [prose("de", i, 50) + " don't .. ,. ẞ <|endoftext|> É." for i in range(20)]
    want = [x.tolist() for x in packing.token_ids(texts, vocabulary)]
    monkeypatch.setattr(packing, "REMEMBERED", 8)
    packing._KNOWN.clear()
    assert [x.tolist() for x in packing.token_ids(texts, vocabulary)] == want


# -- quality


def brute_counts(text):
    text = text or ""
    w, seen, dup = WORDS.findall(text), set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {k for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_quality_counts_and_bands(spark, docs, empty):
    rng = np.random.default_rng(0)
    junk = [(200, " ".join("".join(rng.choice(list("qxzjkv0123456789#%"), 9)) for _ in range(60)), "en", "s0", None, None, None, None)]
    good = [(300 + i, prose("en", 300 + i, 200), "en", "s0", None, None, None, None) for i in range(60)]
    d = docs.unionByName(spark.createDataFrame(junk + good, DOCS))
    texts = {(r["doc_id"]): r["text"] for r in d.collect()}
    out = quality.judge(d).collect()
    assert len(out) == d.count()
    for r in out:
        assert tuple(r)[1:6] == brute_counts(texts[r["doc_id"]])
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    by = {r["doc_id"]: r for r in out}
    assert not by[200]["kept"] and not by[200]["base_failed"] and all(by[300 + i]["kept"] for i in range(60))
    assert quality.judge(empty).count() == 0


def brute_bits(rows, order):
    """Bits per letter of (lang, text) rows by the definition, over each text's stream of letters."""

    def grams(text):
        words = [w.lower() for w in WORDS.findall(text or "")]
        stream = "\x02" * (order - 1) + "".join(f"{w}\x02" for w in words)
        return [stream[i : i + order] for i in range(len(stream) - order + 1)]

    model = {}
    for lang in {lang for lang, _ in rows}:
        counts = {order: Counter(g for own, text in rows if own == lang for g in grams(text))}
        for k in range(order - 1, 0, -1):
            counts[k] = Counter(g[1:] for g in counts[k + 1])
        below = {"": 1 / (len(counts[1]) + 1)}
        for k in range(1, order + 1):
            n = [sum(c == i for c in counts[k].values()) for i in range(5)]
            y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else None
            d = [max(0.1, min(i - 0.1, i - (i + 1) * y * n[i + 1] / n[i])) if y is not None and n[i] else i / 2 for i in (1, 2, 3)]
            cut = {g: d[min(c, 3) - 1] for g, c in counts[k].items()}
            total, freed = Counter(), Counter()
            for g, c in counts[k].items():
                total[g[:-1]] += c
                freed[g[:-1]] += cut[g]
            below = {g: (c - cut[g]) / total[g[:-1]] + freed[g[:-1]] / total[g[:-1]] * below[g[1:]] for g, c in counts[k].items()}
        model[lang] = below
    out = []
    for lang, text in rows:
        logs = [math.log2(model[lang][g]) for g in grams(text)]
        out.append(-sum(logs) / len(logs) if logs else None)
    return out


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab\u00e9 \n", max_size=30), st.integers(2, 4), st.sampled_from([1, 3, 1 << 20]))
def test_pieces_hold_the_ngrams_of_the_stream(text, order, part):
    words = text.lower().split()
    stream = "\x02" * (order - 1) + "".join(f"{w}\x02" for w in words)
    want = Counter(stream[i : i + order] for i in range(len(stream) - order + 1))
    got = Counter()
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(quality, "PART", part)  # a text in one part, and in many
        found = quality.pieces(["x y", None, text], order, [2])
        assert found == quality.pieces([text], order)
    for piece, n in found.items():
        for i in range(len(piece) - order + 1):
            got[piece[i : i + order]] += n
    assert got == want


@pytest.mark.parametrize("shard,held", [(quality.SHARD_ENTRIES, quality.HELD_ENTRIES), (40, 100)])
def test_bits_equal_brute_force_at_every_size(spark, shard, held):
    """With one shard of the model, and with many of which a worker holds two or three."""
    rows = [(lang, prose(lang, i, 25 + i)) for i, lang in enumerate(["en", "de", "fr"] * 6)]
    rows += [(None, prose("en", 50, 30)), (None, prose("fr", 51, 30)), ("", prose("de", 52, 30)), ("en", None), ("de", ""), ("rare", "a b c d " * 6), ("en", "Twice TWICE " * 20)]
    d = spark.createDataFrame([(i % 20, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string").coalesce(1)
    out = quality.judge(d, shard=shard, held=held).collect()
    want = Counter((lang, len(WORDS.findall(text or "")), None if bits is None else round(bits, 3)) for (lang, text), bits in zip(rows, brute_bits(rows, quality.ORDER)))
    assert Counter((r["lang"], r["n_words"], None if r["bits"] is None else round(r["bits"], 3)) for r in out) == want


def test_verdicts_equal_brute_force(spark):
    """Base rules, quartiles by language, bands and verdicts, all recomputed from the texts."""
    rng = random.Random(3)
    rows = [(lang, prose(lang or "fr", i, 25 + i % 40)) for i, lang in enumerate(["en", "de", None] * 20)]
    rows += [("en", " ".join("".join(rng.choices("qxzjkvwy", k=5)) for _ in range(40))) for _ in range(3)] + [("de", prose("fr", 95, 40)), ("en", "too short"), ("en", "one two " * 30), ("de", None)]
    out = quality.judge(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string"), band=1.0).collect()
    bits = brute_bits(rows, quality.ORDER)
    words = [WORDS.findall(text or "") for _, text in rows]

    def repeats(w):
        seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        return len({i + k for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for k in range(8)})

    failed = [len(w) < 20 or 100 * repeats(w) > 30 * len(w) for w in words]
    bands = {}
    for lang in {x for x, _ in rows}:
        own = sorted(b for (x, _), b, f in zip(rows, bits, failed) if x == lang and not f)
        low, high = own[math.ceil(len(own) / 4) - 1], own[math.ceil(3 * len(own) / 4) - 1]
        bands[lang] = (low - (high - low), high + (high - low))
    want = {i: not f and bands[lang][0] <= b <= bands[lang][1] for i, ((lang, _), b, f) in enumerate(zip(rows, bits, failed))}
    assert {r["doc_id"]: r["base_failed"] for r in out} == dict(enumerate(failed))
    assert {r["doc_id"]: r["kept"] for r in out} == want
    assert any(want.values()) and any(not want[i] and not failed[i] for i in want)


def test_kneser_ney_sums_to_one(spark):
    found = quality.pieces(["abc abc abd b cab abc dd cab abc abc abd cab"], 3)
    table = quality.kneser_ney(spark.createDataFrame([("en", p, n) for p, n in found.items()], "lang string, piece string, n long"), 3).toPandas()
    letters = sorted(table[table.kind == 1].gram)
    p, g = table[table.kind > 0].set_index("gram")["value"].to_dict(), table[table.kind < 0].set_index("gram")["value"].to_dict()
    floor = math.exp(table[table.kind == 0]["value"].iloc[0])

    def prob(context, x):
        gram = context + x
        if gram in p:
            return math.exp(p[gram])
        if not context:
            return floor
        return math.exp(g.get(context, 0.0)) * prob(context[1:], x)

    for context in ("ab", "\x02\x02", "\x02a", "c\x02", "d", "zz"):
        total = sum(prob(context, x) for x in letters)
        assert total <= 1 + 1e-6 and total + floor >= 0.9


# -- queries and the pipeline


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        db.execute(f"create view {t} as select * from '{SF}/{t}.parquet{'/*.parquet' if __import__('os').path.isdir(f'{SF}/{t}.parquet') else ''}'")
    got, want = QUERIES[name](spark, SF), db.execute(ORACLES[name])
    cols = sorted(got.columns)
    order = [[d[0] for d in want.description].index(c) for c in cols]
    assert cols == sorted(d[0] for d in want.description)
    assert sorted(map(repr, (tuple(r) for r in got.select(*cols).collect()))) == sorted(repr(tuple(r[i] for i in order)) for r in want.fetchall())


def written(spark, df):
    return materialize(df, "test-stage")


def test_pipeline_stages_keep_their_documents(spark, docs, empty):
    """Every stage on nulls, empty and long texts, repeats and clashing columns, and on no rows."""
    given_ids = Counter(r["doc_id"] for r in docs.collect())
    got = written(spark, docs)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, got = got, written(spark, stage(spark, got, SF))
        assert got.columns == docs.columns, name
        ids, earlier = (Counter(r["doc_id"] for r in x.select("doc_id").collect()) for x in (got, before))
        assert set(ids) <= set(given_ids), name
        if name == "language_id":
            assert set(earlier) - set(ids) == {42, 43, 44}
        if name == "minhash_near_dedup":
            assert set(earlier) - set(ids) == {40, 41} and max(ids.values()) == 1
        if name == "secret_scan":
            assert ids == earlier
        mixed = ids
    pieces = corpus_pipeline.STAGES[-1][1](spark, got, SF).toPandas()
    assert set(pieces.doc_id.dropna().astype(int)) == {i for i in mixed if i is not None}
    rows = [(r["doc_id"], r["text"]) for r in got.select("doc_id", "text").collect()]
    assert pieces[pieces.start == 0].shape[0] == len(rows)
    nothing = written(spark, empty)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF).count() == 0


def test_packing_follows_the_mix(spark, many_tasks):
    """The order that the mix wrote reaches the sequences, from partition to partition."""
    d = spark.createDataFrame([(i, prose("en", i, 300), "a") for i in range(400)], "doc_id long, text string, source string").repartitionByRange(9, "doc_id").sortWithinPartitions("doc_id")
    d = written(spark, d)
    assert corpus_pipeline.file_order(d) and not corpus_pipeline.file_order(spark.range(3))
    out = corpus_pipeline.pack_sequences(spark, d, SF).toPandas()
    run = (out.groupby("doc_id")["sequence_id"].min() // (1 << 40)).to_dict()
    assert len(set(run.values())) > 1 and all(run[i - 1] <= run[i] for i in range(1, 400))


def test_files_past_a_hundred_thousand_keep_their_order(spark, tmp_path):
    for i, name in enumerate(("part-99999-a.parquet", "part-100000-a.parquet", "part-100001-a.parquet")):
        spark.createDataFrame([(i,)], "doc_id long").toPandas().to_parquet(tmp_path / name)
    d = spark.read.parquet(str(tmp_path))
    assert [r["doc_id"] for r in d.orderBy(*corpus_pipeline.file_order(d)).collect()] == [0, 1, 2]
    assert corpus_pipeline.file_order(spark.range(3)) == []


def test_pipeline_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "minhash_near_dedup", "secret_scan", "source_mixing", "packing"]
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == [c.split()[0] for c in packing.SCHEMA.split(", ")]
    assert out.filter("length <= 0 or length > 4096").count() == 0 and out.count() > 100


def test_remembered_parts_stay_bounded_within_a_text(monkeypatch):
    from public_tokenizers import path

    from tilth.llm import packing

    monkeypatch.setattr(packing, "REMEMBERED", 50)
    packing._KNOWN.clear()
    file = path("word_bpe_49k.json")
    v = packing._loaded(file)
    texts = [" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}ê{m}" for i in range(400) for m in ("", ".", ",")), "Été, café. (naïve) 3,5. µ. aª, .,", None]
    got = [x.tolist() for x in packing.token_ids(texts, file)]
    assert got == [[*v.tokenizer.encode(t or "", add_special_tokens=False).ids, packing.END_ID] for t in texts]
    assert len(v.known) <= 50 and len(v.known.older) <= 50
    packing._KNOWN.clear()
