"""The registered queries of this subpackage and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilth.llm import alignment, fingerprint, language, lexical, licenses, mixing, neardup, packing, quality, secrets, sharding, urlfilter, warc
from tilth.llm.text import table, word_count
from tilth.scratch import materialize, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


@query()
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents at the weights 5, 2, 1, in training order."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    docs = materialize(docs, "op1-sizes")
    m = mixing.mix(docs, F.col("size"), weights=(5, 2, 1), max_epochs=3)
    out = m.select("row.doc_id", "size", "source_size", "target", "taken", F.get(F.col("copies"), F.lit(0))["position"].alias("position"))
    return out.orderBy(F.col("position").asc_nulls_last(), "doc_id")


@query(
    r"""
    WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
    s AS (SELECT source, sum(size) AS source_size, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM d GROUP BY source),
    c AS (SELECT *, 3.0 * source_size AS cap, 3.0 * source_size / weight AS level, sum(source_size) OVER () AS total FROM s),
    -- a source is full if raising all to its level spends no more than there is
    spent AS (SELECT a.source, a.level, sum(least(b.cap, a.level * b.weight)) AS at_level FROM c a CROSS JOIN c b GROUP BY a.source, a.level),
    l AS (SELECT c.*, at_level <= total AS is_full FROM c JOIN spent ON c.source IS NOT DISTINCT FROM spent.source),
    t AS (SELECT *, (total - coalesce(sum(cap) FILTER (is_full) OVER (), 0)) / sum(weight) FILTER (NOT is_full) OVER () AS rest FROM l)
    SELECT doc_id, size, cast(source_size AS bigint) AS source_size, round(CASE WHEN is_full THEN cap ELSE rest * weight END, 3) AS target
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
    """
)
def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the mix of op1, each document's size and its source's target."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    m = mixing.mix(docs, F.col("size"), weights=(5, 2, 1), max_epochs=3)
    return m.select("row.doc_id", "size", "source_size", F.round("target", 3).alias("target"))


RULES = (
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
)


@query(
    """
    WITH parts AS (
      SELECT page_id,
             translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
      FROM pages),
    rules(h, p, verdict) AS (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
    fits AS (
      SELECT page_id, max_by(h || p, length(h || p)) AS rule, max_by(verdict, length(h || p)) AS verdict
      FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
      GROUP BY page_id)
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
    FROM parts LEFT JOIN fits USING (page_id)
    """
)
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict of the rules on every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    out = urlfilter.judge(pages, urlfilter.rules_frame(spark, RULES))
    return out.select("row.page_id", "host", "path", "rule", "verdict")


@query(
    r"""
    WITH RECURSIVE w AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    s AS (
      SELECT doc_id, CASE WHEN len(ws) >= 5 THEN list_distinct([array_to_string(ws[i:i + 4], ' ') for i in range(1, len(ws) - 3)]) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS sh
      FROM w),
    x AS (SELECT doc_id, unnest(sh) AS h FROM s),
    both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM x a JOIN x b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM both_ JOIN s sa ON sa.doc_id = a JOIN s sb ON sb.doc_id = b WHERE 100 * k >= 75 * (len(sa.sh) + len(sb.sh) - k)),
    edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach(doc_id, root) AS (SELECT doc_id, doc_id FROM s UNION SELECT e.b, r.root FROM reach r JOIN edges e ON e.a = r.doc_id)
    SELECT doc_id, len(any_value(sh)) AS n_shingles, min(root) AS component_id, doc_id = min(root) AS kept
    FROM reach JOIN s USING (doc_id) GROUP BY doc_id
    """
)
def op8_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with a similarity of 0.75 or more."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op9_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of at most 4096 tokens."""
    from public_tokenizers import path

    return packing.pack_documents(table(spark, sf_dir, "documents"), path("word_bpe_49k.json"))


@query(
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM p)
    SELECT page_id, strlen(html) AS payload_bytes,
           array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + cast((cast('0x' || substr(hex, 10 * (i // 8) + 1, 10) AS bigint) >> cast(35 - 5 * (i % 8) AS int)) & 31 AS int), 1) for i in range(32)], '') AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
    FROM f
    """
)
def op2_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back from them."""
    folder = scratch_path(spark, "op2-warc")
    manifest = warc.write_warc(table(spark, sf_dir, "pages"), folder, min_revisit=0)
    return warc.read_warc(manifest, folder, with_payload=False).drop("url", "payload")


@query()
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprint.edited_fingerprints(table(spark, sf_dir, "documents"))


@query()
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and perplexity bands on every document."""
    return quality.judge(table(spark, sf_dir, "documents"))


@query()
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document from text, declaration and source."""
    docs = table(spark, sf_dir, "documents")
    out = language.identify_documents(docs.select("doc_id", "text", "lang", "source"))
    return out.select("row.doc_id", F.col("row.lang").alias("declared"), "language", F.round("posterior", 6).alias("posterior"), "kept")


@query()
def language_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every page from text, markup, address suffix and host."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    host = urlfilter.url_host(F.col("url"))
    labels = F.split(host, r"\.")
    text = F.regexp_replace(F.regexp_replace("html", r"(?s)<(script|style)\b.*?</\1>", " "), r"(?s)<[^>]*>", " ")
    pages = pages.select("page_id", text.alias("text"), host.alias("host"), F.array_join(F.slice(labels, -F.least(F.lit(2), F.size(labels)), F.lit(2)), ".").alias("domain"), F.element_at(labels, -1).alias("suffix"), F.nullif(F.regexp_extract("html", r'(?i)<html[^>]*\blang="([A-Za-z]+)', 1), F.lit("")).alias("declared"))
    out = language.identify(pages, declared=F.col("declared"), host=F.col("host"), domain=F.col("domain"), suffix=F.col("suffix"))
    return out.select("row.page_id", "row.declared", "language", F.round("posterior", 6).alias("posterior"), "kept")


_LISTED = ", ".join("({}, '{}', '{}')".format(i, *(x.replace("'", "''") for x in t)) for i, t in enumerate(licenses.TEMPLATES))
_NORMAL = r"string_split(trim(regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ')"
_BIGRAMS = "unnest([ws[i] || ' ' || ws[i + 1] for i in range(1, len(ws))])"


@query(
    f"""
    WITH listed(id, name, notice) AS (VALUES {_LISTED}),
    tg AS (SELECT DISTINCT id, name, {_BIGRAMS} AS g FROM (SELECT id, name, {_NORMAL.format('notice')} AS ws FROM listed) w),
    ts AS (SELECT id, name, count(*) AS n, ceil(count(*) * 0.75 / 1.25 - 1e-9) AS need, floor(count(*) * 1.25 / 0.75 + 1e-9) AS span FROM tg GROUP BY id, name),
    ln AS (SELECT doc_id, generate_subscripts(ls, 1) - 1 AS k, unnest(ls) AS text FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents) l),
    lw AS (SELECT doc_id, k, {_NORMAL.format('text')} AS ws FROM ln),
    ends AS (SELECT doc_id, k, sum(len([x for x in ws if x <> ''])) OVER (PARTITION BY doc_id ORDER BY k) AS upto FROM lw),
    dg AS (SELECT doc_id, unnest(range(1, len(ws))) AS pos, {_BIGRAMS} AS g FROM (SELECT doc_id, {_NORMAL.format("coalesce(text, '')")} AS ws FROM documents) w),
    hits AS (SELECT doc_id, id, pos, dg.g, row_number() OVER (PARTITION BY doc_id, id ORDER BY pos) AS r FROM dg JOIN tg USING (g)),
    win AS (
      SELECT a.doc_id, id, name, n, a.pos AS i, b.pos AS j
      FROM hits a JOIN hits b USING (doc_id, id) JOIN ts USING (id) WHERE b.pos >= a.pos AND b.pos - a.pos < span AND b.r - a.r + 1 >= need),
    own AS (SELECT w.doc_id, w.id, i, j, count(DISTINCT g) AS k FROM win w JOIN hits h ON h.doc_id = w.doc_id AND h.id = w.id AND h.pos BETWEEN i AND j GROUP BY ALL),
    every AS (SELECT w.doc_id, i, j, count(DISTINCT g) AS k FROM (SELECT DISTINCT doc_id, i, j FROM win) w JOIN dg ON dg.doc_id = w.doc_id AND pos BETWEEN i AND j GROUP BY ALL),
    -- lines and whole texts are units too, however often they repeat a bigram
    unit AS (SELECT DISTINCT doc_id, k, {_BIGRAMS} AS g FROM lw UNION ALL SELECT DISTINCT doc_id, 2147483647, g FROM dg),
    sizes AS (SELECT doc_id, k, count(*) AS n FROM unit GROUP BY ALL),
    met AS (SELECT doc_id, k, id, name, count(*) AS both_ FROM unit JOIN tg USING (g) GROUP BY ALL),
    found AS (
      SELECT w.doc_id, name, 2.0 * own.k / (every.k + n) AS dice, (SELECT min(e.k) FROM ends e WHERE e.doc_id = w.doc_id AND e.upto >= w.i) AS first
      FROM win w JOIN own USING (doc_id, id, i, j) JOIN every USING (doc_id, i, j) WHERE 2.0 * own.k / (every.k + n) >= 0.75
      UNION ALL
      SELECT doc_id, met.name, 2.0 * both_ / (sizes.n + ts.n), k FROM met JOIN sizes USING (doc_id, k) JOIN ts USING (id) WHERE 2.0 * both_ / (sizes.n + ts.n) >= 0.75),
    best AS (SELECT * FROM found QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, first, name) = 1)
    SELECT doc_id, name AS license, round(dice, 9) AS dice, cast(CASE WHEN first = 2147483647 THEN -1 ELSE coalesce(first, -2) END AS bigint) AS line
    FROM documents LEFT JOIN best USING (doc_id)
    """
)
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The license that each document names, if any, and its line; -1 is the whole text, -2 no license."""
    out = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", "license", "dice", F.coalesce("line", F.lit(-2)).cast("long").alias("line"))


@query()
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidates of every document and what the forest makes of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    out = secrets.scan(docs, path=F.col("source"))
    hits = F.filter("spans", lambda s: s["secret"])
    return out.select("row.doc_id", F.size("spans").cast("long").alias("n_candidates"), F.size(hits).cast("long").alias("n_secrets"), "spans", F.sha2("clean", 256).alias("clean_sha256"))


@query()
def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers' tokens in every document."""
    from public_tokenizers import path

    aligned = alignment.align_documents(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    slim = aligned.select("doc_id", "n_a", "n_b", "n_groups", digest.alias("groups_sha256"), "pairs", "times")
    out = alignment.with_corpus_counts(materialize(slim, "op11-links"))
    return out.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256")


@query(
    r"""
    WITH t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
    q AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM benchmark),
    s AS (SELECT count(*) AS n_docs, cast(sum(len(ts)) AS bigint) AS words FROM t WHERE len(ts) > 0),
    d AS (SELECT doc_id, ts, 75 + (25 * len(ts) * n_docs) // words AS m FROM t, s WHERE len(ts) > 0),
    p AS (SELECT doc_id, m, term, count(*) AS tf FROM (SELECT doc_id, m, unnest(ts) AS term FROM d) x GROUP BY ALL),
    w AS (SELECT term, cast(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS bigint) AS w FROM p, s GROUP BY term, n_docs),
    i AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(ts) AS term FROM q) x GROUP BY ALL),
    r AS (SELECT item_id, doc_id, cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS bigint) AS score FROM i JOIN p USING (term) JOIN w USING (term) GROUP BY ALL HAVING score > 0)
    SELECT item_id, cast(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS int) AS rank, doc_id, score
    FROM r QUALIFY rank <= 20
    """
)
def op12_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


@query()
def op13_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes, equal texts together."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.unhex(F.md5(text)).alias("text_md5"))
    out = sharding.shard_documents(docs, shards=40, size=F.col("size"), group=F.col("text_md5"), columns=("doc_id", "text_crc32")).rows
    return out.select("row.doc_id", "size", "row.text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
