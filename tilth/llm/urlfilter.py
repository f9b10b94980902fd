"""URL filters: rules on host suffixes and path prefixes.

Every URL is expanded into its host suffixes, at labels and of lengths that some rule has.  They meet the
rules' hosts in an equi-join on a short prefix of their SHA-256, and full digests confirm.  A host that was met
brings the lengths of its own rules' paths; with these the URL is expanded into (host suffix, path prefix)
expressions, which meet the rules in the same way, and the longest rule that fits decides.  So a URL is hashed once per label and
once per path length of the hosts that it is under, whatever shapes the other rules have.

Only ids travel with the expressions; verdicts are joined back to the pages.

Defined results: a null URL or one without ``://`` has an empty host and path and
fits no rule; the longest rule wins, among equally long ones that with the longer
host, then the one that blocks; repeated pages are judged one by one; an empty
rule list lets everything through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilth.llm.text import ascii_lower
from tilth.scratch import materialize

#: (host, path, verdict)
Rule = tuple[str, str, str]
#: Rules up to this number are broadcast; beyond it both sides are shuffled, salted.
BROADCAST_RULES = 100_000
SALTS = 16


def url_host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _short(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def rule_table(rules: DataFrame) -> DataFrame:
    """(host, path, verdict) rules with digests and a precedence that is unique."""
    r = rules.select(ascii_lower(F.col("host")).alias("host"), "path", "verdict").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block > allow
    rule = F.concat("host", "path")
    precedence = (F.length(rule).cast("long") * 65536 + F.length("host")) * 2 + (F.col("verdict") == "block").cast("long")
    return r.select(F.col("host").alias("rule_host"), rule.alias("rule"), F.col("verdict").alias("rule_verdict"), precedence.alias("precedence"), F.sha2(F.concat_ws("\n", "host", "path"), 256).alias("rule_digest"), F.length("host").alias("host_length"), F.length("path").alias("path_length"))


def _meeting(expressions: DataFrame, known: DataFrame, few: bool) -> DataFrame:
    """Expressions (uid, digest, ...) with the row of ``known`` (known_digest, ...) of equal digest."""
    short = known.withColumn("short", _short(F.col("known_digest")))
    asked = expressions.withColumn("short", _short(F.col("digest")))
    if few:
        met = asked.join(F.broadcast(short), "short")
    else:
        # a host with a third of all pages repeats its expressions: deal them out
        asked = asked.withColumn("salt", F.pmod(F.col("uid"), F.lit(SALTS)).cast("int"))
        met = asked.join(short.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["short", "salt"]).drop("salt")
    return met.filter("digest = known_digest").drop("short", "digest")


def judge(pages: DataFrame, rules: DataFrame, *, url: str = "url", default: str = "allow") -> DataFrame:
    """One row per page: ``row`` (its columns), host, path, rule, verdict.

    The driver gets the distinct lengths of the rules' hosts and the number of rules.
    """
    table = materialize(rule_table(rules), "url-rules")
    sizes = sorted(r[0] for r in table.select("host_length").distinct().collect())  # at most the longest host
    n_rules = table.count()
    page = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), F.col(f"`{url}`").alias("url"))
    page = page.select(F.monotonically_increasing_id().alias("uid"), "row", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    if not n_rules:
        return page.select("row", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    page, few = materialize(page, "url-pages"), n_rules <= BROADCAST_RULES
    host, path = F.col("host"), F.col("path")
    at_label = lambda h: (F.length(host) == h) | ((F.length(host) > h) & (F.substring(host, -h - 1, F.lit(1)) == "."))
    fits = F.filter(F.array(*map(F.lit, sizes)), at_label)
    suffixes = page.select("uid", "path", F.explode(F.transform(fits, lambda h: F.when(h > 0, F.substring(host, -h, h)).otherwise(""))).alias("suffix"))
    digest = lambda *parts: F.sha2(F.concat_ws("\n", *parts), 256)
    hosts = table.groupBy(F.sha2("rule_host", 256).alias("known_digest")).agg(F.collect_set("path_length").alias("lengths"))
    under = _meeting(suffixes.withColumn("digest", F.sha2("suffix", 256)), hosts, few)
    under = under.select("uid", "path", "suffix", F.explode(F.filter("lengths", lambda p: p <= F.length(path))).alias("size"))
    prefix = F.when(F.col("size") > 0, F.substring(path, F.lit(1), F.col("size"))).otherwise("")
    known = table.select(F.col("rule_digest").alias("known_digest"), F.struct("precedence", "rule", "rule_verdict").alias("fit"))
    met = _meeting(under.select("uid", digest("suffix", prefix).alias("digest")), known, few)
    best = met.groupBy("uid").agg(F.max("fit").alias("fit"))
    return page.join(best, "uid", "left").select("row", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.rule_verdict", F.lit(default)).alias("verdict"))


def rules_frame(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """A short list of rules as a table; a long one is better read from a file."""
    listed = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules])
    return spark.range(1).select(F.inline(listed.cast("array<struct<host:string,path:string,verdict:string>>")))
