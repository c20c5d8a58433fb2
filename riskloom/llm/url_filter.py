"""URL filter: host-suffix and path-prefix expressions, joined on short hash prefixes and confirmed by full digests.

A URL's host is what lies between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; its
path goes on up to ``?``, ``#`` or the end.  Each site (host and path) becomes the pairs of its host's suffixes (at label borders, of as
many labels as rules have) and its path's prefixes (of the lengths that rules have), so a URL of any length has few; the SHA-256 of such a pair is matched with the rules first by its
leading PREFIX_HEX digits, an equi-join, and then in full.

Defined cases: a null URL or one without ``://`` has an empty host and path, fits no rule and gets the default verdict;
of the rules that fit, the longest wins (then the longer host, then the smaller text, then block over allow); a rule
given twice counts once; rules with a null host, path or verdict are ignored; repeated rows and null ids keep their rows; no rules or no pages are fine; other
columns don't matter.  URLs without a host aren't joined at all, and popular sites go by broadcast whether a rule fits them or not.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import HOT_SHARE, join_unique, read, stage

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
PREFIX_HEX = 8
#: Rules up to this number are broadcast; a larger list is joined by a shuffle on the hash prefix.
BROADCAST_RULES = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: DataFrame | Iterable[tuple[str, str, str]]) -> DataFrame:
    """``(prefix, digest, labels, best)`` for each rule; best orders the rules that fit one URL."""
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), "host string, path string, verdict string")
    key = F.concat("host", F.lit("\n"), "path")
    best = F.struct(
        (F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"),
        F.concat("host", "path").alias("rule"), F.col("verdict").alias("verdict"),
    )
    digest = F.sha2(key, 256)
    rules = rules.where("host is not null and path is not null and verdict is not null")
    labels = F.length("host") - F.length(F.replace(F.col("host"), F.lit("."))) + 1
    rules = rules.select(digest.alias("digest"), labels.alias("labels"), best.alias("best")).groupBy("digest", "labels").agg(F.max("best").alias("best"))
    return rules.select(F.substring("digest", 1, PREFIX_HEX).alias("prefix"), "digest", "labels", "best")


def expressions(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """All (host suffix, path prefix) pairs of a URL, of the label counts and lengths that rules have, as ``host\\npath`` strings."""
    have = F.length(host) - F.length(F.replace(host, F.lit("."))) + 1
    suffixes = F.filter(F.array(*[F.when(have >= n, F.substring_index(host, ".", -n)) for n in labels]).cast("array<string>"), lambda h: h.isNotNull())
    prefixes = F.filter(F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]).cast("array<string>"), lambda p: p.isNotNull())
    return F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.concat(h, F.lit("\n"), p))))


def judge(pages: DataFrame, rules: DataFrame | Iterable[tuple[str, str, str]] = RULES, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (null where none fits) and ``verdict``; columns of those names are replaced."""
    if default not in ("allow", "block"):
        raise ValueError(default)
    table = stage(rule_table(pages.sparkSession, rules), "rules")
    # Path lengths and label counts are few: no rule is longer than a URL may be.
    shapes = table.select("labels", (F.col("best.size") - F.col("best.host_size")).alias("length")).distinct().collect()
    small = table.count() <= BROADCAST_RULES
    # One more row, of the empty expression, which no rule has: popular sites ask for it, so they are found without a rule, too.
    none = F.sha2(F.lit(""), 256)
    empty = pages.sparkSession.range(1).select(F.substring(none, 1, PREFIX_HEX).alias("prefix"), none.alias("digest"), F.lit(None).cast(table.schema["best"].dataType).alias("best"))
    table = table.select("prefix", "digest", "best").unionByName(empty)
    keep = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    url = F.col(f"`{url_col}`")
    own = pages.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], host_of(url).alias("host"), path_of(url).alias("path"))
    total = own.count()
    popular = F.when(F.col("pages") >= max(1, int(total * HOT_SHARE)), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    # A path is empty or begins with a slash, which no host has: the two together name a site.
    hosted = own.where("host <> ''").withColumn("site", F.concat("host", "path"))
    sites = hosted.groupBy("site").agg(F.first("host").alias("host"), F.first("path").alias("path"), F.count("*").alias("pages"))
    each = expressions(F.col("host"), F.col("path"), sorted({r["labels"] for r in shapes}), sorted({r["length"] for r in shapes}))
    asked = sites.select("site", "pages", F.explode(F.concat(each, popular)).alias("expression")).select("site", "pages", F.sha2("expression", 256).alias("asked")).withColumn("prefix", F.substring("asked", 1, PREFIX_HEX))
    fits = asked.join(F.broadcast(table) if small else table, "prefix").where("asked = digest")
    found = stage(fits.groupBy("site").agg(F.max("best").alias("best"), F.first("pages").alias("pages")), "found")
    # Pages of a popular site don't move, nor do those without a host; the rest is spread by site.
    judged = join_unique(hosted, found, "site", F.col("pages"), total).select(*own.columns, "best")
    judged = judged.unionByName(own.where("host = ''").withColumn("best", F.lit(None).cast(found.schema["best"].dataType)))
    return judged.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict")


SQL = r"""
with rules(rh, rp, v) as (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
u as (
  select page_id, row_number() over () as n,
         translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') as path
  from pages
),
f as (
  select n, rh || rp as rule, v, row_number() over (partition by n order by length(rh || rp) desc, length(rh) desc, rh || rp desc) as k
  from u join rules on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp)
)
select page_id, host, path, rule, coalesce(v, 'allow') as verdict from u left join (select * from f where k = 1) f using (n)
"""

QUERIES = {"op10_url_filter": query}
ORACLE = {"op10_url_filter": SQL}
