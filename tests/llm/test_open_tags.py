"""Pages with tags left open, popular sites without a rule, and borders as bits."""

import html
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from riskloom.llm import byte_bpe, url_filter, warc_derivatives

PIECES = ["<", ">", "<a ", "<a href=x", " href='y'", ' href="', '"', "'", "<p", "<br/>", "<!--", "-->", "<script", "<script>", "</script", "</SCRIPT >", "<style a", "</style>", "<title", "<title>", "</title>", "<html", ' lang="', ' lang="en"', " ", "\n", "t", "&lt;", "</noscript>", "<noscript>"]


def plainly(page: str) -> tuple[str, str]:
    """Text and metadata by the patterns as they read, without regard to time."""
    t = re.sub(r"(?s)<!--.*?-->", " ", page)
    for tag in ("script", "style", "noscript"):
        t = re.sub(rf"(?is)<{tag}(\s[^>]*)?>.*?</{tag}\s*>", " ", t)
    t = re.sub(r"<[^>]*>", "", re.sub(warc_derivatives.BREAKS, "\n", t))
    t = re.sub(r"[ \t\r\f]+", " ", html.unescape(t))
    text = re.sub(r" ?\n[ \n]*", "\n", t).strip("\n ")
    title = re.search(r"(?is)<title[^>]*>(.*?)</title>", page)
    title = re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", title[1]))).strip(" ") if title else ""
    language = re.search(r'(?i)<html[^>]*\slang="([^"]*)"', page)
    links = dict.fromkeys(html.unescape(re.sub("^[\"']|[\"']$", "", x)) for x in re.findall(warc_derivatives.HREF, page))
    return text, f"title: {title}\r\nlang: {language[1] if language else ''}\r\n" + "".join(f"outlink: {x}\r\n" for x in links)


def made(spark, pages):
    rows = spark.createDataFrame(list(enumerate(pages)), "i int, h string").select("i", warc_derivatives.plain_text(F.col("h")), warc_derivatives.page_metadata(F.col("h"))).collect()
    return [tuple(r)[1:] for r in sorted(rows)]


@pytest.mark.parametrize("careless", [0, warc_derivatives.CARELESS])
def test_open_tags_change_no_result(spark, monkeypatch, careless):
    monkeypatch.setattr(warc_derivatives, "CARELESS", careless)
    draw = random.Random(7)
    pages = ["".join(draw.choices(PIECES, k=draw.randint(0, 25))) for _ in range(4000)]
    for page, got in zip(pages, made(spark, pages), strict=True):
        assert got == plainly(page), page


def test_open_tags_take_linear_time(spark):
    made(spark, ["<p>warm</p>"])
    for piece in ("<a ", "<p ", "<!-- ", "<script ", "<script>", "<style>", "<title>", "<html ", '<html lang="', "<a href=\"", "<a href ", "<"):
        page = piece * (1_000_000 // len(piece))
        begin = time.time()
        made(spark, [page, page + "<p >", page + "</script></title>"])
        assert time.time() - begin < 20, piece


def test_pages_without_a_rule_stay_where_they_are(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    for k, v in zip(old, ("-1", "false"), strict=True):
        spark.conf.set(k, v)
    try:
        rows = [(i, None) for i in range(2000)] + [(i, "http://popular.test/page") for i in range(2000, 4000)] + [(i, f"http://s{i}.net/") for i in range(4000, 4500)]
        pages = spark.createDataFrame(rows, "page_id long, url string").repartition(8)
        out = url_filter.judge(pages).withColumn("at", F.spark_partition_id()).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted((r["page_id"], r["rule"]) for r in out) == [(i, None if i < 4000 else "net/") for i in range(4500)]
    for part in (range(2000), range(2000, 4000)):
        assert len({r["at"] for r in out if r["page_id"] in part}) == 8


def test_borders_as_bits():
    enc = byte_bpe.encoder()
    for text in ("a", "one two  three\n\n4", "é" * 9, "x " * 5000):
        ends = enc.borders(text)
        assert byte_bpe.unmarked(byte_bpe.marked(ends, len(text))) == ends
