"""WARC derivatives: metadata and plain-text conversion records made from response records.

Each response gives two records that name it in WARC-Refers-To and keep its target URI, date, HTTP headers and
payload digest: a ``metadata`` record with the page's title, language and links, and a ``conversion`` record with its plain text.
Record ids are derived from the source's id, so a repeated run or task writes the same records.

Defined cases: a null payload is empty and gives an empty conversion; null ids get the id derived from the URI and payload;
null URIs, dates and headers are left out of the written header; repeated rows are converted each; an empty table
gives no rows; other columns are kept on both records unless they have a record column's name.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Callable, Iterator
from html.entities import html5

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import read

RECORD = ["warc_type", "record_id", "refers_to", "target_uri", "warc_date", "content_type", "source_headers", "source_digest", "block", "block_digest", "content_length"]
BREAKS = r"(?i)</?(p|div|br|li|ul|ol|tr|td|th|table|h1|h2|h3|h4|h5|h6|article|section|nav|header|footer|title|blockquote|pre)(\s[^>]*)?/?>"
#: Character references, which end with a semicolon: the named ones are those of HTML 5; no-break space becomes a space.
NAMED = {f"&{k}": v.replace("\xa0", " ") for k, v in html5.items() if k.endswith(";")}
TOKENS = r"&#[0-9]{1,7};|&#[xX][0-9a-fA-F]{1,6};|&[A-Za-z][A-Za-z0-9]{0,31};|[^&]+|&"
HREF = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
#: A link or the rest of a tag without one; the language of a page's tag or the rest of the tag.
LINK = r"""(?i)<a\s(?:(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|[^>]*)"""
PAGE_LANG = r"""(?i)<html(?:[^>]*(\slang="[^"]*")|[^>]*)"""


def uuid_of(key: Column) -> Column:
    """A urn:uuid made of a key's MD5."""
    h = F.md5(key)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def unescaped(text: Column) -> Column:
    """The text with character references decoded, in one pass from left to right; what isn't one stays as it is.

    References to surrogates, to 0 and beyond Unicode give U+FFFD.
    """
    named = F.str_to_map(F.lit("\x01".join(f"{k}\x02{v}" for k, v in NAMED.items())), F.lit("\x01"), F.lit("\x02"))

    def decoded(t: Column) -> Column:
        code = F.when(F.substring(t, 3, 1).isin("x", "X"), F.conv(F.substring(t, F.lit(4), F.length(t) - 4), 16, 10)).otherwise(F.substring(t, F.lit(3), F.length(t) - 3)).cast("int")
        valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")
        number = F.when(F.startswith(t, F.lit("&#")) & F.endswith(t, F.lit(";")), F.when(char == "\xa0", " ").otherwise(char))
        return F.when(~F.startswith(t, F.lit("&")), t).otherwise(F.coalesce(number, F.element_at(named, t), t))

    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(F.regexp_extract_all(text, F.lit(TOKENS), F.lit(0)), decoded), "")).otherwise(text)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_closed(text: Column, change: Callable[[Column], Column]) -> Column:
    """``change`` of the text up to its last ``>``; behind it no tag ends, and each ``<`` there would be read to the end for nothing."""

    def split(t: Column) -> Column:
        after = F.substring_index(t, ">", -1)
        return F.when(F.contains(after, F.lit("<")), F.concat(change(F.substring(t, F.lit(1), F.length(t) - F.length(after))), after)).otherwise(change(t))

    return let(text, split)


#: What an element without text begins with, the end of that opening, and the element's end.
ELEMENTS = [("<!--", "", "-->")] + [(f"<{tag}", r"(?:\s[^>]*)?>", rf"</{tag}\s*>") for tag in ("script", "style", "noscript")]
#: Openings on a page that are looked for without care: each may be read to the page's end.
CARELESS = 64


def without_elements(text: Column) -> Column:
    """The text with a space for each comment, script, style and noscript element.

    Behind the first opening without an end no other has one: on pages with many openings that rest is set aside first.
    """

    def plain(t: Column) -> Column:
        for begin, opened, end in ELEMENTS:
            t = F.regexp_replace(t, f"(?is){begin}{opened}.*?{end}", " ")
        return t

    def cut(whole: str, left_open: str) -> Callable[[Column], Column]:
        found = F.lit(f"{whole}|({left_open})")
        left = lambda t: F.length(F.coalesce(F.try_element_at(F.regexp_extract_all(t, found, F.lit(1)), F.lit(-1)), F.lit("")))
        return lambda t: let(F.length(t) - left(t), lambda n: F.concat(F.regexp_replace(F.substring(t, F.lit(1), n), whole, " "), F.substring(t, n + 1, F.length(t))))

    def careful(t: Column) -> Column:
        for begin, opened, end in ELEMENTS:
            t = let(t, cut(f"(?is){begin}{opened}.*?{end}", rf"{begin}{opened}.*\z|{begin}(?:\s[^>]*)?\z"))
        return t

    begins = "(?i)<(?:" + "|".join(begin[1:] for begin, _, _ in ELEMENTS) + ")"
    return let(text, lambda t: F.when(F.regexp_count(t, F.lit(begins)) <= CARELESS, plain(t)).otherwise(careful(t)))


def plain_text(html: Column) -> Column:
    """The text of a page, in time proportional to its length whatever is left open in it."""
    t = with_closed(without_elements(html), lambda h: F.regexp_replace(h, BREAKS, "\n"))
    t = with_closed(t, lambda h: F.regexp_replace(h, r"<[^>]*>", ""))
    t = F.regexp_replace(let(t, unescaped), r"[ \t\r\f]+", " ")
    return F.trim(F.regexp_replace(t, r" ?\n[ \n]*", "\n"), F.lit("\n "))


def tidy(text: Column) -> Column:
    bare = with_closed(text, lambda h: F.regexp_replace(h, r"<[^>]*>", ""))
    return F.trim(F.regexp_replace(let(bare, unescaped), r"\s+", " "), F.lit(" "))


def page_metadata(html: Column) -> Column:
    """The fields of the metadata record, a line each (application/warc-fields).

    What is opened and doesn't become a title, a language or a link takes the rest of its tag (a title: of the page) with it, for
    no later start within would fare better.
    """
    found = F.filter(F.regexp_extract_all(html, F.lit(LINK), F.lit(1)), lambda x: x != "")
    links = F.array_distinct(F.transform(found, lambda x: unescaped(F.regexp_replace(x, "^[\"']|[\"']$", ""))))
    # The first tag mostly has the language; only where it hasn't, the others are looked at.
    named = F.get(F.filter(F.regexp_extract_all(html, F.lit(PAGE_LANG), F.lit(1)), lambda x: x != ""), F.lit(0))
    language = let(F.regexp_extract(html, PAGE_LANG, 1), lambda x: F.when(x != "", x).otherwise(named))
    lines = [
        F.concat(F.lit("title: "), tidy(F.regexp_extract(html, r"(?is)<title(?:[^>]*>(.*?)</title>|.*)", 1)), F.lit("\r\n")),
        F.concat(F.lit("lang: "), F.coalesce(F.regexp_extract(language, r'"([^"]*)"', 1), F.lit("")), F.lit("\r\n")),
        F.array_join(F.transform(links, lambda x: F.concat(F.lit("outlink: "), x, F.lit("\r\n"))), ""),
    ]
    return F.concat(*lines)


def responses_from_pages(pages: DataFrame, warc_date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Response records of crawled pages: ``record_id, target_uri, warc_date, http_headers, payload`` and the page's id."""
    html = F.coalesce("html", F.lit(""))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"))
    key = F.concat_ws("\n", F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce("url", F.lit("")), F.md5(html))
    return pages.select("page_id", uuid_of(key).alias("record_id"), F.col("url").alias("target_uri"), F.lit(warc_date).alias("warc_date"), head.alias("http_headers"), html.alias("payload"), digest(html).alias("payload_digest"))


def derivatives(responses: DataFrame) -> DataFrame:
    """Two rows of RECORD columns for each response; other columns of ``responses`` come along."""
    own = {"record_id", "target_uri", "warc_date", "http_headers", "payload", "payload_digest"}
    others = [c for c in responses.columns if c.lower() not in own | set(RECORD)]
    payload = F.coalesce("payload", F.lit(""))
    has = {c.lower() for c in responses.columns}
    optional = lambda c: F.col(c) if c in has else F.lit(None).cast("string")
    key = F.coalesce(optional("record_id"), uuid_of(F.concat_ws("\n", optional("target_uri"), F.md5(payload))))
    base = responses.select(
        *others, key.alias("refers_to"), optional("target_uri").alias("target_uri"), optional("warc_date").alias("warc_date"),
        optional("http_headers").alias("source_headers"), F.coalesce(optional("payload_digest"), digest(payload)).alias("source_digest"), payload.alias("__payload"),
    )
    made = F.array(
        F.struct(F.lit("metadata").alias("warc_type"), F.lit("application/warc-fields").alias("content_type"), page_metadata(F.col("__payload")).alias("block")),
        F.struct(F.lit("conversion").alias("warc_type"), F.lit("text/plain; charset=utf-8").alias("content_type"), plain_text(F.col("__payload")).alias("block")),
    )
    each = base.withColumn("__r", F.explode(made)).select(*others, "refers_to", "target_uri", "warc_date", "source_headers", "source_digest", "__r.*")
    return each.select(
        *others, "warc_type", uuid_of(F.concat_ws("\n", "warc_type", "refers_to")).alias("record_id"), "refers_to", "target_uri", "warc_date", "content_type",
        "source_headers", "source_digest", "block", digest(F.col("block")).alias("block_digest"), F.octet_length("block").cast("long").alias("content_length"),
    )


def write_warc(records: DataFrame, path: str) -> None:
    """Write RECORD rows as WARC/1.1 files; a record's end, two line breaks, is the text writer's separator."""
    line = lambda name, c: F.when(c.isNotNull(), F.concat(F.lit(f"{name}: "), c, F.lit("\r\n"))).otherwise(F.lit(""))
    folded = F.regexp_replace(F.trim(F.regexp_replace("source_headers", r"(\r?\n)+", "\t")), r"\t$", "")
    head = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("warc_type")), line("WARC-Record-ID", F.col("record_id")), line("WARC-Refers-To", F.col("refers_to")),
        line("WARC-Target-URI", F.col("target_uri")), line("WARC-Date", F.col("warc_date")), line("Content-Type", F.col("content_type")),
        line("X-Source-Headers", folded), line("X-Source-Payload-Digest", F.col("source_digest")), line("WARC-Block-Digest", F.col("block_digest")),
        F.concat(F.lit("Content-Length: "), F.col("content_length").cast("string"), F.lit("\r\n")),
    )
    records.select(F.concat(head, F.lit("\r\n"), F.col("block")).alias("value")).write.option("lineSep", "\r\n\r\n").text(path)


def parsed(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a WARC file, plain or gzipped."""
    f = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data))
    while line := f.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        head: dict[str, str] = {}
        while (line := f.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            head[name.strip().lower()] = value.strip()
        yield head, f.read(int(head["content-length"]))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Response records of WARC files (a task reads one file of up to 2 GB at a time)."""
    fields = ["record_id", "target_uri", "warc_date", "http_headers", "payload", "payload_digest"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            for data in df["content"]:
                for h, block in parsed(data):
                    if h.get("warc-type") == "response":
                        head, _, body = block.partition(b"\r\n\r\n")
                        row = [h.get("warc-record-id"), h.get("warc-target-uri"), h.get("warc-date"), (head + b"\r\n\r\n").decode("utf-8", "replace"), body.decode("utf-8", "replace"), h.get("warc-payload-digest")]
                        yield pd.DataFrame([row], columns=fields)

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, ", ".join(f"{c} string" for c in fields))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return derivatives(responses_from_pages(pages)).select("page_id", *[c for c in RECORD if c != "warc_date"])


def _sql() -> str:
    uuid = lambda k: f"'<urn:uuid:' || substr(md5({k}), 1, 8) || '-' || substr(md5({k}), 9, 4) || '-' || substr(md5({k}), 13, 4) || '-' || substr(md5({k}), 17, 4) || '-' || substr(md5({k}), 21, 12) || '>'"

    quoted = lambda x: "'" + x.replace("'", "''") + "'"

    def entities(t: str) -> str:
        code = "cast(case when t[3] in ('x', 'X') then '0x' || substr(t, 4, length(t) - 4) else substr(t, 3, length(t) - 3) end as integer)"
        char = f"case when {code} > 0 and {code} < 1114112 and {code} not between 55296 and 57343 then replace(chr({code}), chr(160), ' ') else chr(65533) end"
        one = f"case when not starts_with(t, '&') then t when starts_with(t, '&#') and ends_with(t, ';') then {char} else coalesce(named[t], t) end"
        return f"coalesce(array_to_string(list_transform(regexp_extract_all({t}, '{TOKENS}'), lambda t: {one}), ''), '')"

    text = r"regexp_replace(h, '(?s)<!--.*?-->', ' ', 'g')"
    for tag in ("script", "style", "noscript"):
        text = rf"regexp_replace({text}, '(?is)<{tag}(\s[^>]*)?>.*?</{tag}\s*>', ' ', 'g')"
    text = rf"regexp_replace(regexp_replace({text}, '{BREAKS}', chr(10), 'g'), '<[^>]*>', '', 'g')"
    text = rf"regexp_replace(regexp_replace({entities(text)}, '[ \t\r\f]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g')"
    title = rf"trim(regexp_replace({entities(r"regexp_replace(regexp_extract(h, '(?is)<title[^>]*>(.*?)</title>', 1), '<[^>]*>', '', 'g')")}, '\s+', ' ', 'g'), ' ')"
    names = f"map([{', '.join(map(quoted, NAMED))}], [{', '.join(map(quoted, NAMED.values()))}])"
    href = HREF.replace("'", "''")
    return rf"""
with names as (select {names} as named),
r as (
  select page_id, url as target_uri, coalesce(html, '') as h,
         'response' || chr(10) || coalesce(cast(page_id as varchar), '') || chr(10) || coalesce(url, '') || chr(10) || md5(coalesce(html, '')) as k
  from pages
),
s as (
  select *, {uuid("k")} as refers_to, 'sha256:' || sha256(h) as source_digest,
         'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) || 'Content-Length: ' || strlen(h) || chr(13) || chr(10) || chr(13) || chr(10) as source_headers
  from r cross join names
),
l as (
  select *, list_transform(regexp_extract_all(h, '{href}', 1), lambda x: {entities("regexp_replace(x, '^[\"'']|[\"'']$', '', 'g')")}) as a from s
),
m as (
  select page_id, 'metadata' as warc_type, refers_to, target_uri, 'application/warc-fields' as content_type, source_headers, source_digest,
         'title: ' || {title} || chr(13) || chr(10) || 'lang: ' || regexp_extract(h, '(?i)<html[^>]*\slang="([^"]*)"', 1) || chr(13) || chr(10)
         || coalesce(array_to_string(list_transform(list_filter(a, lambda x, i: list_position(a, x) = i), lambda x: 'outlink: ' || x || chr(13) || chr(10)), ''), '') as block
  from l
  union all
  select page_id, 'conversion', refers_to, target_uri, 'text/plain; charset=utf-8', source_headers, source_digest, trim({text}, chr(10) || ' ') from s
)
select page_id, warc_type, {uuid("warc_type || chr(10) || refers_to")} as record_id, refers_to, target_uri, content_type, source_headers, source_digest,
       block, 'sha256:' || sha256(block) as block_digest, strlen(block) as content_length
from m
"""


QUERIES = {"op1_warc_derivatives": query}
ORACLE = {"op1_warc_derivatives": _sql()}
