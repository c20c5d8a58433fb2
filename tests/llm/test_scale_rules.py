"""Rules that hold at every size: external sorting, hot keys, long inputs, entities."""

import html
import itertools
import random
import time
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_ops import brute_cut

from riskloom.llm import byte_bpe, induced_sort, suffix_dedup, url_filter, warc_derivatives


def test_sort_far_above_its_memory_bound(monkeypatch):
    """A text of some 20 times the bounds: queue, names and arrays go to scratch files, and two levels of recursion run."""
    monkeypatch.setattr(induced_sort, "FLAT", 1 << 15)
    depths, plain = [], induced_sort.induced_order
    monkeypatch.setattr(induced_sort, "induced_order", lambda names, depth, memory: depths.append(len(names)) or plain(names, depth, memory))
    rng = np.random.default_rng(0)
    passages = [rng.integers(1, 30, 300) for _ in range(400)]
    text = np.concatenate([passages[i] for i in rng.integers(0, 400, 2200)]).astype(np.uint16)
    s = induced_sort.room(len(text) + 1, np.uint16)
    s[:-1], s[-1] = text, 0
    tracemalloc.start()
    at, last, seen = 0, None, np.zeros(len(text), dtype=bool)
    for pos, lcp in induced_sort.sorted_blocks(s, 50, 1 << 15, 1 << 15):
        pairs = np.concatenate([[] if last is None else [last], pos]).astype(np.int64)
        same, step = np.ones(len(pairs) - 1, dtype=bool), 0
        want = np.zeros(len(pairs) - 1, dtype=np.int64)
        greater = np.zeros(len(pairs) - 1, dtype=bool)
        for step in range(50):
            a, b = (s[np.minimum(x + step, len(text))] for x in (pairs[:-1], pairs[1:]))
            greater |= same & (a < b)
            assert not (same & (a > b)).any()
            same &= (a == b) & (a > 0)
            want += same
        assert (lcp[-len(want) :] == want).all()
        seen[pos] = True
        at, last = at + len(pos), pos[-1]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert at == len(text) and seen.all() and len(depths) >= 2
    assert peak < 24 << 20  # some 40 bytes a symbol would be 26 MB, and the text has 660,000


def test_random_text_sorts_in_time():
    t = np.random.default_rng(1).integers(0, 4, 1 << 20)
    began = time.time()
    pos, _ = induced_sort.sort_suffixes(t, 50, 1 << 15, 1 << 15)
    assert len(pos) == len(t) and time.time() - began < 30


def test_keys_of_windows_depend_on_their_bytes_alone(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HASH_BYTES", 100)
    data = np.frombuffer(bytes(random.Random(5).choices(b"ab", k=60)) * 9, dtype=np.uint8)
    begin = np.array([0, 3, 49, 50, 51, 60, 99, 100, 101, 160, 219, 400, 490])
    keys = suffix_dedup.window_keys(data, begin, 50)
    of = {}
    for b, k in zip(begin.tolist(), keys.tolist(), strict=True):
        assert of.setdefault(data[b : b + 50].tobytes(), k) == k < 1 << 48
    assert len(set(keys.tolist())) == len(of) == len({b % 60 for b in begin.tolist()})
    assert not len(suffix_dedup.window_keys(data, begin[:0], 50))


@pytest.mark.parametrize(("hot", "strings"), [(4096, 1 << 15), (5, 1 << 15), (5, 3), (4096, 3)])
def test_hot_minimizers_go_by_windows(spark, monkeypatch, hot, strings):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "STRINGS", strings)
    r = random.Random(2)
    line, rows = "the same licence line of some sixty characters, in most texts", []
    for i in range(80):
        own = " ".join(f"{r.randrange(10**6)}" for _ in range(12))
        rows.append((i // 2 if i % 9 else None, own[: r.randrange(90)] + (line if i % 3 else line[:40]) + own[r.randrange(20) :] + "é" * (i % 5) + "ab" * (i % 7) * 20))
    rows += [(200, None), (201, ""), (7, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"row": F.lit(1), "bucket": F.lit("x"), "c0": F.lit(None).cast("int")})
    big = suffix_dedup.NO_ID
    masks = brute_cut([(n, big if i is None else i, (t or "").encode()) for n, (i, t) in enumerate(rows)], 50)
    want = sorted((i is None, i or 0, bytes(c for c, m in zip((t or "").encode(), masks[n], strict=True) if not m)) for n, (i, t) in enumerate(rows))
    got = suffix_dedup.cut_out(docs, bucket_bytes=1500, sort_bytes=4000)
    assert sorted((x["doc_id"] is None, x["doc_id"] or 0, bytes(x["kept"])) for x in got.collect()) == want
    kept = suffix_dedup.dedup(docs)
    assert kept.columns == docs.columns and sorted((x["doc_id"] is None, x["doc_id"] or 0, x["text"]) for x in kept.collect()) == [(a, b, t.decode("utf-8", "ignore")) for a, b, t in want]


def test_packed_columns_come_back():
    columns = [np.arange(5, dtype=np.uint64), np.zeros(0, dtype=np.uint32), np.array([3, 250], dtype=np.uint8)]
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(suffix_dedup.unpack(suffix_dedup.pack(*columns)), columns, strict=True))


def test_url_filter_on_long_hosts_and_popular_sites(spark):
    long = ".".join("a" * (i % 3) for i in range(20_000))
    rows = [(0, f"http://{long}.net/x"), (1, f"http://{long}.example.net/en/" + "p" * 100_000)] + [(i, "http://hot.org/fr/a") for i in range(2, 3000)] + [(3000, None), (3001, None)]
    out = {x["page_id"]: (x["rule"], x["verdict"]) for x in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string").withColumns({"site": F.lit(1), "best": F.lit(2)})).collect()}
    assert out[0] == ("net/", "block") and out[1] == ("example.net/en/", "allow") and out[2] == out[2999] == ("org/fr/", "allow") and out[3001] == (None, "allow") and len(out) == 3002


def test_stitching_without_borders_reads_in_proportion():
    read = []
    enc = byte_bpe.encoder()

    def borders(text):
        read.append(len(text))
        return enc.borders(text)

    for text in ("a" * 40_000, "a" * 20_000 + " b c" * 2000 + "9" * 9000):
        found = [enc.borders(text[i : i + 100 + 20]) for i in range(0, len(text), 100)]
        read.clear()
        assert byte_bpe.stitch(text, 100, 20, found, borders) == enc.borders(text)
        assert sum(read) < 5 * len(text)


def test_all_texts_over_a_chunk_are_cut(spark):
    texts = ["word " * 5000, "x" * 30_000, " \n" * 9000, "é1 " * 8192, "a" * 16_384, "b" * 16_385]
    got = {r["doc_id"]: r["ids"] for r in byte_bpe.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert all(got[i] == byte_bpe.encoder().exact.encode_ordinary(t) for i, t in enumerate(texts))


def test_character_references(spark):
    texts = ["&amp;lt; &lt;b&gt; &eacute;&#233;&#xE9;&#XE9; &nosuch; &copy;&middot; & && a&b;c &NotEqualTilde; &#160;|&nbsp;|", "plain", "", "&", "&#;", "&#x;", "&#0;&#xD800;&#x110000;"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(warc_derivatives.unescaped(F.col("t"))).collect()]
    assert got[:3] == [html.unescape(t).replace("\xa0", " ") for t in texts[:3]]
    assert got[3:] == ["&", "&#;", "&#x;", "�" * 3]
    page = "<a href='x&amp;y'>1</a><a class=q href=z>2</a><A HREF=\"/u\">3</A><a data-href=\"no\" href = \"yes\">" + "<p>long &amp; text</p>" * 20_000
    record = spark.createDataFrame([(page,)], "h string").select(warc_derivatives.page_metadata(F.col("h")), warc_derivatives.plain_text(F.col("h"))).first()
    assert record[0] == "title: \r\nlang: \r\noutlink: x&y\r\noutlink: z\r\noutlink: /u\r\noutlink: yes\r\n"
    assert record[1].count("long & text") == 20_000
    assert list(itertools.islice(record[1].splitlines(), 2)) == ["123", "long & text"]


def test_induction_sorts_again_only_what_is_tied(monkeypatch):
    """A range of names with a long chain of inducers isn't sorted as a whole for each link of the chain."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.integers(0, 4000, 20_000), np.arange(4000, 4040), np.arange(4080, 4040, -1)])
    names = np.searchsorted(np.sort(x), x)
    plain, done = np.argsort, []
    monkeypatch.setattr(np, "argsort", lambda a, *args, **more: done.append(len(a)) or plain(a, *args, **more))
    order = induced_sort.induced_order(names, 26, 1 << 14)
    keys = [tuple(names[i : i + 26].tolist()) for i in order]
    assert all(a <= b for a, b in zip(keys, keys[1:], strict=False))
    assert sum(done) < 15 * len(x)
