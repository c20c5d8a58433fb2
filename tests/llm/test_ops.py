"""Edge cases and brute-force versions of the training-data operators, on small tables."""

import collections
import hashlib
import json
import random
import zlib

import numpy as np
import pytest
import tokenizers
from conftest import DATA, same_rows
from pyspark.sql import functions as F

from riskloom.llm import byte_bpe, chat_format, common, exact_dedup, induced_sort, language_id, packing, queries, similar_dedup, simhash_dedup, suffix_dedup, url_filter, vector_search, warc_derivatives

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def passage(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def edge_documents():
    """Nulls, empty and white texts, ties, repeated rows, copies, a very long text, and characters of several bytes."""
    base, shared = passage(1, 80), passage(2, 30)
    rows = [
        (1, base, "en", "s", 1), (2, base, "en", "s", 1), (3, base.replace(" ", "\n"), "en", None, None), (4, base + " x", "de", "s", 1),
        (5, None, None, None, None), (6, "", "en", "s", 0), (7, " \t\n", "en", "s", 3), (8, "ein", "de", "s", 3), (9, "ein", "de", "s", 3),
        (10, passage(3, 20) + " " + shared + " " + passage(4, 20), "en", "s", 1), (11, passage(5, 9) + " " + shared + passage(6, 9), "en", "s", 1),
        (12, "ä" * 90 + shared, "de", "s", 1), (13, "ö" + "ä" * 70, "de", "s", 1), (14, passage(7, 30_000), "en", "s", 1), (15, "a" * 5000, "en", "s", 1),
        (16, "\x00\x1f 12 34 !? \u3000 \x85", None, "s", 1), (17, "x  y \n\n z's", "en", "s", 1), (1, base, "en", "s", 1), (None, base, "en", "s", 1), (None, "only here " + passage(8, 15), "en", "s", 1),
    ]
    return rows


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(edge_documents(), DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def documents(spark):
    return [(r[0], r[1] or "") for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]


# --- all
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_as_sql(spark, duck, name):
    same_rows(queries.queries()[name](spark, DATA), duck.execute(queries.oracle_sql()[name]))


def test_nothing_outside_imports_it():
    import pathlib

    root = pathlib.Path(__file__).parents[2] / "riskloom"
    found = [p for p in root.rglob("*.py") if "llm" not in p.relative_to(root).parts and "riskloom.llm" in p.read_text()]
    assert not found


def test_components(spark):
    r = random.Random(0)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(100, i) for i in range(101, 180)] + [(200 + i, 201 + i) for i in range(40)] + [(7, 7), (None, 3)]
    got = {x["node"]: x["root"] for x in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in list(root)}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 1
def test_warc_edges(spark, tmp_path):
    html = '<html lang="de"><title>A &amp; B</title><script>x<p></script><p>eins<br>zwei &lt;b&gt;</p><!-- <p>no</p> --><a href="/u">l</a><a class="c" href="/u">m</a></html>'
    pages = spark.createDataFrame([(1, "http://a/", html), (2, None, None), (None, "u", ""), (1, "http://a/", html)], "page_id long, url string, html string")
    records = warc_derivatives.derivatives(warc_derivatives.responses_from_pages(pages).withColumn("block", F.lit(7)))
    rows = records.where("page_id = 1").distinct().collect()
    by = {r["warc_type"]: r for r in rows}
    assert records.count() == 8 and len(rows) == 2
    assert by["metadata"]["block"] == "title: A & B\r\nlang: de\r\noutlink: /u\r\n"
    assert by["conversion"]["block"] == "A & B\neins\nzwei <b>\nlm"
    assert by["conversion"]["refers_to"] == by["metadata"]["refers_to"] != by["conversion"]["record_id"]
    assert by["conversion"]["block_digest"] == "sha256:" + hashlib.sha256(by["conversion"]["block"].encode()).hexdigest()
    assert records.where("page_id = 2 and warc_type = 'conversion'").first()["content_length"] == 0
    assert warc_derivatives.derivatives(warc_derivatives.responses_from_pages(pages.limit(0))).count() == 0
    assert warc_derivatives.derivatives(spark.createDataFrame([("x", "p")], "payload string, other string")).columns[0] == "other"
    path = str(tmp_path / "out")
    warc_derivatives.write_warc(records, path)
    import pathlib

    found = [x for p in pathlib.Path(path).glob("part-*") for x in warc_derivatives.parsed(p.read_bytes())]
    assert len(found) == 8
    assert sorted(b.decode() for _, b in found) == sorted(r["block"] for r in records.collect())


def test_read_warc(spark, tmp_path):
    body = b"<p>\xc3\xa4\r\n\r\nWARC/1.1\r\n</p>"
    block = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n" + body
    head = b"WARC/1.0\r\nWARC-Type: %s\r\nWARC-Record-ID: <urn:x>\r\nWARC-Target-URI: http://a/\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nContent-Length: %d\r\n\r\n"
    data = b"".join(head % (t, len(block)) + block + b"\r\n\r\n" for t in (b"request", b"response"))
    import gzip

    (tmp_path / "a.warc").write_bytes(data)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(data[: len(data) // 2]) + gzip.compress(data[len(data) // 2 :]))
    rows = warc_derivatives.read_warc(spark, str(tmp_path)).collect()
    assert len(rows) == 2
    assert {(r["record_id"], r["payload"], r["http_headers"]) for r in rows} == {("<urn:x>", body.decode(), "HTTP/1.1 200 OK\r\nA: b\r\n\r\n")}


# --- 2
def test_language_id(spark, edge, none):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = language_id.fit(docs.where(~language_id.held_out()))
    got = language_id.predict(docs.withColumn("score", F.lit("clash")), model).where(language_id.held_out() & F.col("lang").isNotNull()).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.9
    assert all(0 <= r["score"] <= 1 for r in got)
    out = {r["doc_id"]: r for r in language_id.predict(edge, model).collect()}
    assert {i for i, r in out.items() if r["lang_pred"] == "und"} == {5, 6, 7, 16}
    assert not out[5]["accepted"] and out[14]["accepted"]
    assert language_id.predict(edge, model).count() == len(edge_documents())
    assert language_id.predict(none, model).count() == 0
    blank = language_id.fit(none)
    assert {r["lang_pred"] for r in language_id.predict(edge, blank).collect()} == {"und"}


def test_language_id_rejects_what_is_far(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = language_id.fit(docs.where(~language_id.held_out()))
    label, score, accepted = model.predict(["漢字漢字仮名交文", "Привет мир друзья"])
    assert not accepted.any() and (score < 0.1).all()


# --- 3
def brute_cut(docs, length):
    """docs: (key, id, bytes); removed masks by comparing windows."""
    first = {}
    for _, i, t in docs:
        for a in range(len(t) - length + 1):
            w = t[a : a + length]
            first[w] = min(first.get(w, i), i)
    out = {}
    for k, i, t in docs:
        mask = bytearray(len(t))
        for a in range(len(t) - length + 1):
            if first[t[a : a + length]] < i:
                mask[a : a + length] = b"\1" * length
        out[k] = bytes(mask)
    return out


def test_suffix_dedup_edges(spark, edge, none):
    rows = edge_documents()
    big = suffix_dedup.NO_ID
    data = [(n, big if r[0] is None else r[0], (r[1] or "").encode()) for n, r in enumerate(rows)]
    masks = brute_cut(data, 50)
    want = collections.Counter((r[0], bytes(c for c, m in zip(t, masks[n], strict=True) if not m)) for (n, _, t), r in zip(data, rows, strict=True))
    numbered = edge.withColumn("kept", F.lit("clash"))
    out = suffix_dedup.cut_out(numbered, bucket_bytes=4000, sort_bytes=500)
    got = collections.Counter((r["doc_id"], bytes(r["kept"])) for r in out.collect())
    assert got == want
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "kept", "removed_begins", "removed_ends"]
    assert suffix_dedup.dedup(edge).columns == edge.columns
    assert suffix_dedup.cut_out(none).count() == 0


@pytest.mark.parametrize("gram", [8, 13, 20])
def test_suffix_dedup_against_brute_force(spark, gram):
    r = random.Random(gram)
    texts = ["".join(r.choice("ab") for _ in range(r.randrange(120))) for _ in range(60)] + ["ab" * 60, "ab" * 45, "", "a" * 19]
    rows = [(i, t) for i, t in enumerate(texts)]
    r.shuffle(rows)
    masks = brute_cut([(i, i, t.encode()) for i, t in rows], 20)
    out = suffix_dedup.cut_out(spark.createDataFrame(rows, "doc_id long, text string"), length=20, gram=gram, bucket_bytes=700, sort_bytes=300).collect()
    for x in out:
        mask = np.frombuffer(masks[x["doc_id"]], dtype=np.uint8)
        own = np.zeros(len(mask), dtype=np.uint8)
        for a, b in zip(x["removed_begins"], x["removed_ends"], strict=True):
            own[a:b] = 1
        assert (own == mask).all()
        assert len(x["removed_begins"]) == int((np.diff(np.append(0, mask.astype(int))) == 1).sum())


def test_suffix_dedup_on_documents(spark):
    docs = documents(spark)
    masks = brute_cut([(i, i, t.encode()) for i, t in docs], 50)
    text = dict(docs)
    for r in suffix_dedup.query(spark, DATA).collect():
        m, t = masks[r["doc_id"]], text[r["doc_id"]].encode()
        assert (r["n_bytes"], r["n_removed"]) == (len(t), sum(m))
        assert r["kept_sha256"] == hashlib.sha256(bytes(c for c, x in zip(t, m, strict=True) if not x)).hexdigest()


@pytest.mark.parametrize("memory,queue", [(1, 1), (5, 3000), (1 << 20, 1 << 20)])
def test_induced_sort(memory, queue):
    rng = np.random.default_rng(memory)
    for trial in range(120):
        n, k, depth = int(rng.integers(1, 150)), int(rng.choice([1, 2, 4, 60])), int(rng.choice([3, 9, 50]))
        t = rng.integers(0, k, n)
        if trial % 3 == 0:
            t = np.tile(t[: max(1, n // 5)], 6)
        if trial % 5 == 0:
            t = np.repeat(t, 4)
        sa, lcp = induced_sort.sort_suffixes(t, depth, memory, queue)
        s = t.tolist()
        assert sorted(sa.tolist()) == list(range(len(s)))
        for i in range(1, len(s)):
            a, b = s[sa[i - 1] : sa[i - 1] + depth], s[sa[i] : sa[i] + depth]
            assert a <= b
            same = next((j for j, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert lcp[i] == same


def test_queue_goes_to_disk():
    q = induced_sort.Queue(limit=10)
    blocks = [np.arange(i, i + 2000) for i in range(3)]
    for b in blocks:
        q.push(1, b, (b % 50).astype(np.int16))
    assert q.file is not None
    out = q.pop(1)
    assert np.concatenate([a for a, _ in out]).tolist() == np.concatenate(blocks).tolist()
    assert np.concatenate([c for _, c in out]).tolist() == (np.concatenate(blocks) % 50).tolist()


# --- 4
def test_vector_search_edges(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(size=5)]) for i in range(60)]
    rows += [(60, None), (61, []), (62, [0.0] * 5), (63, [1.0, None, 1.0, 1.0, 1.0]), (64, [float("nan")] * 5), (65, [float("inf")] + [1.0] * 4), (None, [1.0] * 5)]
    rows += [(i, rows[0][1]) for i in range(70, 90)] + [(5, rows[1][1]), (100, [1.0, 2.0]), (120, [2.0, 1.0]), (140, [1e-300] * 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    got = collections.defaultdict(list)
    for r in vector_search.nearest(df, F.col("vec_id") % 20 == 0, k=7).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    ok = [(i, np.array(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)]
    want = {}
    for i, q in ok:
        if i % 20 == 0:
            near = sorted((-float(np.cumsum(q * v)[-1]), j) for j, v in ok if j != i and len(v) == len(q))[:7]
            want[i] = [(k + 1, j, -s) for k, (s, j) in enumerate(near)]
    assert {i: sorted(x) for i, x in got.items()} == {i: x for i, x in want.items() if x}
    assert vector_search.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_vector_search_bound():
    rng = np.random.default_rng(1)
    data = np.concatenate([rng.normal(size=(40, 30)) * 10.0 ** rng.integers(-3, 4, size=(40, 1)), rng.normal(size=(3, 30)) * 1e-200])
    r = vector_search.Rounded(data.copy())
    near = (r.q.astype(float) @ r.q.T.astype(float)) * r.scale[:, None] * r.scale
    slack = r.size[:, None] * r.error + r.error[:, None] * r.rounded + 1e-9 * r.size[:, None] * r.size
    assert (np.abs(near - data @ data.T) <= slack).all()


# --- 5
def test_chat_edges(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "a", "x"), (1, 2, "b", None), (1, 2, "b", None), (1, 3, None, "y"), (2, 0, "system", "only"), (None, None, "a", "z"), (3, 1000, "", "late"), (3, 0, "a", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segment", F.lit("clash"))
    got = {(r["conv_id"], r["perspective"], r["segment"]): r for r in chat_format.rotate(df).collect()}
    assert set(got) == {(1, "a", 0), (1, "b", 0), (1, "unknown", 0), (None, "a", -1), (3, "a", 0), (3, "a", 3), (3, "unknown", 0), (3, "unknown", 3)}
    r = got[1, "a", 0]
    assert r["rendered"] == "<|im_start|>system\ns<|im_end|>\n<|im_start|>assistant\nx<|im_end|>\n" + "<|im_start|>user name=b\n<|im_end|>\n" * 2 + "<|im_start|>user name=unknown\ny<|im_end|>\n"
    for (_, who, _), x in got.items():
        spans = [tuple(map(int, s.split("-"))) for s in x["mask"].split(";") if s]
        assert len(spans) == x["n_own_turns"]
        assert all(x["rendered"][:a].endswith("<|im_start|>assistant\n") and x["rendered"][a:b].endswith("<|im_end|>") for a, b in spans), who
    assert chat_format.rotate(df.limit(0)).count() == 0


# --- 6
def test_bpe_edges(spark, edge, none):
    exact = byte_bpe.encoder().exact
    want = collections.Counter((r[0], tuple(exact.encode_ordinary(r[1] or ""))) for r in edge_documents())
    for options in ({}, {"chunk": 64, "overlap": 16, "long_chars": 100}, {"chunk": 40, "overlap": 40, "long_chars": 40}):
        out = byte_bpe.encode(edge.withColumn("ids", F.lit("clash")), **options)
        assert collections.Counter((r["doc_id"], tuple(r["ids"])) for r in out.collect()) == want
    back = collections.Counter((r["doc_id"], bytes(r["decoded"])) for r in byte_bpe.decode(byte_bpe.encode(edge)).collect())
    assert back == collections.Counter((r[0], (r[1] or "").encode()) for r in edge_documents())
    assert byte_bpe.decode(byte_bpe.encode(none)).count() == 0


def test_bpe_as_tokenizers_does():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.VOCABULARY)
    t.encode_special_tokens = True
    enc = byte_bpe.encoder(packing.VOCABULARY)
    for text in [r[1] or "" for r in edge_documents()] + ["<|endoftext|> a", "it's  we'll\r\n\r\n 12³ ½ x"]:
        assert np.frombuffer(enc.encode(text), dtype="<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_stitching():
    enc, r = byte_bpe.encoder(), random.Random(0)
    for _ in range(150):
        text = "".join(r.choice("ab 1.'s\n\t\x1c\x85é\u3000 ") for _ in range(r.randrange(1, 200)))
        for chunk, overlap in ((8, 3), (16, 16), (20, 5)):
            found = [enc.borders(text[i : i + chunk + overlap]) for i in range(0, len(text), chunk)]
            assert byte_bpe.stitch(text, chunk, overlap, found, enc.borders) == enc.borders(text)


def test_bpe_on_documents(spark):
    exact = byte_bpe.encoder().exact
    got = {r["doc_id"]: r for r in byte_bpe.query(spark, DATA).collect()}
    for i, t in documents(spark):
        ids = exact.encode_ordinary(t)
        assert (got[i]["n_tokens"], got[i]["ids_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert got[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()


# --- 7
def brute_classes(rows):
    fps = [(i, simhash_dedup.fingerprint(t or "")) for i, t in rows]
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if bin(fps[a][1] ^ fps[b][1]).count("1") <= 3:
                root[find(a)] = find(b)
    least = {}
    for n, (i, _) in enumerate(fps):
        if i is not None:
            least[find(n)] = min(least.get(find(n), i), i)
    return collections.Counter((i, f, least.get(find(n))) for n, (i, f) in enumerate(fps))


def test_fingerprint():
    import xxhash

    assert simhash_dedup.fingerprint(" \n\t") == 0
    assert simhash_dedup.fingerprint("Ä B") == xxhash.xxh64_intdigest("Ä b".encode(), 42)
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in ("a b c", "b c d", "c d e")]
    want = sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > 3)
    assert simhash_dedup.fingerprint("A b\x0bC  d E") == want


def test_simhash_edges(spark, edge, none):
    got = collections.Counter((r["id"], r["fp"] & (2**64 - 1), r["component_id"]) for r in simhash_dedup.classes(edge.withColumn("fp", F.lit("clash"))).collect())
    assert got == brute_classes([(r[0], r[1]) for r in edge_documents()])
    assert simhash_dedup.classes(none).count() == 0
    assert similar_dedup.near_dedup(none).count() == 0
    assert similar_dedup.near_dedup(edge).columns == edge.columns


@pytest.mark.parametrize("block", [8192, 16])
def test_links_are_whole(spark, monkeypatch, block):
    monkeypatch.setattr(simhash_dedup, "BLOCK", block)
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**63, size=40, dtype=np.uint64)
    fps = set(centres.tolist())
    for c in centres[:12].tolist():
        for _ in range(40):
            fps.add(c ^ sum(1 << int(b) for b in rng.choice(64, size=int(rng.integers(1, 5)), replace=False)))
    fps = sorted(fps)
    signed = [(int(np.uint64(x).view(np.int64)),) for x in fps]
    edges = [(int(np.int64(r[0]).view(np.uint64)), int(np.int64(r[1]).view(np.uint64))) for r in simhash_dedup.links(spark.createDataFrame(signed, "fp long")).collect()]
    assert all(bin(a ^ b).count("1") <= 64 for a, b in edges)

    def parts(pairs):
        root = {x: x for x in fps}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        return {x: find(x) for x in fps}

    assert parts(edges) == parts([(a, b) for a in fps for b in fps if a < b and bin(a ^ b).count("1") <= 3])


def test_plan_covers_the_distance():
    rng = np.random.default_rng(5)
    for total in (10, 10_000, 10_000_000):
        chosen = simhash_dedup.plan(rng.integers(0, 2**63, size=2000, dtype=np.uint64), total)
        assert sum(t + 1 for _, t in chosen) == 4
        bits = [b for p, _ in chosen for b in p]
        assert len(bits) == len(set(bits))


def test_simhash_on_documents(spark):
    got = collections.Counter((r["doc_id"], int(r["fingerprint"], 16), r["component_id"]) for r in simhash_dedup.query(spark, DATA).collect())
    assert got == brute_classes(documents(spark))


# --- 8
def test_exact_dedup_edges(spark, edge, none):
    got = exact_dedup.groups(edge.withColumn("sha", F.lit("clash"))).collect()
    assert len(got) == len(edge_documents())
    by = collections.defaultdict(list)
    for i, t, *_ in edge_documents():
        by["".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")].append((-len(t or ""), i is None, i or 0))
    want = collections.Counter()
    for members in by.values():
        best = min(members)
        want.update((None if n else i, None if best[1] else best[2], len(members)) for _, n, i in members)
    assert collections.Counter((r["id"], r["keep_id"], r["group_size"]) for r in got) == want
    assert sum(r["row_no"] == r["keep_row"] for r in got) == len(by)
    kept = exact_dedup.exact_dedup(edge)
    assert kept.count() == len(by) and kept.columns == edge.columns
    assert exact_dedup.groups(none).count() == 0 and exact_dedup.exact_dedup(none).count() == 0


def test_exact_dedup_in_ranges_of_the_filter(spark, edge, monkeypatch):
    """The filter runs at any size: with a word at a time as with all, and it lets rows pass that are alone."""
    want = sorted(map(str, exact_dedup.groups(edge).select("id", "keep_id", "group_size").collect()))
    monkeypatch.setattr(exact_dedup, "BROADCAST_WORDS", 1)
    assert sorted(map(str, exact_dedup.groups(edge).select("id", "keep_id", "group_size").collect())) == want
    rows = exact_dedup.fingerprints(spark.range(3000).selectExpr("id as doc_id", "cast(id div 2 * int(id < 200) + id * int(id >= 200) as string) as text"))
    for most in (1 << 20, 40):
        alone, others = exact_dedup.possibly_repeated(rows, 3000, most)
        assert 200 <= others.count() < 300 and alone.count() + others.count() == 3000
        assert alone.where("id < 200").count() == 0


def test_exact_dedup_of_rows_that_repeat_an_id(spark):
    rows = [(1, "ab", 1), (1, "a  b", 2), (1, "c", 3), (None, "c", 4), (None, None, 5), (2, " ", 6), (2, "ab", 7), (3, "d", 8), (3, "d", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_no int").withColumns({"__s": F.lit(1), "sha": F.lit("x"), "word": F.lit(2)})
    got = exact_dedup.exact_dedup(docs)
    kept = [r["row_no"] for r in got.orderBy("row_no").collect()]
    assert got.columns == docs.columns and kept[:3] == [2, 3, 6] and len(kept) == 4 and kept[3] in (8, 9)


def test_exact_dedup_runs_no_python(spark):
    plan = exact_dedup.query(spark, DATA)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- 9
def held(pieces, texts, end=1):
    known = tokenizers.Tokenizer.from_file(packing.VOCABULARY)
    ids = {i: [*known.encode(t or "", add_special_tokens=False).ids, end] for i, t in texts}
    docs, windows = collections.defaultdict(list), collections.defaultdict(list)
    for r in pieces:
        docs[r["doc_id"]].append(r)
        windows[r["sequence_id"]].append(r)
    assert set(docs) == set(ids)
    for i, rows in docs.items():
        at = 0
        for r in sorted(rows, key=lambda r: r["start"]):
            own = ids[i][at : at + r["length"]]
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids[i])
            assert r["ids_crc32"] == zlib.crc32(np.array(own, dtype="<u4").tobytes())
            at += r["length"]
        assert at == len(ids[i])
    total = padding = 0
    for rows in windows.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.CAPACITY
        total += at
        padding += 0 if at & (at - 1) == 0 else packing.CAPACITY - at
    return padding / total


def test_packing(spark, none):
    assert held(packing.query(spark, DATA).collect(), documents(spark)) < 0.05
    unique = [r for r in edge_documents() if r[0] is not None and r != edge_documents()[-3]][:17]
    df = spark.createDataFrame(unique, DOCS).withColumn("length", F.lit("clash"))
    held(packing.digest(packing.pack(df)).collect(), [(r[0], r[1]) for r in unique])
    repeated = packing.pack(spark.createDataFrame(edge_documents(), DOCS)).collect()
    assert sum(r["length"] for r in repeated if r["start"] + r["length"] == r["doc_tokens"]) and sum(r["start"] + r["length"] == r["doc_tokens"] for r in repeated) == len(edge_documents())
    assert packing.pack(none).count() == 0


def test_differencing():
    r = random.Random(1)
    assert packing.differencing([], 3) == []
    for _ in range(60):
        sizes = [r.randrange(1, 513) for _ in range(r.randrange(1, 80))]
        k = r.randrange(1, 12)
        groups = packing.differencing(sizes, k)
        assert sorted(i for g in groups for i in g) == list(range(len(sizes))) and len(groups) <= k
        assert all(sum(sizes[i] for i in g) <= 2048 for g in packing.windows(sizes, 2048))
    sums = [sum(x) for x in packing.differencing([8, 7, 6, 5, 4], 2) for x in [[[8, 7, 6, 5, 4][i] for i in x]]]
    assert sorted(sums) == [14, 16]
    with pytest.raises(ValueError):
        packing.windows([3000], 2048)


# --- 10
def test_url_edges(spark):
    urls = ["http://a.example.net/en/x", "HTTP://A.EXAMPLE.NET/en/x?y#z", "http://net/", "http://net", "http://xnet/", "http://a.org/fr/", "http://example.com/de", "http://example.com/de/", None, "", "no scheme", "x://y://net/", "http://b.net?/x", "http://ÄÖ.net/é"]
    rows = [(i, u) for i, u in enumerate(urls)] + [(None, "http://net/"), (0, urls[0]), (0, urls[0])]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("verdict", F.lit("clash"))
    got = collections.defaultdict(list)
    out = url_filter.judge(df).collect()
    for r in out:
        got[r["page_id"]].append((r["host"], r["path"], r["rule"], r["verdict"]))
    assert len(out) == len(rows) and len(got[0]) == 3 and len(set(got[0])) == 1
    want = [
        ("a.example.net", "/en/x", "example.net/en/", "allow"), ("a.example.net", "/en/x", "example.net/en/", "allow"), ("net", "/", "net/", "block"), ("net", "", None, "allow"),
        ("xnet", "/", None, "allow"), ("a.org", "/fr/", "org/fr/", "allow"), ("example.com", "/de", None, "allow"), ("example.com", "/de/", "example.com/de/", "block"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("y:", "//net/", None, "allow"), ("b.net", "", None, "allow"), ("ÄÖ.net", "/é", "net/", "block"),
    ]
    assert [got[i][0] for i in range(len(urls))] == want
    assert got[None] == [("net", "/", "net/", "block")]
    assert url_filter.judge(df.limit(0)).count() == 0
    assert {r["rule"] for r in url_filter.judge(df, []).collect()} == {None}
    rules = spark.createDataFrame([("net", "/", "block"), ("net", "/", "allow"), (None, "/", "block")], "host string, path string, verdict string")
    assert url_filter.judge(df, rules).where("page_id = 2").first()["verdict"] == "block"
