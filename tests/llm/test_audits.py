"""Secret scans, vector codes and the filter audit against brute-force versions, with their edge cases."""

import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest
from conftest import DATA
from test_ops import DOCS, edge_documents, passage

from riskloom.llm import filter_audit, secret_scan, vector_codes

WHITE = re.compile(r"[^\x20\x09-\x0D]+")


# --- 11
def scanned(text):
    """All spans of a text, found and linked by comparing every two parts."""
    text = text or ""
    spans = []
    for m in re.finditer(r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 6:
            spans.append((m.start(), 0, m.end()))
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    weak = []
    for i, p in enumerate(secret_scan.WEAK.values(), 3):
        for m in re.finditer(p, text):
            if i == 5 and not (re.search("[0-9]", m[0]) and re.search("[A-Z]", m[0]) and re.search("[a-z]", m[0])):
                continue
            if not any(a < m.end() and m.start() < z for a, _, z in spans):
                weak.append((m.start(), i, m.end()))
    breaks = [m.start() for m in re.finditer(secret_scan.BREAK, text)]
    scope = lambda at: sum(b < at for b in breaks)
    part = lambda k: "identifier" if k in (1, 3) else "endpoint" if k == 6 else "secret"
    both = spans + weak
    for s in weak:
        near = {part(o[1]) for o in both if scope(o[0]) == scope(s[0]) and abs(o[0] - s[0]) <= secret_scan.REACH}
        if {"identifier": {"secret"}, "secret": {"identifier"}, "endpoint": {"identifier", "secret"}}[part(s[1])] <= near:
            spans.append(s)
    return [(secret_scan.KINDS[k], a, z) for a, k, z in sorted(spans)]


def planted():
    key = "AKIA" + "Q7" * 8
    mixed = "aB3" * 12
    return [
        "password = hunter2x and Token:'abc123' and api_key=\"12345\" secret:sixsix", "token: token: abcdefgh", f"{key} ä {key[:19]} AKIA{'Z' * 40}", "f" * 23 + " " + "0a" * 12 + "ü" + "1" * 24,
        "user: bob pwd: hunter22", "user: bob\n\npwd: hunter22", "user: bob\n \t\npwd: hunter22", "login=ann " + "x " * 190 + "pwd = abcd", "login=ann " + "x " * 205 + "pwd = abcd",
        f"see https://db.example.org/x and account: carl and {mixed}", "see https://db.example.org/x and account: carl", f"only {mixed} here", f"{mixed} {key}", f"client_id={mixed}", f"secret={mixed} user=eve",
        "paſſword = hunter2x Kelvin toKen=abcdef12", "pass" * 50 + ":" + " " * 300 + "x", "user=abc " * 400 + "pwd=abcd " * 400, "a" * 20000 + "://x", None, "", "\U0001f511 password=geheim1 \U0001f511 user=\"bob\"",
    ]


def test_secrets(spark):
    texts = planted() + [r[1] for r in edge_documents()] + [r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    r = random.Random(3)
    bits = ["password=", "abcdef12", " ", "\n\n", "user: bob", " pwd=abcd ", "AKIA" + "A" * 16, "f" * 25, "http://h.x/y ", "w " * 150, "token: ", "'x'", "aB3" * 12, "é"]
    texts += ["".join(r.choice(bits) for _ in range(r.randrange(40))) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as found", "2 as row_no", "'k' as kind", "4 as `a.b`", "5 as id")
    got = {x["id"]: [tuple(s) for s in x["spans"]] for x in secret_scan.secrets(rows).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i] == scanned(t), t and t[:200]
    kinds = {k for s in got.values() for k, _, _ in s}
    assert kinds == set(secret_scan.KINDS)


def test_secrets_rows(spark):
    rows = spark.createDataFrame([(1, "token=abcdef"), (1, "token=abcdef"), (None, "token=abcdef"), (None, None)], "doc_id long, text string")
    assert sorted((str(x["id"]), len(x["spans"])) for x in secret_scan.secrets(rows).collect()) == [("1", 1), ("1", 1), ("None", 0), ("None", 1)]
    assert secret_scan.secrets(rows.limit(0)).count() == 0


# --- 12
def lloyd(rows, parts=8, entries=16, rounds=6):
    """Plain rounds over ``(id, vector)``, every distance computed."""
    q = np.array([[math.floor(4096 * x) for x in v] for _, v in rows], dtype=object)
    width = q.shape[1] // parts
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, list(rows[i][1])))
    books = [[list(q[i, k * width : (k + 1) * width]) for i in order[:entries]] for k in range(parts)]
    near = lambda x, book: min(range(len(book)), key=lambda j: (sum((a - b) ** 2 for a, b in zip(x, book[j], strict=True)), j))
    for _ in range(rounds):
        for k in range(parts):
            xs = [list(r[k * width : (k + 1) * width]) for r in q]
            to = [near(x, books[k]) for x in xs]
            books[k] = [[sum(c) // to.count(j) for c in zip(*[x for x, t in zip(xs, to, strict=True) if t == j], strict=True)] if j in to else old for j, old in enumerate(books[k])]
    out = []
    for r in q:
        to = [near(list(r[k * width : (k + 1) * width]), books[k]) for k in range(parts)]
        out.append((to, sum((a - b) ** 2 for k in range(parts) for a, b in zip(r[k * width : (k + 1) * width], books[k][to[k]], strict=True))))
    return out, books


@pytest.mark.parametrize("spread", [0.001, 0.02, 0.3])
def test_vector_codes(spark, monkeypatch, spread):
    monkeypatch.setattr(vector_codes, "BLOCK", 64)
    r = np.random.default_rng(int(spread * 1000))
    centres = r.normal(size=(6, 16))
    rows = [(i, [float(x) for x in centres[i % 6] + spread * r.normal(size=16)]) for i in range(150)]
    rows += [(7, rows[3][1]), (7, rows[3][1]), (None, rows[5][1]), (None, [0.0] * 16)]
    bad = [(900, None), (901, []), (902, [1.0, None] * 8), (903, [float("nan")] * 16), (904, [float("inf")] + [0.0] * 15), (905, [1.0] * 8)]
    df = spark.createDataFrame([(i, v, j % 3 or None) for j, (i, v) in enumerate(rows + bad)], "vec_id long, embedding array<double>, label int").selectExpr("*", "1 as id", "2 as points", "3 as `a.b`")
    coded, books = vector_codes.compress(df.repartition(3))
    want, want_books = lloyd(rows)
    assert books.tolist() == want_books
    assert sorted((str(x["id"]), list(x["entries"]), x["error"]) for x in coded.collect()) == sorted((str(i), to, e) for (i, _), (to, e) in zip(rows, want, strict=True))
    assert coded.count() == len(rows)


def test_vector_codes_small(spark):
    df = spark.createDataFrame([(3, [0.5] * 8, 1), (2, [-0.5] * 8, None), (3, [0.5] * 8, 1)], "vec_id long, embedding array<float>, label int")
    coded, books = vector_codes.compress(df)
    assert books.shape == (8, 3, 1) and coded.count() == 3 and coded.agg({"error": "sum"}).first()[0] == 0
    assert vector_codes.compress(df.limit(0))[0].count() == 0
    assert vector_codes.compress(df.selectExpr("vec_id", "slice(embedding, 1, 7) as embedding", "label"))[0].count() == 0
    with pytest.raises(Exception, match="64 bits"):
        vector_codes.compress(df.selectExpr("vec_id", "transform(embedding, x -> cast(1e6 as float)) as embedding", "label"))[0].count()


def test_cover_trees_spare_distances():
    """Whole subtrees are assigned: a tree of tight groups needs few distances, and the sums are those of all points."""
    r = np.random.default_rng(1)
    x = (r.integers(-20000, 20000, size=(12, 8))[r.integers(0, 12, 4000)] + r.integers(-30, 30, size=(4000, 8))).astype(np.int64)
    book = x[:16].copy()
    tree = vector_codes.Tree.unpack(vector_codes.grow(x).pack())
    assert sorted(tree.order.tolist()) == list(range(4000))
    for lo, hi, far in zip(tree.low, tree.high, tree.radius, strict=True):
        assert np.sqrt(vector_codes.squares(x[tree.order[lo:hi]], x[tree.order[lo]]).max()) <= far
    exact = vector_codes.squares(x[:, None, :], book).argmin(axis=1)
    assert (vector_codes.codes(tree, x, book) == exact).all()
    total = vector_codes.sums(tree, x, book)
    assert all((total[j] == [(exact == j).sum(), *x[exact == j].sum(axis=0)]).all() for j in range(16))
    apart = np.array([x[0], x[0] + 40000, x[0] - 40000])
    assert vector_codes.assign(tree, x, apart)[2] < 0.05 * 4000 * 3
    same = vector_codes.grow(np.zeros((500, 8), dtype=np.int64))
    assert len(same.low) == 1 and vector_codes.sums(same, np.zeros((500, 8), dtype=np.int64), np.zeros((2, 8), dtype=np.int64))[:, 0].tolist() == [500, 0]


# --- 13
def audited(docs, labels):
    """The whole table from each document's walk along each order."""
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    marks = {k: {i for i, q, x in labels if i is not None and (q, x)[n] == 1} for n, k in enumerate(("good", "toxic"))}
    rows = {}
    for part in {p or "" for _, _, p in docs}:
        for o in itertools.permutations("ABCDE"):
            for s in range(5):
                rows[part, "".join(o), s + 1] = [0] * 7
    for i, t, p in docs:
        t = t or ""
        words = WHITE.findall(t)
        fails = {k for k, c in {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and first[t] < i}.items() if c}
        for o in itertools.permutations("ABCDE"):
            gone = False
            for s, f in enumerate(o):
                row = rows[p or "", "".join(o), s + 1]
                here = f in fails and not gone
                row[2] += f in fails and gone
                row[3] += fails == {f}
                row[1] += here
                row[4] += here and i in marks["good"]
                row[5] += here and i in marks["toxic"]
                gone = gone or here
                row[0] += not gone
    for (p, o, s), row in rows.items():
        row[6] = sum(r[1] for (q, w, n), r in rows.items() if q == p and w[n - 1] == o[s - 1]) if s == 1 else 0
    for (p, o, s), row in rows.items():
        row[6] = next(rows[p, w, 1][6] for w in ("".join(x) for x in itertools.permutations("ABCDE")) if w[0] == o[s - 1])
    return rows


def test_filter_audit(spark):
    long = passage(11, 130)
    varied = " ".join(f"w{i}" for i in range(120))
    docs = [(r[0], r[1], r[2]) for r in edge_documents()]
    docs += [(30, varied, "en"), (31, varied, "en"), (29, varied, None), (29, varied, "en"), (None, varied, "en"), (32, varied + " #", "en"), (33, "ABC " * 120, "de"), (34, varied.upper(), "xx"), (35, long + "|", ""), (36, long, "en"), (37, long, "de")]
    labels = [(30, 1, 0), (30, 0, 1), (31, 1, 1), (29, 0, 0), (None, 1, 1), (33, None, 1), (34, 1, None), (999, 1, 1), (5, 1, 0), (1, 1, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").selectExpr("*", "1 as id", "2 as failed", "3 as good", "'p' as part", "4 as `a.b`", "5 as key")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r[0], r[1], r[2]): list(r[3:]) for r in filter_audit.audit(df, marks).collect()}
    assert got == audited(docs, labels)
    assert filter_audit.audit(df.limit(0), marks).count() == 0
    alone = filter_audit.audit(df.where("doc_id = 30"), marks.limit(0)).collect()
    assert len(alone) == 600 and sum(r["good_lost"] for r in alone) == 0


def test_filter_audit_adds_up(spark):
    """In every order what is kept and removed makes up the part, and a filter's Shapley sum is the same in all its rows."""
    from pyspark.sql import functions as F

    out = filter_audit.query(spark, DATA)
    sizes = {r[0]: r[1] for r in spark.read.parquet(f"{DATA}/documents.parquet").groupBy(F.coalesce("lang", F.lit(""))).count().collect()}
    last = out.groupBy("part", "filter_order").agg((F.sum("removed") + F.min("kept")).alias("all")).collect()
    assert len(last) == 120 * len(sizes) and all(r["all"] == sizes[r["part"]] for r in last)
    one = out.where("step = 1").select("part", F.substring("filter_order", 1, 1).alias("f"), "shapley").distinct()
    assert one.count() == 5 * len(sizes)


def test_digest_columns(spark):
    rows = secret_scan.query(spark, DATA).collect()
    for row in rows:
        spans = [s for s in row["spans"].split(",") if s.split(":")[0] in secret_scan.STRONG]
        assert row["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert len(spans) == row["n_assign"] + row["n_access"] + row["n_hex"]
