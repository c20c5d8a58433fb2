"""Each stage on nulls, empty and repeated rows, long texts, and extra columns with dotted and clashing names."""

import collections

import pytest
import tokenizers
from test_ops import DOCS, brute_cut, edge_documents
from test_similar import stays

import corpus_pipeline
from riskloom.llm import packing

MORE = ["doc_id", "text", "lang", "source", "n_chars", "1 as `a.b`", "2 as score", "'x' as lang_pred", "true as accepted", "4 as id", "5 as row_no"]


def test_language_stage(spark):
    docs = spark.createDataFrame(edge_documents(), DOCS).selectExpr(*MORE)
    out = corpus_pipeline.keep_languages(spark, docs, "")
    assert out.columns == docs.columns
    kept = [(r["doc_id"], r["text"], r["a.b"], r["score"], r["lang_pred"], r["accepted"]) for r in out.collect()]
    texts = {t: i for i, t, *_ in edge_documents()}
    assert all(x[2:] == (1, 2, "x", True) and x[1] in texts for x in kept)
    # Repeated rows stay repeated; what has no letter goes.
    assert sum(x[0] == 1 for x in kept) == 2 and not {5, 6, 7} & {x[0] for x in kept} and 14 in {x[0] for x in kept}
    assert corpus_pipeline.keep_languages(spark, docs.limit(0), "").count() == 0


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(edge_documents(), DOCS).selectExpr(*MORE)


def kept(docs, step):
    """``(doc_id, text)`` of the rows that stay, after a look at the columns, whose values of any name stay as well."""
    out = step(docs.sparkSession, docs, "")
    assert out.columns == docs.columns
    rows = out.collect()
    assert all((r["a.b"], r["score"], r["lang_pred"], r["accepted"], r["id"], r["row_no"]) == (1, 2, "x", True, 4, 5) for r in rows)
    assert step(docs.sparkSession, docs.limit(0), "").count() == 0
    return [(r["doc_id"], r["text"]) for r in rows]


def in_order():
    """The rows as (id, text), null ids last."""
    return sorted(((i, t) for i, t, *_ in edge_documents()), key=lambda x: (x[0] is None, x[0]))


def test_exact_stage(docs):
    key = lambda t: "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")
    best = {}
    for i, t in in_order():
        best.setdefault(key(t), []).append((i, t))
    # The longest, then the smallest id; of rows of the same id and text one.
    want = [max(group, key=lambda x: len(x[1] or "")) for group in best.values()]
    assert sorted(map(repr, kept(docs, corpus_pipeline.drop_copies))) == sorted(map(repr, want))


def test_near_stage(docs):
    rows = in_order()
    want = [rows[n] for n in stays(list(enumerate(t for _, t in rows)))]
    assert sorted(map(repr, kept(docs, corpus_pipeline.drop_near_copies))) == sorted(map(repr, want))


def test_suffix_stage(docs):
    rows = in_order()
    data = [(n, 1 << 62 if i is None else i, (t or "").encode()) for n, (i, t) in enumerate(rows)]
    masks = brute_cut(data, 50)
    want = collections.Counter((rows[n][0], bytes(c for c, m in zip(t, masks[n], strict=True) if not m).decode("utf-8", "ignore")) for n, _, t in data)
    assert collections.Counter((i, t or "") for i, t in kept(docs, corpus_pipeline.cut_passages)) == want


def test_packing_stage(spark, docs):
    known = tokenizers.Tokenizer.from_file(packing.VOCABULARY)
    size = {i: 0 for i, _ in in_order()}
    for i, t in in_order():
        size[i] += len(known.encode(t or "", add_special_tokens=False).ids) + 1
    found = collections.Counter()
    for r in corpus_pipeline.pack(spark, docs, "").collect():
        found[r["doc_id"]] += r["length"]
    assert found == size
    assert corpus_pipeline.pack(spark, docs.limit(0), "").count() == 0
