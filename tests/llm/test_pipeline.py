"""The pipeline against brute force, stage by stage, each on its own input."""

import numpy as np
from conftest import DATA
from test_ops import brute_cut, held
from test_similar import stays

import corpus_pipeline


def test_pipeline(spark):
    from riskloom.llm.common import stage

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, step in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = stage(step(spark, docs, DATA), name)
        seen[name] = (before, docs.collect())
        if name != "packing":
            assert docs.columns == columns
    before, after = seen["language_id"]
    assert len(after) >= 0.99 * len(before) and all(before[r["doc_id"]] == r for r in after)

    before, after = seen["exact_dedup"]
    key = lambda t: "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")
    best = {}
    for i, r in before.items():
        best[key(r["text"])] = min(best.get(key(r["text"]), (1, 0)), (-len(r["text"] or ""), i))
    assert {r["doc_id"] for r in after} == {i for _, i in best.values()}

    before, after = seen["simhash_dedup"]
    assert {r["doc_id"] for r in after} == stays([(i, r["text"]) for i, r in before.items()]) and len(after) < len(before)

    before, after = seen["suffix_dedup"]
    masks = brute_cut([(i, i, (r["text"] or "").encode()) for i, r in before.items()], 50)
    assert len(after) == len(before)
    for r in after:
        data = np.frombuffer((before[r["doc_id"]]["text"] or "").encode(), dtype=np.uint8)
        assert r["text"] == data[np.frombuffer(masks[r["doc_id"]], dtype=np.uint8) == 0].tobytes().decode("utf-8", "ignore")

    before, after = seen["packing"]
    assert held(after, [(i, r["text"]) for i, r in before.items()]) < 0.05
    assert {(r["doc_id"], r["start"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, DATA).collect()} == {(r["doc_id"], r["start"], r["ids_crc32"]) for r in after}
