"""Near-dedup by shingle similarity against brute force, alone and in the pipeline."""

import itertools
import random

import pytest
from conftest import DATA
from pyspark.sql import functions as F

import corpus_pipeline
from riskloom.llm import similar_dedup


def sets(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


def stays(rows):
    own, root = {i: sets(t) for i, t in rows}, {i: i for i, _ in rows}
    for a, b in itertools.combinations(sorted(own), 2):
        if jaccard(own[a], own[b]) >= 0.8 and root[a] != root[b]:
            low, high = sorted((root[a], root[b]))
            root = {i: low if x == high else x for i, x in root.items()}
    return {i for i, x in root.items() if i == x}


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(similar_dedup, "COMMON", 3)
    r, rows = random.Random(3), []
    line = " ".join(f"licence{i}" for i in range(30))
    for k in range(12):
        base = [f"w{r.randrange(400)}" for _ in range(r.choice((7, 40, 120)))]
        for _ in range(5):
            copy = list(base)
            for _ in range(r.randrange(0, 1 + len(base) // 30)):
                copy[r.randrange(len(copy))] = f"x{r.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy) + (" " + line if k % 2 else "")))
    rows += [(100, None), (101, ""), (102, " \n"), (103, "A b"), (104, "a  B"), (105, line), (106, line.upper())]
    got = similar_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x["doc_id"] for x in got} == stays(rows) and len(got) < len(rows) - 20
    none = spark.createDataFrame([], "doc_id long, text string")
    assert similar_dedup.near_dedup(none).count() == 0


@pytest.mark.parametrize("block", [8192, 3])
def test_large_groups_in_blocks(spark, monkeypatch, block):
    """A group of near copies, a chain whose ends aren't similar, and a line that many unlike documents share."""
    monkeypatch.setattr(similar_dedup, "BLOCK", block)
    monkeypatch.setattr(similar_dedup, "SALTS", 3)
    r = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base[:30] + [f"y{i}"] + base[31:])) for i in range(40)]
    rows += [(100 + i, " ".join(f"c{j}" for j in range(3 * i, 3 * i + 60))) for i in range(25)]
    line = " ".join(f"l{i}" for i in range(12))
    rows += [(200 + i, line + " " + " ".join(f"z{r.randrange(10**6)}" for _ in range(3))) for i in range(30)]
    r.shuffle(rows)
    got = similar_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x["doc_id"] for x in got} == stays(rows)


def test_rows_that_repeat_an_id(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(20)) for x in "ab")
    rows = [(3, a, 1), (5, a + " z", 2), (5, b, 3), (7, b + " z", 4), (7, b + " z", 5), (None, a, 6), (None, "alone", 7), (8, None, 8), (8, None, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_no int").withColumns({"row": F.lit(1), "h": F.lit("x"), "root": F.lit(None)})
    got = similar_dedup.near_dedup(docs)
    assert got.columns == docs.columns and [x["row_no"] for x in got.orderBy("row_no").collect()] == [1, 3, 7, 8, 9]


def test_no_near_copies_left_in_the_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for name, step in corpus_pipeline.STAGES:
        if name == "suffix_dedup":
            break
        docs = step(spark, docs, DATA)
    own = [sets(x["text"]) for x in docs.select("text").collect()]
    assert own and not any(jaccard(a, b) >= 0.8 for a, b in itertools.combinations(own, 2))
