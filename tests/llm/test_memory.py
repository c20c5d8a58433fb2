"""Executors live on from stage to stage: what tasks hold beside the heap stays bounded."""

import inspect

import corpus_pipeline
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskloom.llm import common

BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def own_setting(spark):
    before = spark.conf.get(BYTES)
    yield
    spark.conf.set(BYTES, before)


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES if name != "exact_dedup"])  # native
def test_stages_hand_texts_over_in_small_batches(spark, own_setting, name):
    """6 MB of texts of 10 KB are fewer rows than Spark puts into one batch."""

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes]), pa.array([b.num_rows])], names=["bytes", "rows"])

    docs = spark.range(0, 600, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 2000).alias("text"), F.lit("en").alias("lang"))
    spark.conf.unset(BYTES)
    dict(corpus_pipeline.STAGES)[name](spark, docs.where("doc_id < 2"), "")
    found = docs.mapInArrow(sizes, "bytes long, rows long").collect()
    assert sum(r["rows"] for r in found) == 600
    assert max(r["bytes"] for r in found) < common.BATCH_BYTES + 20_000


def test_a_smaller_bound_stays(spark, own_setting):
    spark.conf.set(BYTES, "4096b")
    common.small_batches(spark)
    assert spark.conf.get(BYTES).rstrip("b") == "4096"


def test_work_is_over_before_memory_is_given_back(monkeypatch):
    alive, seen = [], []

    class Held:
        def __init__(self):
            alive.append(self)

        def __del__(self):
            seen.append("freed")

    monkeypatch.setattr(common, "give_back", lambda: seen.append("back"))

    def rows(batches):
        held = Held()
        alive.clear()
        yield from batches
        assert held

    def one(a):
        held = Held()
        alive.clear()
        return a if held else None

    assert list(common.gives_back(rows)([1, 2])) == [1, 2] and seen == ["freed", "back"]
    assert common.gives_back(one)(3) == 3 and seen == ["freed", "back"] * 2
    assert [len(inspect.getfullargspec(common.gives_back(f)).args) for f in (one, lambda a, b: a)] == [1, 2]
