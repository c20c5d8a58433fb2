"""Corpus pipeline: language ID, exact dedup, SimHash near-dedup, suffix-array dedup, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept.  All but the last return the
columns of ``documents``; the last returns the pieces of the packed sequences.  All five share executors that live on, so
each has Spark hand texts to Python in small batches (``common.small_batches``, a setting of the session).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import exact_dedup, language_id, packing, similar_dedup, suffix_dedup
from riskloom.llm.common import read, small_batches, stage


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that language ID rejects: no text, no letter, or too far from every language learned.

    Null texts go; rows that repeat another stay as they are, and columns of any name are kept; no rows give none.
    """
    small_batches(spark)
    model = language_id.fit(docs.where(~language_id.held_out()))
    return language_id.accepted(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays: the longest, then the one of smallest id.

    Null and white texts equal empty ones; null ids come last; of rows of the same id and text one stays; columns of any name are
    kept; no rows give none.
    """
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest id: SimHash's candidates, completed by an index and
    verified, link what has a similarity of 0.8 and more in shingles of five words.

    Texts without a word are similar to nothing and stay; fewer than five words are one shingle; null ids come last; of repeated
    rows with a word one stays; columns of any name are kept; no rows give none.
    """
    small_batches(spark)
    return similar_dedup.near_dedup(docs)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes and more that a document of a smaller id has, too, are cut out.

    All rows stay, those of one id as they are; null ids come after all others and are one id; bytes of a character cut in two go; null texts
    hold nothing; columns of any name are kept; no rows give none.
    """
    small_batches(spark)
    return suffix_dedup.dedup(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens.

    Null and empty texts are their end token alone; repeated rows are packed each; no rows give none; only ids and texts are looked at.
    """
    small_batches(spark)
    return packing.digest(packing.pack(docs))


STAGES = [
    ("language_id", keep_languages),
    ("exact_dedup", drop_copies),
    ("simhash_dedup", drop_near_copies),
    ("suffix_dedup", cut_passages),
    ("packing", pack),
]

#: Fingerprints, suffix sorting and tokenising have no SQL form; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
