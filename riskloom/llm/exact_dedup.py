"""Exact dedup: two-pass Bloom filtering on text hashes, DataFrame functions only.

Every row has a short hash: a word of the filter and two bits in it.  Pass one counts the short hashes, combined map-side, and
puts those that occur more than once into the Bloom filter.  Pass two tests every row against the filter by broadcast: a row that misses
is surely alone and passes straight through, and only the rest, possibly repeated, are shuffled to be grouped by the
whole hash.  A false positive costs a row's way through the shuffle and never changes the result.  The filter's words are
broadcast in ranges of bounded size, one after the other, so the method is the same at any number of rows.

Defined cases: a null text counts as empty; a null id is allowed and loses ties; of equal texts the row with the most
code points stays, then the smallest id; rows that repeat an id are told apart by a row number, so exactly one row of each
group stays; an empty table gives no rows; other columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import join_unique, numbered, read, stage, without

WHITE = " \t\n\x0b\x0c\r"
#: Filter bits per row, bits of a word, and the most words with a bit set that are broadcast at once (16 bytes each).
BITS_PER_ROW, WORD, BROADCAST_WORDS = 16, 64, 1 << 20


def normal_text(text: Column) -> Column:
    """The text without its ASCII white space; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """``(id, sha, size, row_no)`` for every row, staged: the text is read once."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return stage(
        docs.select(
            F.col(id_col).alias("id"), F.sha2(normal_text(F.col(text_col)).cast("binary"), 256).alias("sha"),
            F.length(text).cast("long").alias("size"), (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row_no"),
        ),
        "fingerprints",
    )


def short_hash(words: int) -> tuple[Column, Column]:
    """A row's word of the filter, and the two bits (which may be one) that it has there."""
    at = F.xxhash64(F.lit(1), "sha")
    bits = F.expr(f"shiftleft(1L, cast(pmod(xxhash64(2, sha), {WORD}) as int)) | shiftleft(1L, cast(pmod(xxhash64(3, sha), {WORD}) as int))")
    return F.pmod(at, F.lit(words)), bits


def repeated(rows: DataFrame, words: int) -> DataFrame:
    """Pass one: the filter ``(word, filter)`` of the short hashes that more than one row has."""
    word, bits = short_hash(words)
    often = rows.select(word.alias("word"), bits.alias("bits")).groupBy("word", "bits").agg(F.count("*").alias("n")).where("n > 1")
    return often.groupBy("word").agg(F.bit_or("bits").alias("filter"))


def possibly_repeated(rows: DataFrame, total: int, most: int = BROADCAST_WORDS) -> tuple[DataFrame, DataFrame]:
    """Pass two: the rows that are surely alone, and the others."""
    words = max(64, total * BITS_PER_ROW // WORD)
    filled = stage(repeated(rows, words), "filter")
    ranges = max(1, -(-filled.count() // most))
    word, bits = short_hash(words)
    hashed = rows.withColumns({"word": word, "bits": bits})
    parts = []
    for i in range(ranges):
        # Words are hashes, so a range of them holds its share.
        here = F.col("word").between(words * i // ranges, words * (i + 1) // ranges - 1)
        tested = hashed.where(here).join(F.broadcast(filled.where(here)), "word", "left")
        maybe = F.coalesce(F.col("filter").bitwiseAND(F.col("bits")) == F.col("bits"), F.lit(False))
        parts.append(stage(tested.select(*rows.columns, maybe.alias("maybe")), "tested"))
    tested = parts[0]
    for p in parts[1:]:
        tested = tested.unionByName(p)
    return tested.where("not maybe").drop("maybe"), tested.where("maybe").drop("maybe")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """Every row's ``(id, row_no, sha, keep_id, keep_row, group_size)``; ``row_col`` numbers the rows, if they have numbers."""
    rows = fingerprints(docs, id_col, text_col, row_col)
    total = rows.count()
    alone, others = possibly_repeated(rows, total)
    best = F.min(F.struct(-F.col("size"), F.col("id").isNull(), F.col("id"), F.col("row_no")))
    kept = (
        others.groupBy("sha").agg(F.count("*").alias("group_size"), best.alias("best"))
        .select("sha", "group_size", F.col("best.id").alias("keep_id"), F.col("best.row_no").alias("keep_row"))
    )
    named = join_unique(others, stage(kept, "groups"), "sha", F.col("group_size"), total)
    alone = alone.withColumns({"group_size": F.lit(1).cast("long"), "keep_id": F.col("id"), "keep_row": F.col("row_no")})
    return alone.unionByName(named)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text repeats another's; columns are kept as they are."""
    rows, row = numbered(docs, id_col, "exact")
    gone = groups(rows, id_col, text_col, row).where("row_no <> keep_row").select(F.col("row_no").alias(row))
    return without(rows, row, stage(gone, "gone")).select(*[f"`{c}`" for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(read(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", (F.col("row_no") == F.col("keep_row")).alias("kept"), F.col("sha").alias("text_sha256")
    )


SQL = r"""
with n as (
  select doc_id, coalesce(text, '') as t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as k from documents
)
select doc_id,
       first_value(doc_id) over w as keep_id,
       count(*) over (partition by k) as group_size,
       row_number() over w = 1 as kept,
       sha256(k) as text_sha256
from n window w as (partition by k order by length(t) desc, doc_id)
"""

QUERIES = {"op8_exact_dedup": query}
ORACLE = {"op8_exact_dedup": SQL}
