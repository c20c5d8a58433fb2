"""Shared pieces of the training-data operators: reading, staging, skew-safe joins and components."""

from __future__ import annotations

import ctypes
import inspect
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key that holds at least this share of all rows is joined by broadcast; at most 1 / HOT_SHARE such keys can exist.
HOT_SHARE = 1.0 / 1000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the cluster's ``spark.checkpoint.dir``.

    Only where all runs in one process (``local`` masters, as in tests) and the setting is absent, a temporary folder is made and
    put into the session; a cluster without the setting is an error, for no executor sees another's folders.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir isn't set; {master} needs a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="riskloom-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def stage(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet into the shared folder and read it again.

    A lost executor then costs a reread, never a recomputation.  The files go when the session ends.
    """
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"riskloom-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def unstage(*frames: DataFrame) -> None:
    """Delete the files behind staged frames that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        for name in {os.path.dirname(x) for x in df.inputFiles()}:
            at = spark._jvm.org.apache.hadoop.fs.Path(name)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def join_unique(rows: DataFrame, lookup: DataFrame, key: str, size: Column, total: int) -> DataFrame:
    """Left join of ``rows`` to ``lookup``, which has each ``key`` once and knows by ``size`` how many rows it meets.

    Keys with HOT_SHARE of all rows or more number 1 / HOT_SHARE at most, so they go by broadcast and their rows
    don't move; what remains is spread evenly by the key.
    """
    hot = size >= max(1, int(total * HOT_SHARE))
    few = lookup.where(hot)
    names = [c for c in lookup.columns if c != key]
    tagged = rows.join(F.broadcast(few.select(key, F.struct(*names).alias("__hot"))), key, "left")
    by_broadcast = tagged.where(F.col("__hot").isNotNull()).select(*rows.columns, "__hot.*")
    by_shuffle = tagged.where(F.col("__hot").isNull()).drop("__hot").join(lookup.where(~hot), key, "left")
    return by_broadcast.unionByName(by_shuffle.select(*rows.columns, *names))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a long, b long)``: ``(node, root)``, root being the smallest node reachable.

    Alternating large-star and small-star steps, each a map-side combined minimum and a join back, so that a node
    with very many neighbours is never gathered in one place.  Each round is staged; no part of the graph goes to the
    driver.  Nodes without an edge don't appear; self-loops and repeated edges are harmless; no edges give no rows.
    """
    now = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = stage(now, "edges")
    mark = lambda df: df.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
    same = mark(now)
    if not same[0]:
        return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n")
        # large star: every larger neighbour of a is hung below the least of a's neighbourhood
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: a and its smaller neighbours are hung below the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = stage(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        # settled once every edge leads from a node to its root: the same edges come out again
        new = mark(after)
        unstage(now)
        now = after
        if same == new:
            break
        same = new
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of a few rows: Spark bounds a batch by its bytes, and this what Python makes of it at once."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


#: Bytes of an Arrow batch that Spark makes for Python where ``small_batches`` holds.
BATCH_BYTES = 1 << 20


def small_batches(spark: SparkSession) -> None:
    """From now on the session's Arrow batches for Python hold BATCH_BYTES and a row at most; a smaller bound of the user stays.

    Spark's own bound (10,000 rows, 64 MB) lets each task hold a batch of whole texts several times over, beside the heap and in
    the Python worker.  How rows fall into batches never changes a result.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    kept = re.sub(r"[bB]$", "", spark.conf.get(name))
    if not kept.isdigit() or int(kept) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def spare_name(docs: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column of ``docs`` has the name."""
    taken = {c.lower() for c in docs.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def numbered(docs: DataFrame, id_col: str, name: str) -> tuple[DataFrame, str]:
    """``docs`` and a column that tells its rows apart: the id where it does, else a row number, with a staged copy that keeps it.

    With an id of its own for each row nothing is copied; ``docs`` is then read several times and should be a stored table.
    """
    if docs.schema[id_col].dataType.typeName() in ("byte", "short", "integer", "long"):
        own = docs.groupBy(F.col(f"`{id_col}`").alias("id")).agg(F.count("*").alias("n"))
        if not own.where("n > 1 or id is null").head(1):
            return docs, id_col
    row = spare_name(docs, "row_no")
    return stage(docs.withColumn(row, F.monotonically_increasing_id()), name), row


#: Row numbers that are broadcast to be left out; more go through a shuffle of the rows.
LEFT_OUT = 2_000_000


def without(rows: DataFrame, row: str, gone: DataFrame) -> DataFrame:
    """``rows`` less those whose number is in ``gone(row)`` (staged, each number once); texts move only where ``gone`` is large."""
    few = gone.count() <= LEFT_OUT
    return rows.join(F.broadcast(gone) if few else gone.hint("merge"), row, "left_anti")


def give_back() -> None:
    """Hand memory that a Python worker has freed back to the system: workers live on and share an executor's limit."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def gives_back(work: Callable) -> Callable:
    """``work``, a generator or a function of one or two arguments, and then what it held goes back to the system: within it
    ``give_back`` would find its arrays still in use."""
    if inspect.isgeneratorfunction(work):

        def run(a):
            yield from work(a)
            give_back()

        return run

    def done(*args):
        out = work(*args)
        give_back()
        return out

    # Spark counts the arguments.
    return (lambda a: done(a)) if len(inspect.signature(work).parameters) == 1 else (lambda a, b: done(a, b))
