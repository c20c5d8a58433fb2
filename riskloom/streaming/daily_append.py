"""Daily drops as a stream: each micro-batch is upserted into the stored panel, and descriptors follow from a warm-up slice.

A batch that is replayed after a failure merges into what it left, so the result doesn't change.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from riskloom.operators.panel import KEY, calendar, densify, warm_up
from riskloom.operators.xsection import standardize
from riskloom.plans.descriptors import Windows, raw_descriptors
from riskloom.sources.files import load_panel
from riskloom.sources.sinks import upsert_panel
from riskloom.sources.staging import staged, unstaged

#: Factors whose values depend on what is past only: the others fill gaps with what comes after, or need reports.
TRAILING = ("size", "beta", "momentum", "liquidity")


def append_daily(
    spark: SparkSession, drops: str, schema: StructType, table: str, checkpoint: str, after: Callable[[DataFrame], None] | None = None, key: list[str] = KEY, files_per_batch: int | None = None
) -> StreamingQuery:
    """Start a query that takes all new Parquet drops and stops; ``after`` gets each batch, for recomputation from its dates on.

    ``files_per_batch`` makes micro-batches of so many drops; without it all that are new are one.
    """

    def merge(batch: DataFrame, _: int) -> None:
        batch = batch.persist()
        try:
            if upsert_panel(batch, table, key) and after:
                after(batch)
        finally:
            batch.unpersist()

    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(drops).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def bring_up(spark: SparkSession, table: str, out: str, since: str, windows: Windows = Windows(), wanted: tuple[str, ...] = TRAILING) -> None:
    """Recompute the standardised descriptors of the dates from ``since`` on, and upsert them into ``out``.

    Of the stored panel only as many dates before ``since`` are read as the longest window and its lag look back; they are made
    dense with the codes that they have.  ``wanted`` are factors out of TRAILING, so that the slice gives what the whole history would.
    """
    other = sorted(set(wanted) - set(TRAILING))
    if other:
        raise ValueError(f"{other} don't depend on the past alone")
    panel = load_panel(spark, table).drop("year", "idx", "rf", "rt")
    dates = calendar(panel)
    slice_ = warm_up(panel, dates, since, windows.longest + windows.momentum[2] + 1)
    first = slice_.agg(F.min("trade_date").alias("__first"))
    kept = dates.join(F.broadcast(first), F.col("trade_date") >= F.col("__first")).drop("__first")
    series = load_panel(spark, table).groupBy("trade_date").agg(F.max("rf").alias("rf"), F.max("rt").alias("rt"))
    industry = slice_.groupBy("code").agg(F.max_by("industry", F.when(F.col("industry").isNotNull(), F.col("trade_date"))).alias("industry"))
    dense = densify(slice_.drop("industry"), kept, industry).join(F.broadcast(series), "trade_date")
    df, names = raw_descriptors(dense, windows, list(wanted))
    names = [n for n in names if n in df.columns]
    df = staged(df.select(*KEY, "float_cap", *names), "descriptors")
    new = standardize(df, names).where(F.col("trade_date") >= F.lit(since).cast("date"))
    upsert_panel(new.select(*KEY, *names), out)
    unstaged(df)


def follow(spark: SparkSession, drops: str, schema: StructType, table: str, out: str, checkpoint: str, windows: Windows = Windows(), wanted: tuple[str, ...] = TRAILING, files_per_batch: int | None = None) -> StreamingQuery:
    """``append_daily``, the descriptors in ``out`` following each batch from its first date on.

    Drops have the panel's columns: trade_date, code, industry, ret, float_cap, market_cap, turnover, and rf and rt, which are the date's.
    """
    return append_daily(spark, drops, schema, table, checkpoint, lambda batch: bring_up(spark, table, out, str(batch.agg(F.min("trade_date")).first()[0]), windows, wanted), files_per_batch=files_per_batch)
