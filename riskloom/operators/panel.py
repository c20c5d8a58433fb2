"""Reshaping, alignment and upserts of long (trade_date, code) panels.

A panel is dense before any ROWS frame runs over it: every code has a row for each calendar date of its history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ["trade_date", "code"]


def nan_to_null(df: DataFrame) -> DataFrame:
    """At ingest: NaN measures become null, for aggregates skip null only."""
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c, t in df.dtypes if t in ("double", "float")})


def calendar(df: DataFrame, date_col: str = "trade_date") -> DataFrame:
    """Distinct dates with ``idx`` from 1.  Dates are few, whatever the size of the data, so one task numbers them."""
    return df.select(F.col(date_col).alias("trade_date")).where(F.col(date_col).isNotNull()).distinct().withColumn("idx", F.row_number().over(Window.orderBy("trade_date")))


def densify(facts: DataFrame, dates: DataFrame, universe: DataFrame) -> DataFrame:
    """A row for each date and member of the universe, with the facts where there are any.  Dates are broadcast."""
    return universe.crossJoin(F.broadcast(dates)).join(facts, KEY, "left")


def history(order: str = "idx", by: str = "code") -> Window:
    return Window.partitionBy(by).orderBy(order)


def fill(df: DataFrame, columns: list[str], method: str | None = "ffill", by: str | None = "code", order: str = "trade_date") -> DataFrame:
    """Forward or backward fill in date order, within each code or over a single series (``by=None``)."""
    w = (Window.partitionBy(by) if by else Window.partitionBy(F.lit(0))).orderBy(order)
    if method == "ffill":
        return df.withColumns({c: F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)) for c in columns})
    if method == "bfill":
        return df.withColumns({c: F.first(c, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)) for c in columns})
    if method is None:
        return df
    raise ValueError(method)


def align(series: DataFrame, dates: DataFrame, columns: list[str], method: str | None = "ffill") -> DataFrame:
    """A series on the given dates.  Its dates that aren't among them are dropped before anything is filled."""
    return fill(dates.select("trade_date").join(series.select("trade_date", *columns), "trade_date", "left"), columns, method, by=None)


def interior_fill(df: DataFrame, columns: dict[str, str], value: float = 0.0) -> DataFrame:
    """New columns {new: old}: nulls between a code's first and last value become ``value``, those outside stay."""
    w = Window.partitionBy("code")
    out = {}
    for new, old in columns.items():
        at = F.when(F.col(old).isNotNull(), F.col("idx"))
        inside = (F.col("idx") >= F.min(at).over(w)) & (F.col("idx") <= F.max(at).over(w))
        out[new] = F.when(inside, F.coalesce(F.col(old), F.lit(value)))
    return df.withColumns(out)


def warm_up(df: DataFrame, dates: DataFrame, start: str, rows: int) -> DataFrame:
    """Rows from ``rows`` - 1 calendar dates before the first date at or after ``start``, as far back as there are any."""
    first = dates.where(F.col("trade_date") >= F.lit(start).cast("date")).agg(F.min("idx").alias("__i"))
    begin = dates.join(F.broadcast(first), F.col("idx") >= F.col("__i") - (rows - 1)).agg(F.min("trade_date").alias("__d"))
    return df.join(F.broadcast(begin), F.col("trade_date") >= F.col("__d")).drop("__d")


def between(df: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Dates from ``start`` through ``end``."""
    d = F.col("trade_date")
    if start is not None:
        df = df.where(d >= F.lit(start).cast("date"))
    return df if end is None else df.where(d <= F.lit(end).cast("date"))


def keep_largest(df: DataFrame, value: str, key: list[str] = KEY) -> DataFrame:
    """One row per key, that of the largest value; null only if all are."""
    return df.groupBy(*key).agg(F.max(value).alias(value))


def keep_one(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in a stated order."""
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("__r = 1").drop("__r")


def to_wide(df: DataFrame, value: str, codes: list[str] | None = None) -> DataFrame:
    """A column per code, for export at the edge; duplicates keep the largest."""
    return df.groupBy("trade_date").pivot("code", codes).agg(F.max(value))


def to_long(df: DataFrame, value: str = "value", ids: tuple[str, ...] = ("trade_date",), variable: str = "code") -> DataFrame:
    """Columns to rows, without null cells."""
    return df.unpivot(list(ids), [c for c in df.columns if c not in ids], variable, value).where(F.col(value).isNotNull())


def rename_date(df: DataFrame) -> DataFrame:
    """Whichever of the usual date columns there is becomes ``trade_date``."""
    found = next((c for c in ("date", "tradedate", "datetime") if c in df.columns), None)
    return df.withColumnRenamed(found, "trade_date") if found else df


def upsert(old: DataFrame, new: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Cell by cell the newest value that isn't null; rows and columns of either side are kept."""
    names = [c for c in dict.fromkeys(old.columns + new.columns) if c not in key]
    tagged = old.withColumn("__v", F.lit(0)).unionByName(new.withColumn("__v", F.lit(1)), allowMissingColumns=True)
    return tagged.groupBy(*key).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("__v"))).alias(c) for c in names])


def high_water_mark(df: DataFrame, default: str) -> DataFrame:
    """One row: the latest date, or the default if there is none."""
    return df.agg(F.coalesce(F.max("trade_date"), F.lit(default).cast("date")).alias("latest"))


def common_high_water_mark(frames: list[DataFrame], default: str) -> DataFrame:
    """One row: the earliest of several tables' high-water marks."""
    marks = [high_water_mark(f, default) for f in frames]
    out = marks[0]
    for m in marks[1:]:
        out = out.unionByName(m)
    return out.agg(F.min("latest").alias("latest"))


def merge_columns(frames: list[DataFrame], key: list[str] = KEY) -> DataFrame:
    """Full outer join of frames with different columns, by one union and one aggregation."""
    names = [c for f in frames for c in f.columns if c not in key]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.groupBy(*key).agg(*[F.first(c, ignorenulls=True).alias(c) for c in names])


def missing_keys(needed: DataFrame, have: DataFrame, key: str = "trade_date") -> DataFrame:
    """Keys that are needed and not there."""
    return needed.select(key).distinct().join(have.select(key).distinct(), key, "left_anti")


def require_keys(needed: DataFrame, have: DataFrame, key: str = "trade_date") -> None:
    gone = missing_keys(needed, have, key).limit(5).collect()
    if gone:
        raise ValueError(f"missing {key}: {[str(r[0]) for r in gone]}")


def complete_cases(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)
