"""Exposures of holdings and indices, and the valuation sheets that holdings come from."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.codes import account_digits, captioned_date, file_date, is_stock_account, with_suffix
from riskloom.functions.numeric import ratio

# Captions of the account-code column of a valuation sheet and, in order, of its weight column.
ACCOUNT_CAPTION, WEIGHT_CAPTION = "科目代码", "市值占净值"
WEIGHT_CAPTIONS = [f"{WEIGHT_CAPTION}%", "市值占比", "占净值比例"]
HEADER_ROWS = 20


def as_of_dates(wanted: DataFrame, dates: DataFrame, required: bool = False) -> DataFrame:
    """``wanted(fund_id, value_date)`` with the latest factor date at or before the value date; null, or an error if ``required``, if there is none.

    Every calendar day from the first factor date on gets the factor date in force: a table of days, which are few, for a broadcast.
    """
    w = Window.orderBy("trade_date")
    known = dates.select("trade_date").where(F.col("trade_date").isNotNull()).distinct().withColumn("__next", F.lead("trade_date").over(w))
    days = known.where("__next is not null").select("trade_date", F.explode(F.sequence("trade_date", F.date_sub("__next", 1))).alias("__day"))
    last = known.agg(F.max("trade_date").alias("__last"))
    out = wanted.join(F.broadcast(days), F.col("value_date") == F.col("__day"), "left").join(F.broadcast(last), F.lit(True), "left")
    out = out.select("fund_id", "value_date", F.when(F.col("value_date") >= F.col("__last"), F.col("__last")).otherwise(F.col("trade_date")).alias("trade_date"))
    early = out.where("trade_date is null").limit(5).collect() if required else []
    if early:
        raise ValueError(f"no factor date at or before {[(r['fund_id'], str(r['value_date'])) for r in early]}")
    return out


def last_complete_date(exposures: DataFrame, members: DataFrame, column: str = "size", share: float = 0.5) -> DataFrame:
    """One row: the newest date on which at least ``share`` of the members have a value; the earliest date if none qualifies."""
    per_day = exposures.join(members.select("code").distinct(), "code", "left_semi").groupBy("trade_date").agg(F.count(column).alias("n"))
    size = members.agg(F.countDistinct("code").alias("size"))
    every = exposures.select("trade_date").distinct().join(per_day, "trade_date", "left").join(F.broadcast(size), F.lit(True))
    good = F.when(F.coalesce("n", F.lit(0)) >= share * F.col("size"), F.col("trade_date"))
    return every.agg(F.coalesce(F.max(good), F.min("trade_date")).alias("trade_date"))


def percent_to_share(holdings: DataFrame, by: list[str], weight: str = "weight") -> DataFrame:
    """Weights that add up to more than 1.5 within a group are percentages."""
    return holdings.withColumn(weight, F.when(F.sum(weight).over(Window.partitionBy(*by)) > 1.5, F.col(weight) / 100).otherwise(F.col(weight)))


def merged_positions(holdings: DataFrame, by: list[str]) -> DataFrame:
    """One row per group and code, accounts added up, weights adding up to 1 within the group."""
    total = holdings.where(F.col("weight").isNotNull()).groupBy(*by, "code").agg(F.sum("weight").alias("weight"))
    return total.withColumn("weight", ratio(F.col("weight"), F.sum("weight").over(Window.partitionBy(*by))))


def holdings_exposure(holdings: DataFrame, exposures: DataFrame, styles: list[str], by: list[str]) -> DataFrame:
    """``(by, style, exposure, covered)``: weighted sums with missing exposures as 0.  ``holdings`` has by, code, weight and trade_date."""
    own = holdings.join(exposures.select("trade_date", "code", *styles), ["trade_date", "code"], "left")
    sums = own.groupBy(*by).agg(*[F.sum(F.col("weight") * F.coalesce(s, F.lit(0.0))).alias(s) for s in styles], *[F.count(s).alias(f"n_{s}") for s in styles])
    pairs = F.explode(F.array(*[F.struct(F.lit(s).alias("style"), F.col(s).alias("exposure"), F.col(f"n_{s}").alias("covered")) for s in styles]))
    return sums.select(*by, pairs.alias("e")).select(*by, "e.*")


def fund_exposure(holdings: DataFrame, exposures: DataFrame, styles: list[str]) -> DataFrame:
    """Exposures of funds ``(fund_id, value_date, code, weight)`` on the last factor date at or before each value date, which must exist."""
    positions = merged_positions(percent_to_share(holdings, ["fund_id", "value_date"]), ["fund_id", "value_date"])
    dated = as_of_dates(positions.select("fund_id", "value_date").distinct(), exposures.select("trade_date"), required=True)
    return holdings_exposure(positions.join(dated, ["fund_id", "value_date"]), exposures, styles, ["fund_id", "value_date", "trade_date"])


def index_exposure(weights: DataFrame, exposures: DataFrame, styles: list[str]) -> DataFrame:
    """Exposures of an index ``(code, weight)`` on its last complete date, or of ``(date, code, weight)`` on each date with factors."""
    if "date" in weights.columns:
        dated = weights.withColumnRenamed("date", "trade_date").join(exposures.select("trade_date").distinct(), "trade_date", "left_semi")
    else:
        dated = weights.join(F.broadcast(last_complete_date(exposures, weights)), F.lit(True))
    return holdings_exposure(merged_positions(dated, ["trade_date"]), exposures, styles, ["trade_date"])


def sheet_heads(cells: DataFrame) -> DataFrame:
    """``(fund_id, value_date, head)`` of each sheet: its date and the row and places of its captions, null where it has none."""
    captioned = F.filter(F.transform("cells", captioned_date), lambda d: d.isNotNull())
    place = lambda caption: F.expr(f"nullif(cast(array_position(transform(cells, c -> coalesce(trim(c) = '{caption}', false)), true) as int), 0)")
    is_head = F.exists("cells", lambda c: F.coalesce(F.contains(c, F.lit(ACCOUNT_CAPTION)), F.lit(False)))
    first = lambda d: F.min_by(F.get(d, F.lit(0)), F.when(F.size(d) > 0, F.col("row_no")))
    named = [F.max(file_date(F.col("file_name")))] if "file_name" in cells.columns else []
    head = F.struct("row_no", place(ACCOUNT_CAPTION).alias("account"), F.coalesce(*[place(c) for c in WEIGHT_CAPTIONS]).alias("weight"))
    return cells.groupBy("fund_id").agg(
        F.coalesce(first(captioned), *named).alias("value_date"),
        F.min(F.when(is_head & (F.col("row_no") < HEADER_ROWS), head)).alias("head"),
    )


def parse_valuation_sheet(cells: DataFrame, value_date: str | None = None) -> DataFrame:
    """Positions ``(fund_id, value_date, code, weight)`` of valuation sheets ``(fund_id, row_no, cells array<string>[, file_name])``.

    The date is the first captioned one in any cell, in row order, else that of the file's name; the header is the first of HEADER_ROWS rows with a
    cell that holds the account caption, and its columns go by whole captions; primary stock accounts count, or where a sheet has none,
    rows with a six-digit run; a weight that is no number is null.  A sheet without a date, a header, a weight column or a position is an error, as is
    one whose date isn't ``value_date``, if that is given.
    """
    head = sheet_heads(cells)
    if value_date is not None:
        given = F.lit(value_date).cast("date")
        other = head.where(F.col("value_date") != given).limit(5).collect()
        if other:
            raise ValueError(f"sheets of another date than {value_date}: {[(r['fund_id'], str(r['value_date'])) for r in other]}")
        head = head.withColumn("value_date", given)
    bad = head.where("value_date is null or head is null or head.weight is null or head.account is null").limit(5).collect()
    for r in bad:
        lacks = "date" if r["value_date"] is None else f"header with {ACCOUNT_CAPTION} in the first {HEADER_ROWS} rows" if r["head"] is None or r["head"]["account"] is None else f"weight column out of {WEIGHT_CAPTIONS}"
        raise ValueError(f"sheet {r['fund_id']} has no {lacks}")
    rows = cells.join(head, "fund_id").where(F.col("row_no") > F.col("head.row_no"))
    rows = rows.select("fund_id", "value_date", F.trim(F.get("cells", F.col("head.account") - 1)).alias("account"), F.expr("try_cast(replace(replace(trim(get(cells, head.weight - 1)), '%', ''), ',', '') as double)").alias("weight"))
    any_primary = F.max(is_stock_account(F.col("account"))).over(Window.partitionBy("fund_id"))
    rows = rows.withColumn("__any", any_primary).where(F.when(F.col("__any"), is_stock_account(F.col("account"))).otherwise(account_digits(F.col("account")).isNotNull()))
    empty = head.join(rows.select("fund_id").distinct(), "fund_id", "left_anti").limit(5).collect()
    if empty:
        raise ValueError(f"sheets without stock positions: {[r['fund_id'] for r in empty]}")
    return rows.select("fund_id", "value_date", with_suffix(account_digits(F.col("account"))).alias("code"), "weight")
