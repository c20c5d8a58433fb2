"""Performance statistics of net asset values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.dates import is_friday
from riskloom.functions.numeric import ratio
from riskloom.operators.rolling import losing_streak

RISK_FREE, NONE = 0.03, 9999.0
PER_YEAR = {"d": 250.0, "w": 52.0}


def dense_nav(nav: DataFrame, dates: DataFrame) -> DataFrame:
    """``(fund_id, trade_date, nav)`` on all calendar dates from a fund's first to its last, gaps filled forward."""
    span = nav.groupBy("fund_id").agg(F.min("trade_date").alias("__a"), F.max("trade_date").alias("__b"))
    grid = span.join(F.broadcast(dates.select("trade_date")), F.col("trade_date").between(F.col("__a"), F.col("__b"))).select("fund_id", "trade_date")
    w = Window.partitionBy("fund_id").orderBy("trade_date").rowsBetween(Window.unboundedPreceding, 0)
    return grid.join(nav, ["fund_id", "trade_date"], "left").withColumn("nav", F.last("nav", ignorenulls=True).over(w))


def week_ends(nav: DataFrame, last_day: bool = False) -> DataFrame:
    """Fridays, so that a week without one is left out; or with ``last_day`` each week's last date."""
    if not last_day:
        return nav.where(is_friday(F.col("trade_date")))
    week = Window.partitionBy("fund_id", F.date_trunc("week", "trade_date"))
    return nav.withColumn("__m", F.max("trade_date").over(week)).where("trade_date = __m").drop("__m")


def max_drawdown(nav: DataFrame) -> DataFrame:
    """``(fund_id, max_drawdown, drawdown_start, drawdown_end)``: the first deepest fall from the peak so far, as a negative number; 0 and null dates if there is none."""
    w = Window.partitionBy("fund_id").orderBy("trade_date").rowsBetween(Window.unboundedPreceding, 0)
    d = nav.where(F.col("nav").isNotNull()).withColumn("peak", F.max("nav").over(w))
    d = d.withColumn("fall", ratio(F.col("peak") - F.col("nav"), F.col("peak")))
    d = d.withColumn("peak_date", F.min(F.struct(-F.col("nav"), F.col("trade_date"))).over(w)["trade_date"])
    worst = d.groupBy("fund_id").agg(F.max("fall").alias("fall"), F.min(F.struct(-F.col("fall"), F.col("trade_date"), F.col("peak_date"))).alias("at"))
    some = F.col("fall") > 0
    return worst.select("fund_id", (-F.col("fall") + F.lit(0.0)).alias("max_drawdown"), F.when(some, F.col("at.peak_date")).alias("drawdown_start"), F.when(some, F.col("at.trade_date")).alias("drawdown_end"))


def trailing_returns(nav: DataFrame, months: tuple[int, ...] = (1, 3, 6, 12)) -> DataFrame:
    """Returns from the first value at or after the last date less n months, and from the last date's year's first value."""
    n = nav.withColumn("__end", F.max("trade_date").over(Window.partitionBy("fund_id"))).where(F.col("nav").isNotNull())
    d = F.col("trade_date")
    last = F.max_by("nav", d)
    since = lambda ok: ratio(last, F.min_by(F.col("nav"), F.when(ok, d))) - 1
    made = [since(d >= F.add_months("__end", -m)).alias(f"ret_{m}m") for m in months]
    return n.groupBy("fund_id").agg(*made, since(F.year(d) == F.year("__end")).alias("ret_ytd"))


def weekly_returns(nav: DataFrame, first_week: bool) -> DataFrame:
    """Returns between week ends; with ``first_week`` the first counts from the first value of all."""
    w = Window.partitionBy("fund_id").orderBy("trade_date")
    begin = nav.groupBy("fund_id").agg(F.min_by("nav", "trade_date").alias("__first"))
    ends = week_ends(nav).withColumn("__before", F.lag("nav").over(w)).join(begin, "fund_id")
    base = F.when(F.row_number().over(w) == 1, F.col("__first") if first_week else F.lit(None).cast("double")).otherwise(F.col("__before"))
    weeks = ends.withColumn("__n", F.row_number().over(w)).withColumn("week_ret", ratio(F.col("nav"), base) - 1)
    return (weeks if first_week else weeks.where("__n > 1")).select("fund_id", "trade_date", "week_ret")


def week_statistics(weeks: DataFrame, means: bool) -> DataFrame:
    """Counts, wins, gain/loss ratio (of sums, or of ``means``), mean, least, volatility and longest losing streak; no gain is a loss."""
    r = F.col("week_ret")
    streak = losing_streak(weeks.withColumn("win", F.coalesce(r > 0, F.lit(False))), "win", "fund_id", "trade_date")
    pick = F.avg if means else F.sum
    loss = F.abs(pick(F.when(r < 0, r)))
    gain = pick(F.when(r > 0, r))
    rate = ratio(gain, loss) if means else F.when(F.coalesce(loss, F.lit(0.0)) == 0, F.lit(NONE)).otherwise(F.coalesce(gain, F.lit(0.0)) / loss)
    return streak.groupBy("fund_id").agg(
        F.count("*").alias("n_weeks"), F.sum(F.when(r > 0, 1).otherwise(0)).alias("n_wins"), F.sum(F.when(r > 0, 0).otherwise(1)).alias("n_losses"),
        F.avg(F.when(r > 0, 1.0).otherwise(0.0)).alias("win_rate"), rate.alias("profit_loss"), F.avg(r).alias("mean_week"), F.min(r).alias("min_week"),
        (F.sqrt(F.lit(52.0)) * F.stddev_samp(r)).alias("vol_week"), F.max("streak").alias("longest_losing"),
    )


def period_statistics(nav: DataFrame, per_year: float) -> DataFrame:
    """Cumulative, annualised, volatility and downside volatility from row to row."""
    w = Window.partitionBy("fund_id").orderBy("trade_date")
    n = nav.withColumn("r", ratio(F.col("nav"), F.lag("nav").over(w)) - 1)
    d = F.col("trade_date")
    s = n.groupBy("fund_id").agg(
        (F.count("*") - 1).alias("n_periods"), (ratio(F.max_by("nav", d), F.min_by("nav", d)) - 1).alias("cumulative"),
        (F.sqrt(F.lit(per_year)) * F.stddev_samp("r")).alias("volatility"), F.sum(F.when(F.col("r") < 0, F.col("r") * F.col("r")).otherwise(0.0)).alias("__d"),
    )
    s = s.withColumn("annualised", F.when(F.col("n_periods") > 0, F.pow(1 + F.col("cumulative"), per_year / F.col("n_periods")) - 1))
    return s.withColumn("downside", F.when(F.col("n_periods") > 1, F.sqrt("__d") * F.sqrt(per_year / (F.col("n_periods") - 1)))).drop("__d")


def ratios(s: DataFrame) -> DataFrame:
    a, m, d = F.col("annualised"), F.col("max_drawdown"), F.col("downside")
    over: Column = a - RISK_FREE
    return s.withColumns({"sharpe": ratio(over, F.col("volatility")), "calmar": F.when(m != 0, -a / m).otherwise(NONE), "sortino": F.when(d != 0, over / d).otherwise(NONE)})


def performance(nav: DataFrame, dates: DataFrame, period: str = "d") -> DataFrame:
    """One row per fund of daily ('d', 250 a year) or weekly ('w', 52 a year) statistics."""
    if period not in PER_YEAR:
        raise ValueError("period is 'd' or 'w'")
    dense = dense_nav(nav, dates)
    rows = dense if period == "d" else week_ends(dense)
    weeks = week_statistics(weekly_returns(dense, first_week=period == "d"), means=period == "w")
    out = period_statistics(rows, PER_YEAR[period]).join(trailing_returns(rows), "fund_id").join(max_drawdown(rows), "fund_id").join(weeks, "fund_id", "left")
    return ratios(out)
