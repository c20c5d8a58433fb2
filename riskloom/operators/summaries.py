"""Summaries of factor returns and attributions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.numeric import ratio
from riskloom.operators.attribution import GROUPS
from riskloom.operators.panel import calendar
from riskloom.operators.rolling import cumulative_return, rolling_deviation

YEAR = 242


def cumulative(returns: DataFrame, by: str = "factor", value: str = "value") -> DataFrame:
    """Each series compounded by itself."""
    return returns.withColumn("cumulative", cumulative_return(value, Window.partitionBy(by).orderBy("trade_date")))


def monthly(returns: DataFrame, by: str = "factor", value: str = "value") -> DataFrame:
    """Sums by calendar month."""
    return returns.groupBy(by, F.to_date(F.date_trunc("month", "trade_date")).alias("month")).agg(F.sum(value).alias(value))


def rolling_volatility(returns: DataFrame, window: int = 63, by: str = "factor", value: str = "value") -> DataFrame:
    return returns.join(F.broadcast(calendar(returns)), "trade_date").withColumn("volatility", rolling_deviation(value, window, YEAR, by)).drop("idx")


def summary(returns: DataFrame, by: str = "factor", value: str = "value", per_year: int = YEAR) -> DataFrame:
    """Cumulative and annualised return (null once all is lost), volatility and Sharpe ratio at a zero rate of each series."""
    g = 1 + F.col(value)
    s = returns.where(F.col(value).isNotNull()).groupBy(by).agg(F.count("*").alias("n"), (F.product(g) - 1).alias("cumulative"), (F.stddev_samp(value) * F.sqrt(F.lit(float(per_year)))).alias("volatility"))
    s = s.withColumn("annualised", F.when(F.col("cumulative") > -1, F.pow(1 + F.col("cumulative"), F.lit(float(per_year)) / F.col("n")) - 1))
    return s.withColumn("sharpe", ratio(F.col("annualised"), F.col("volatility")))


def contribution_shares(parts: DataFrame, per_year: int = YEAR) -> DataFrame:
    """Annualised sum of each component's contributions per fund, with its share of all."""
    s = parts.where("detail is null").groupBy("fund_id", "component").agg((F.avg("value") * per_year).alias("annualised"))
    return s.withColumn("share", ratio(F.col("annualised"), F.sum("annualised").over(Window.partitionBy("fund_id"))))


def ranked_styles(parts: DataFrame, per_year: int = YEAR) -> DataFrame:
    """``(fund_id, style, annualised, place)``: each fund's styles by their annualised contributions, the largest first."""
    s = parts.where((F.col("component") == GROUPS["style"]) & F.col("detail").isNotNull()).groupBy("fund_id", F.col("detail").alias("style")).agg((F.avg("value") * per_year).alias("annualised"))
    return s.withColumn("place", F.row_number().over(Window.partitionBy("fund_id").orderBy(F.desc("annualised"), "style")))
