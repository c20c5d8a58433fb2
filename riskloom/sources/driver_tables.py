"""The equity panel read off the driver's order tables: suppliers are securities, regions industries, months or days dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.functions.numeric import ratio
from riskloom.operators.panel import calendar, densify, fill, history
from riskloom.operators.rolling import simple_return
from riskloom.sources.staging import staged


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def month(c: str):
    return F.to_date(F.date_trunc("month", c))


def securities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(code, industry)``."""
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    return s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(F.col("s_suppkey").cast("string").alias("code"), F.col("n_regionkey").cast("string").alias("industry"))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly sums of each security, before the grid is made dense."""
    gross = F.col("l_extendedprice")
    flag = lambda x: F.sum(F.when(F.col("l_returnflag") == x, gross))
    return table(spark, sf_dir, "lineitem").groupBy(month("l_shipdate").alias("trade_date"), F.col("l_suppkey").cast("string").alias("code")).agg(
        F.sum(gross).alias("market_cap"), F.sum(gross * (1 - F.col("l_discount"))).alias("float_cap"), F.sum("l_quantity").alias("quantity"),
        flag("R").alias("liabilities"), flag("N").alias("equity"), flag("A").alias("ncl"), F.avg("l_tax").alias("tax"), F.avg("l_discount").alias("discount"),
        F.count("l_discount").alias("trades"),
    )


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(trade_date, rf)``, annualised."""
    return table(spark, sf_dir, "lineitem").groupBy(month("l_shipdate").alias("trade_date")).agg(F.avg("l_discount").alias("rf"))


def monthly_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense monthly panel with price, return, fundamentals, the rate and the benchmark's return."""
    facts = cells(spark, sf_dir)
    p = densify(facts, calendar(facts), securities(spark, sf_dir))
    cap, net = F.col("market_cap"), F.col("float_cap")
    p = p.withColumns({
        "price": ratio(cap, F.col("quantity")), "turnover": F.col("quantity") / 100, "assets": cap, "pb": ratio(cap, F.col("equity")),
        "pcf": ratio(cap, F.col("ncl")), "ep_ttm": F.col("tax"), "eps_ftm": F.col("tax"), "np_growth_t3": F.col("tax") * 100, "np_growth_ftm": F.col("discount") * 100,
    })
    # Written once: the rate and the benchmark, one row a date for a broadcast, are summed from it, and what reads the panel reads no orders.
    p = staged(p.withColumn("ret", simple_return("price", history())), "panel")
    days = p.groupBy("trade_date").agg(
        ratio(F.sum(F.col("discount") * F.col("trades")), F.sum("trades")).alias("rf"),
        ratio(F.sum(net * F.col("ret")), F.sum(F.when(F.col("ret").isNotNull(), net))).alias("rt"),
    )
    return p.join(F.broadcast(days), "trade_date")


def annual_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(code, year, eps, revenue)``."""
    gross = F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").cast("string").alias("code"), F.year("l_shipdate").alias("year")).agg(
        F.sum(gross * (1 - F.col("l_discount"))).alias("eps"), F.sum(gross).alias("revenue")
    )


def nation_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense daily panel of nations as securities, the price filled forward, for windows of the default sizes."""
    li, s, n = (table(spark, sf_dir, t) for t in ("lineitem", "supplier", "nation"))
    facts = li.join(s, li["l_suppkey"] == s["s_suppkey"]).groupBy(F.to_date("l_shipdate").alias("trade_date"), F.col("s_nationkey").cast("string").alias("code")).agg(
        F.sum("l_extendedprice").alias("gross"), F.sum("l_quantity").alias("quantity")
    )
    p = densify(facts, calendar(facts), n.select(F.col("n_nationkey").cast("string").alias("code"), F.col("n_regionkey").cast("string").alias("industry")))
    p = fill(p.withColumn("price", ratio(F.col("gross"), F.col("quantity"))), ["price"])
    p = staged(p.withColumn("ret", simple_return("price", history())), "panel")
    days = p.groupBy("trade_date").agg(F.avg("ret").alias("rt"))
    return p.join(F.broadcast(days), "trade_date").withColumn("turnover", F.col("quantity") / 100)


def region_nav(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(fund_id, trade_date, nav)``: each region's average price over its first, on the days it has one."""
    li, s, n = (table(spark, sf_dir, t) for t in ("lineitem", "supplier", "nation"))
    rows = li.join(s, li["l_suppkey"] == s["s_suppkey"]).join(n, s["s_nationkey"] == n["n_nationkey"])
    p = rows.groupBy(F.col("n_regionkey").cast("string").alias("fund_id"), F.to_date("l_shipdate").alias("trade_date")).agg((F.sum("l_extendedprice") / F.sum("l_quantity")).alias("price"))
    first = F.first("price").over(Window.partitionBy("fund_id").orderBy("trade_date"))
    return p.select("fund_id", "trade_date", (F.col("price") / first).alias("nav"))


def region_nav_monthly(panel: DataFrame) -> DataFrame:
    p = panel.where(F.col("price").isNotNull()).groupBy(F.col("industry").alias("fund_id"), "trade_date").agg((F.sum("market_cap") / F.sum("quantity")).alias("price"))
    first = F.first("price").over(Window.partitionBy("fund_id").orderBy("trade_date"))
    return p.select("fund_id", "trade_date", (F.col("price") / first).alias("nav"))


def region_holdings(panel: DataFrame) -> DataFrame:
    """``(fund_id, value_date, code, weight)``: float-cap percentages of each region's securities at the last month, valued nine days later."""
    last = panel.agg(F.max("trade_date").alias("__d"))
    now = panel.join(F.broadcast(last), F.col("trade_date") == F.col("__d")).where(F.col("float_cap") > 0)
    share = 100 * F.col("float_cap") / F.sum("float_cap").over(Window.partitionBy("industry"))
    return now.select(F.col("industry").alias("fund_id"), F.date_add("trade_date", 9).alias("value_date"), "code", share.alias("weight"))
