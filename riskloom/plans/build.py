"""The whole model from stored tables: panel, descriptors, styles, factor returns, each step a table that the next one reads.

    python -m riskloom.plans.build --tables DIR --out DIR [--step all|panel|descriptors|styles|returns] [--start DATE] [--end DATE]

``--tables`` has the vendor's tables (``sources.extracts.TABLES``) and ``rates(trade_date, rf)``, ``benchmark(trade_date, rt)``,
``industries(stock_code, industry_code)`` and, if there are any, ``reports(code, year, eps, revenue)``, all Parquet.
Windows look back over the whole history, so results don't depend on ``--start``; it only bounds what is written: the years from it on.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.codes import to_terminal
from riskloom.operators.model import factor_returns
from riskloom.operators.panel import KEY, between, calendar, densify, merge_columns
from riskloom.plans.descriptors import STYLES, Windows, descriptors, style_table
from riskloom.sources.extracts import TABLES
from riskloom.sources.files import load_panel
from riskloom.sources.sinks import exists, upsert_panel

STEPS = ("panel", "descriptors", "styles", "returns")
#: Columns of the panel, by the extracts' names.
PANEL = {
    "ret": "ret", "close_unadjusted": "price", "market_cap": "market_cap", "float_cap": "float_cap", "pb": "pb", "ep_ttm": "ep_ttm", "pcf_ttm": "pcf", "turnover_rate": "turnover",
    "total_assets": "assets", "total_liabilities": "liabilities", "non_current_liabilities": "ncl", "equity_parent": "equity",
    "eps_ftm": "eps_ftm", "np_growth_t3": "np_growth_t3", "np_growth_ftm": "np_growth_ftm",
}


def assemble(tables: dict[str, DataFrame], rates: DataFrame, benchmark: DataFrame, industries: DataFrame) -> DataFrame:
    """The dense panel of all codes that have an industry, on the dates that have a benchmark return.

    The extracts' columns meet in one union and one aggregation; columns that no table has are null.  The rate and the benchmark are a row a date.
    """
    facts = merge_columns([t.select(*KEY, *[F.col(c).alias(PANEL[c]) for c in t.columns if c in PANEL]) for t in tables.values()])
    missing = [c for c in PANEL.values() if c not in facts.columns]
    facts = facts.withColumns({c: F.lit(None).cast("double") for c in missing}) if missing else facts
    dates = benchmark.where(F.col("rt").isNotNull())
    universe = industries.where(F.col("industry_code").isNotNull()).groupBy(F.col("stock_code").alias("__t")).agg(F.min("industry_code").alias("industry"))
    codes = facts.select("code").distinct().withColumn("__t", to_terminal(F.col("code"))).join(universe, "__t").select("code", "industry")
    daily = dates.join(rates.select("trade_date", "rf"), "trade_date", "left").select("trade_date", "rf", "rt")
    return densify(facts, calendar(dates), codes).join(F.broadcast(daily), "trade_date")


def write(df: DataFrame, path: str, start: str | None, end: str | None, key: list[str]) -> None:
    upsert_panel(between(df, start, end), path, key)


def build(spark: SparkSession, tables: str, out: str, step: str = "all", start: str | None = None, end: str | None = None, windows: Windows = Windows()) -> list[str]:
    """Run a step, or all; returns the tables written."""
    read = lambda name: load_panel(spark, f"{tables}/{name}")
    wanted = STEPS if step == "all" else (step,)
    for s in wanted:
        if s == "panel":
            there = {n: read(n) for n in TABLES if exists(spark, f"{tables}/{n}")}
            if not there:
                raise ValueError(f"none of {sorted(TABLES)} in {tables}")
            # Whole, whatever --start: later steps look back over it.
            write(assemble(there, read("rates"), read("benchmark"), spark.read.parquet(f"{tables}/industries")), f"{out}/panel", None, end, KEY)
        elif s == "descriptors":
            more = {"reports": spark.read.parquet(f"{tables}/reports")} if exists(spark, f"{tables}/reports") else {}
            write(descriptors(load_panel(spark, f"{out}/panel").drop("year"), windows, **more), f"{out}/descriptors", start, end, KEY)
        elif s == "styles":
            write(style_table(load_panel(spark, f"{out}/descriptors", start, end).drop("year")), f"{out}/styles", start, end, KEY)
        elif s == "returns":
            styles = load_panel(spark, f"{out}/styles", start, end)
            write(factor_returns(styles, [x for x in STYLES if x in styles.columns]), f"{out}/factor_returns", start, end, ["trade_date", "factor_group", "factor"])
        else:
            raise ValueError(f"no step {s}; there are all, {', '.join(STEPS)}")
    return [f"{out}/{'factor_returns' if s == 'returns' else s}" for s in wanted]


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=(__doc__ or "").splitlines()[0])
    p.add_argument("--tables", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--step", default="all", choices=["all", *STEPS])
    p.add_argument("--start")
    p.add_argument("--end")
    a = p.parse_args(argv)
    for path in build(SparkSession.builder.appName("riskloom").getOrCreate(), a.tables, a.out, a.step, a.start, a.end):
        print(path)


if __name__ == "__main__":
    main()
