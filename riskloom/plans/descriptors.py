"""Descriptors and styles: a registry of plain functions with their dependencies, and the style weights.

A factor is added by a function that puts raw columns on the panel, a registry entry and weights.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.dates import report_effective_date, report_key
from riskloom.functions.numeric import log, ratio
from riskloom.operators.model import composed
from riskloom.operators.panel import interior_fill
from riskloom.operators.rolling import report_trend, rolling_wls, with_blocks, with_deviation, with_log_turnover, with_range, with_strength
from riskloom.operators.xsection import orthogonalized, residual, standardize, unit_scaled
from riskloom.sources.staging import staged


@dataclass(frozen=True)
class Windows:
    """Window lengths in rows of the calendar; the defaults are for trading days."""

    beta: tuple[int, float, int] = (252, 63, 42)  # rows, half-life, most missing
    momentum: tuple[int, float, int, int] = (504, 126, 21, 483)  # rows, half-life, lag, least values
    deviation: tuple[int, float] = (252, 42)
    range: tuple[int, int] = (21, 12)  # step, points
    liquidity: tuple[tuple[int, int, int], ...] = ((21, 18, 1), (63, 54, 3), (252, 216, 12))  # rows, least values, months
    years: int = 5
    per_year: int = 365

    @property
    def longest(self) -> int:
        """Rows of the longest window, the length of blocks of running sums."""
        return max(self.beta[0], self.momentum[0], self.deviation[0], self.range[0] * self.range[1], *[p[0] for p in self.liquidity])


MONTHLY = Windows(beta=(24, 6, 4), momentum=(24, 12, 1, 23), deviation=(12, 6), range=(1, 12), liquidity=((3, 2, 1), (6, 5, 3), (12, 10, 12)))


@dataclass(frozen=True)
class Factor:
    outputs: tuple[str, ...]
    add: Callable[[DataFrame, Windows, dict], DataFrame]
    depends_on: tuple[str, ...] = field(default=())


def excess(df: DataFrame, w: Windows) -> DataFrame:
    """Arithmetic and log returns over the rate, and the benchmark's."""
    daily = F.col("rf") / w.per_year
    return df.withColumns({"ex": F.col("ret") - daily, "lx": log(1 + F.col("ret")) - F.log1p(daily), "bx": F.col("rt") - daily})


def size(df: DataFrame, w: Windows, more: dict) -> DataFrame:
    return df.withColumn("lncap", log(F.col("market_cap")))


def beta(df: DataFrame, w: Windows, more: dict) -> DataFrame:
    begin = F.min(F.when(F.col("rt").isNotNull(), F.col("idx"))).over(Window.partitionBy("code"))
    return rolling_wls(df.withColumn("__from", begin), "ex", "bx", *w.beta, active=F.col("idx") >= F.col("__from"), rows=w.longest).drop("__from")


def momentum(df: DataFrame, w: Windows, more: dict) -> DataFrame:
    return with_strength(df, "rstr", "lx", *w.momentum, rows=w.longest)


def volatility(df: DataFrame, w: Windows, more: dict) -> DataFrame:
    df = interior_fill(df, {"__ex": "ex", "__lx": "lx"})
    df = with_deviation(df, "dastd", "__ex", *w.deviation, rows=w.longest)
    return with_range(df, "cmra", "__lx", *w.range, rows=w.longest).drop("__ex", "__lx")


def liquidity(df: DataFrame, w: Windows, more: dict) -> DataFrame:
    return with_log_turnover(df, "turnover", dict(zip(("stom", "stoq", "stoa"), w.liquidity, strict=True)), rows=w.longest)


def value(df: DataFrame, w: Windows, more: dict) -> DataFrame:
    return df.withColumn("btop", ratio(F.lit(1.0), F.col("pb")))


def earnings(df: DataFrame, w: Windows, more: dict) -> DataFrame:
    made = {"cetop": ratio(F.lit(1.0), F.col("pcf")), "etop": F.col("ep_ttm"), "epibs": ratio(F.col("eps_ftm"), F.col("price"))}
    return df.withColumns(made)


def growth(df: DataFrame, w: Windows, more: dict) -> DataFrame:
    # Units first: they need the panel alone, not the reports.
    if "np_growth_t3" in df.columns:
        df = unit_scaled(df.withColumns({"egibs": F.col("np_growth_t3"), "egibs_s": F.col("np_growth_ftm")}), ["egibs", "egibs_s"])
    if "reports" in more:
        trend = report_trend(more["reports"], {"egro": "eps", "sgro": "revenue"}, w.years).where(F.col("egro").isNotNull() | F.col("sgro").isNotNull())
        keyed = trend.select("code", report_key(F.col("year")).alias("__on"), "egro", "sgro")
        df = df.withColumn("__on", report_effective_date(F.col("trade_date"))).join(keyed, ["code", "__on"], "left").drop("__on")
    return df


def leverage(df: DataFrame, w: Windows, more: dict) -> DataFrame:
    me, be = F.col("market_cap"), F.col("equity")
    debt = F.coalesce("ncl", F.lit(0.0)) + (F.coalesce("preferred", F.lit(0.0)) if "preferred" in df.columns else F.lit(0.0))
    return df.withColumns({"mlev": ratio(me + debt, me), "dtoa": ratio(F.col("liabilities"), F.col("assets")), "blev": ratio(be + debt, be)})


FACTORS: dict[str, Factor] = {
    "size": Factor(("lncap", "nlsize"), size),
    "beta": Factor(("beta", "sigma"), beta),
    "momentum": Factor(("rstr",), momentum),
    "volatility": Factor(("dastd", "cmra", "hsigma"), volatility, ("beta",)),
    "liquidity": Factor(("stom", "stoq", "stoa"), liquidity),
    "value": Factor(("btop",), value),
    "earnings": Factor(("cetop", "etop", "epibs"), earnings),
    "growth": Factor(("egro", "sgro", "egibs", "egibs_s"), growth),
    "leverage": Factor(("mlev", "dtoa", "blev"), leverage),
}

# Weights of descriptors in styles.
STYLES: dict[str, dict[str, float]] = {
    "size": {"lncap": 1.0},
    "beta": {"beta": 1.0},
    "momentum": {"rstr": 1.0},
    "non_linear_size": {"nlsize": 1.0},
    "book_to_price": {"btop": 1.0},
    "residual_volatility": {"dastd": 0.74, "cmra": 0.16, "hsigma": 0.10},
    "liquidity": {"stom": 0.35, "stoq": 0.35, "stoa": 0.30},
    "earnings_yield": {"epibs": 0.68, "cetop": 0.21, "etop": 0.11},
    "growth": {"egro": 0.24, "sgro": 0.47, "egibs": 0.18, "egibs_s": 0.11},
    "leverage": {"mlev": 0.38, "dtoa": 0.35, "blev": 0.27},
}
# Styles made orthogonal to others, in this order.
ORTHOGONAL: dict[str, list[str]] = {"residual_volatility": ["beta", "size"], "liquidity": ["size"]}


def ordered(factors: dict[str, Factor], wanted: list[str] | None = None) -> list[str]:
    """Names with all they depend on, each after its dependencies."""
    out: list[str] = []
    path: list[str] = []

    def visit(name: str) -> None:
        if name in path:
            raise ValueError("cycle: " + " -> ".join([*path[path.index(name) :], name]))
        if name not in factors:
            raise ValueError(f"unknown factor {name}" + (f", needed by {path[-1]}" if path else ""))
        if name not in out:
            path.append(name)
            for d in factors[name].depends_on:
                visit(d)
            out.append(path.pop())

    for n in wanted or factors:
        visit(n)
    return out


def raw_descriptors(panel: DataFrame, windows: Windows = Windows(), wanted: list[str] | None = None, factors: dict[str, Factor] = FACTORS, **more) -> tuple[DataFrame, list[str]]:
    """The panel with the raw columns of the wanted factors, and the names of those columns."""
    df = with_blocks(excess(panel, windows), windows.longest)
    names = ordered(factors, wanted)
    before = set(df.columns)
    for n in names:
        df = factors[n].add(df, windows, more)
    return df.drop("__block", "__at"), [c for c in df.columns if c not in before]


def descriptors(panel: DataFrame, windows: Windows = Windows(), wanted: list[str] | None = None, **more) -> DataFrame:
    """``(trade_date, code, industry, ret, float_cap)`` and the standardised descriptors of the wanted factors."""
    df, names = raw_descriptors(panel, windows, wanted, **more)
    # Written once: the rolling windows are costly, and each step of the cross-sections reads the frame.
    df = staged(df.select("trade_date", "code", "industry", "ret", "float_cap", *names), "descriptors")
    df = standardize(df, names)
    if "lncap" in names:
        cubed = residual(df.withColumn("__c", F.pow("lncap", F.lit(3.0))), "__c", ["lncap"], "float_cap", "nlsize")
        df = standardize(cubed.drop("__c"), ["nlsize"])
    # Again, so that what follows carries a few columns and no sums of all descriptors.
    df = staged(df, "standardised")
    return df.withColumn("hsigma", F.col("sigma")) if {"sigma", "dastd"} <= set(names) else df


def style_table(described: DataFrame, styles: dict[str, dict[str, float]] = STYLES, orthogonal: dict[str, list[str]] = ORTHOGONAL, plain: bool = False) -> DataFrame:
    """``(trade_date, code, industry, ret, float_cap)`` and the styles whose descriptors are there."""
    found = {s: composed(described.columns, weights) for s, weights in styles.items()}
    made = [s for s, c in found.items() if c is not None]
    df = described.select("trade_date", "code", "industry", "ret", "float_cap", *[found[s].alias(s) for s in made])
    return orthogonalized(df, {s: refs for s, refs in ({} if plain else orthogonal).items() if s in made and all(r in made for r in refs)})
