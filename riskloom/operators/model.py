"""Style composition and factor returns."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.numeric import ratio, total
from riskloom.operators.gram import WEAK_PIVOT, added, centred_products, dot, eliminate, zeros
from riskloom.operators.xsection import day, with_days
from riskloom.sources.staging import staged

#: Directions of the normal equations that are weaker than the strongest by this are left out.
CONDITION_LIMIT = 1e10


def composed(columns: list[str], weights: dict[str, float]) -> Column | None:
    """Weighted sum of the descriptors among ``columns``; null if one of them is.  Absent ones add nothing, and weights stay."""
    have = {d: w for d, w in weights.items() if d in columns}
    return total([F.col(d) * w for d, w in have.items()]) if have else None


def compose(df: DataFrame, style: str, weights: dict[str, float]) -> DataFrame:
    """The frame with a style, if it has any of its descriptors."""
    made = composed(df.columns, weights)
    return df if made is None else df.withColumn(style, made)


def estimation_sample(df: DataFrame, industry: str = "industry", ret: str = "ret", cap: str = "float_cap") -> DataFrame:
    """Rows with an industry, a return and a positive capitalisation."""
    return df.where(F.col(industry).isNotNull() & F.col(ret).isNotNull() & (F.col(cap) > 0))


def root_cap(cap: str) -> Column:
    return F.sqrt(F.when(F.col(cap) >= 0, F.col(cap)))


def industry_weights(df: DataFrame, industry: str = "industry", cap: str = "float_cap") -> DataFrame:
    """Each industry's share of the root-cap weights, per date."""
    sums = df.groupBy("trade_date", industry).agg(F.sum(root_cap(cap)).alias("__w"))
    return sums.select("trade_date", industry, ratio(F.col("__w"), F.sum("__w").over(day())).alias("weight"))


def normal_equations(cells: list, have: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matrix and right side for [country, industries, styles], and the industries' weights, of one date's cells."""
    w = np.array([c["w"] for c in cells], dtype=float)
    w /= w.sum()
    total = sum(c["w"] for c in cells)
    m = np.array([list(c["m"]) for c in cells], dtype=float)
    g = sum(np.array([list(r) for r in c["g"]], dtype=float).reshape(-1, m.shape[1]) for c in cells) / total
    styles, ret = m[:, have], m[:, -1]
    top = w @ styles
    x = np.block([
        [np.ones((1, 1)), w[None, :], top[None, :]], [w[:, None], np.diag(w), w[:, None] * styles],
        [top[:, None], (w[:, None] * styles).T, g[np.ix_(have, have)] + (styles.T * w) @ styles],
    ])
    return x, np.concatenate([[w @ ret], w * ret, g[have, -1] + styles.T @ (w * ret)]), w


def least_norm(x: np.ndarray, right: np.ndarray, by_industry: np.ndarray) -> np.ndarray | None:
    """Returns of [country, industries, styles] from normal equations, industry returns adding up to 0 by weight.

    The constraint has a Lagrange multiplier: the equations, bordered by the constraint's row and column, have one solution
    although the industries add up to the country; that of the least norm is taken where styles repeat each other.
    """
    k = len(x)
    bordered, side = np.zeros((k + 1, k + 1)), np.zeros(k + 1)
    bordered[:k, :k], side[:k] = x, right
    bordered[k, 1 : 1 + len(by_industry)] = bordered[1 : 1 + len(by_industry), k] = by_industry
    if not (np.isfinite(bordered).all() and np.isfinite(side).all()):
        return None
    return np.linalg.lstsq(bordered, side, rcond=1 / CONDITION_LIMIT)[0][:k]


def date_equations(df: DataFrame, styles: list[str], industry: str = "industry", ret: str = "ret", cap: str = "float_cap", every: bool = False) -> DataFrame:
    """One row a date that has more rows than factors: its industries' cells, which styles it has, their returns, and the least pivot.

    With ``every``, styles that the date lacks count as factors, too, when rows are held against them.
    Styles and returns are taken less their industry means, so only the styles' own equations are left to solve.
    A date's row holds a cell for each industry, whatever the number of securities.
    """
    sample = estimation_sample(df, industry, ret, cap).select("trade_date", F.col(industry).alias("industry"), F.col(ret).alias("ret"), F.sqrt(cap).alias("root"), *styles)
    cells = centred_products(sample, ["trade_date", "industry"], "root", styles, "ret")
    s = len(styles)
    days = cells.groupBy("trade_date").agg(F.sum("n").alias("n"), F.sum("w").alias("w"), F.sort_array(F.collect_list(F.struct("industry", "w", "m", "g", "have"))).alias("cells"))
    counted = F.aggregate("cells", F.array_repeat(F.lit(0).cast("bigint"), s), lambda a, c: F.zip_with(a, c["have"], lambda x, y: x + y))
    days = days.withColumn("have", F.transform(counted, lambda x: x > 0))
    days = days.where(F.col("n") > 1 + F.size("cells") + (F.lit(s) if every else F.size(F.filter("have", lambda x: x))))
    w = F.col("w")
    g = F.aggregate("cells", F.array_repeat(zeros(s + 1), s), lambda a, c: F.zip_with(a, c["g"], lambda x, y: F.zip_with(x, y, lambda u, v: u + v)))
    square = added(F.transform("cells", lambda c: F.transform(F.slice(c["m"], 1, s), lambda m: c["w"] * m * m)), zeros(s)) if s else zeros(0)
    days = days.withColumns({"g": F.transform(g, lambda row: F.transform(row, lambda v: v / w)), "square": F.transform(square, lambda v: v / w)})
    # A style that the date lacks gets an equation of its own, with 0 for a solution.
    there = lambda i: F.coalesce(F.get("have", i), F.lit(False))
    rows = F.transform("g", lambda row, i: F.transform(row, lambda v, j: F.when(there(i) & (there(j) | (j == s)), v).when(i == j, F.lit(1.0)).otherwise(F.lit(0.0))))
    scale = F.transform("g", lambda row, i: F.when(there(i), F.get(row, i) + F.get("square", i)).otherwise(F.lit(1.0)))
    solved = days.withColumn("solved", eliminate(rows, scale, s))
    return solved.select("trade_date", "n", "w", "cells", "have", F.transform("solved.m", lambda row: F.get(row, F.lit(s))).alias("f"), F.col("solved.least").alias("least"))


RETURNS = "trade_date date, factor_group string, factor string, value double"


def factor_returns(df: DataFrame, styles: list[str], industry: str = "industry", ret: str = "ret", cap: str = "float_cap") -> DataFrame:
    """``(trade_date, factor_group, factor, value)`` of the constrained regression of each date, for any number of styles.

    Styles that are null for the whole sample of a date leave it; other nulls are neutral (0).  A date with no more
    rows than factors gives none.  Dates whose styles repeat each other (a pivot below WEAK_PIVOT) get the solution of the least norm, from
    the same sums: a group then is the date's industries.  The equations, a row a date, are written once.
    """
    days = staged(date_equations(df, styles, industry, ret, cap), "equations")
    return _eliminated(days, styles).unionByName(_least_norms(days, styles)) if styles else _eliminated(days, styles)


def factor_returns_native(df: DataFrame, styles: list[str], industry: str = "industry", ret: str = "ret", cap: str = "float_cap") -> DataFrame:
    """The same without Python, for dates with more rows than all factors asked for; dates whose styles repeat each other are left out."""
    return _eliminated(date_equations(df, styles, industry, ret, cap, every=True), styles)


def _eliminated(days: DataFrame, styles: list[str]) -> DataFrame:
    """Returns of the dates whose equations were eliminated: what the styles leave over makes the country and the industries."""
    s = len(styles)
    rest = lambda c: F.get(c["m"], F.lit(s)) - (dot(F.col("f"), F.slice(c["m"], 1, s)) if s else 0)
    rows = days.where(F.col("least") >= WEAK_PIVOT).withColumn("rest", F.transform("cells", rest))
    rows = rows.withColumn("country", dot(F.transform("cells", lambda c: c["w"] / F.col("w")), F.col("rest")))
    row = lambda group, factor, value: F.struct(F.lit(group).alias("factor_group"), factor.alias("factor"), value.alias("value"))
    parts = [F.array(row("country", F.lit("country"), F.col("country"))), F.zip_with("cells", "rest", lambda c, r: row("industry", c["industry"], r - F.col("country")))]
    if s:
        every = F.zip_with(F.lit(styles), F.col("f"), lambda name, value: row("style", name, value))
        parts.append(F.filter(every, lambda _, i: F.get("have", i)))
    return rows.select("trade_date", F.inline(F.concat(*parts)))


def _least_norms(days: DataFrame, styles: list[str]) -> DataFrame:
    def one_day(day: pd.DataFrame) -> pd.DataFrame:
        cells, have = list(day["cells"].iloc[0]), [i for i, x in enumerate(day["have"].iloc[0]) if x]
        found = least_norm(*normal_equations(cells, have))
        groups = ["country"] + ["industry"] * len(cells) + ["style"] * len(have)
        factors = ["country", *[c["industry"] for c in cells], *[styles[i] for i in have]]
        made = {"trade_date": day["trade_date"].iloc[0], "factor_group": groups, "factor": factors, "value": np.nan if found is None else found}
        return pd.DataFrame(made).iloc[: 0 if found is None else None]

    weak = days.where(~(F.col("least") >= WEAK_PIVOT)).select("trade_date", "cells", "have")
    return weak.groupBy("trade_date").applyInPandas(one_day, RETURNS)


def constraint_residual(returns: DataFrame, weights: DataFrame) -> DataFrame:
    """Per date: the weighted sum of industry returns, 0 up to rounding."""
    own = returns.where("factor_group = 'industry'").join(weights.withColumnRenamed("industry", "factor"), ["trade_date", "factor"])
    return own.groupBy("trade_date").agg(F.sum(F.col("weight") * F.col("value")).alias("residual"))


def normal_residual(df: DataFrame, returns: DataFrame, styles: list[str], cap: str = "float_cap") -> DataFrame:
    """Per date: the greatest weighted sum of what the factors leave over, by industry or times a style; all are 0 up to rounding."""
    sample = with_days(estimation_sample(df, cap=cap), {"__total": F.sum(root_cap(cap))}).withColumn("__w", ratio(root_cap(cap), F.col("__total")))
    wide = returns.where("factor_group <> 'industry'").groupBy("trade_date").agg(*[F.max(F.when(F.col("factor") == f, F.col("value"))).alias(f"f_{f}") for f in ["country", *styles]])
    own = returns.where("factor_group = 'industry'").select("trade_date", F.col("factor").alias("industry"), F.col("value").alias("__i"))
    left = F.col("ret") - F.col("f_country") - F.col("__i")
    for s in styles:
        left = left - F.coalesce(F.col(f"f_{s}"), F.lit(0.0)) * F.coalesce(s, F.lit(0.0))
    rows = sample.join(F.broadcast(wide), "trade_date").join(F.broadcast(own), ["trade_date", "industry"]).withColumn("__e", F.col("__w") * left)
    # A style that is null for a whole date has no factor.
    sums = rows.groupBy("trade_date", "industry").agg(F.sum("__e").alias("e"), *[F.sum(F.when(F.col(f"f_{s}").isNotNull(), F.col("__e") * F.coalesce(s, F.lit(0.0))).otherwise(0.0)).alias(f"e_{s}") for s in styles])
    return sums.groupBy("trade_date").agg(F.greatest(F.max(F.abs("e")), F.lit(0.0), *[F.abs(F.sum(f"e_{s}")) for s in styles]).alias("residual"))


def country_identity(df: DataFrame, returns: DataFrame, styles: list[str], cap: str = "float_cap") -> DataFrame:
    """Per date: the country return, and the weighted mean return less what the styles' mean exposures earn; the two agree."""
    mean = lambda x: ratio(F.sum(root_cap(cap) * x), F.sum(root_cap(cap)))
    means = estimation_sample(df, cap=cap).groupBy("trade_date").agg(mean(F.col("ret")).alias("mean_return"), *[mean(F.coalesce(s, F.lit(0.0))).alias(s) for s in styles])
    earned = returns.where("factor_group = 'style'").join(means.unpivot(["trade_date"], styles, "factor", "exposure"), ["trade_date", "factor"])
    earned = earned.groupBy("trade_date").agg(F.sum(F.col("value") * F.col("exposure")).alias("earned"))
    country = returns.where("factor_group = 'country'").select("trade_date", F.col("value").alias("country"))
    out = country.join(means.select("trade_date", "mean_return"), "trade_date").join(earned, "trade_date", "left")
    return out.select("trade_date", "country", (F.col("mean_return") - F.coalesce("earned", F.lit(0.0))).alias("implied"))
