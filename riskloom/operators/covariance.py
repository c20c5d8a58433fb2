"""Covariance of factor returns: exponentially weighted, pairwise where values are missing, shrunk, and made positive semidefinite.

Variances forget faster than correlations, so the two have half-lives of their own.  Each date is a row of its factors' values, which are few;
pairs are made within it and summed map-side, so nothing but sums, factors squared in number, is ever together.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Eigenvalues of the correlations below this share of the largest are raised to it.
FLOOR = 1e-10


def positive(corr: np.ndarray, floor: float = FLOOR) -> np.ndarray:
    """The correlations themselves where no eigenvalue is too low, else with low ones raised and the diagonal brought back to 1."""
    values, vectors = np.linalg.eigh(corr)
    least = floor * max(values[-1], 0.0)
    if values[0] >= -least:
        return corr
    fixed = (vectors * np.maximum(values, least)) @ vectors.T
    root = np.sqrt(np.diag(fixed))
    return fixed / root / root[:, None]


def factor_covariance(returns: DataFrame, variance_half_life: float = 90, correlation_half_life: float = 250, shrinkage: float = 0.0, least_dates: int = 2) -> DataFrame:
    """``(factor_a, factor_b, n, correlation, covariance)`` for factor_a <= factor_b, from ``returns(trade_date, factor, value)``.

    Weights halve with every half-life of dates (of all factors) before the last.  A pair counts the dates that both have, ``n`` of them; with fewer
    than ``least_dates``, or where one of them doesn't vary there, it is uncorrelated.  A factor with fewer than ``least_dates`` values
    is left out.  ``shrinkage`` draws correlations to 0.  What isn't positive semidefinite then, as pairs of different dates needn't be, is repaired.
    Null values count as missing; of several values of a factor and date the largest counts; no rows give none.
    """
    values = returns.where(F.col("value").isNotNull()).groupBy("trade_date", "factor").agg(F.max("value").alias("value"))
    days = values.groupBy("trade_date").agg(F.sort_array(F.collect_list(F.struct("factor", "value"))).alias("f"))
    # Dates are few, whatever the number of securities, so one task numbers them.
    age = (F.row_number().over(Window.orderBy(F.desc("trade_date"))) - 1).cast("double")
    days = days.withColumn("age", age).withColumns({"v": F.pow(F.lit(0.5), F.col("age") / variance_half_life), "c": F.pow(F.lit(0.5), F.col("age") / correlation_half_life)})
    pairs = days.select("v", "c", "f", F.posexplode("f").alias("i", "a")).select("v", "c", "a", F.explode(F.expr("slice(f, i + 1, size(f))")).alias("b"))
    a, b, c, v = F.col("a.value"), F.col("b.value"), F.col("c"), F.col("v")
    sums = {"n": F.count("*"), "w": F.sum(c), "sa": F.sum(c * a), "sb": F.sum(c * b), "saa": F.sum(c * a * a), "sbb": F.sum(c * b * b), "sab": F.sum(c * a * b), "u": F.sum(v), "t": F.sum(v * a), "tt": F.sum(v * a * a)}
    found = pairs.groupBy(F.col("a.factor").alias("factor_a"), F.col("b.factor").alias("factor_b")).agg(*[x.alias(k) for k, x in sums.items()])
    own = lambda x, xx, w: F.greatest(F.col(xx) / F.col(w) - F.col(x) / F.col(w) * F.col(x) / F.col(w), F.lit(0.0))
    joint = F.col("sab") / F.col("w") - F.col("sa") / F.col("w") * F.col("sb") / F.col("w")
    root = F.sqrt(own("sa", "saa", "w") * own("sb", "sbb", "w"))
    r = F.when(F.col("n") >= least_dates, F.try_divide(joint, root))
    found = found.select("factor_a", "factor_b", "n", F.when(F.col("factor_a") == F.col("factor_b"), 1.0).otherwise((1 - shrinkage) * F.coalesce(r, F.lit(0.0))).alias("r"), own("t", "tt", "u").alias("variance"))

    def repaired(df: pd.DataFrame) -> pd.DataFrame:
        alone = df[(df["factor_a"] == df["factor_b"]) & (df["n"] >= least_dates)]
        names = sorted(alone["factor_a"])
        at = {x: i for i, x in enumerate(names)}
        deviation = np.sqrt(alone.set_index("factor_a")["variance"].reindex(names).to_numpy())
        corr, n = np.eye(len(names)), np.zeros((len(names), len(names)), dtype=np.int64)
        for p, q, k, x in zip(df["factor_a"], df["factor_b"], df["n"], df["r"], strict=True):
            if p in at and q in at:
                corr[at[p], at[q]] = corr[at[q], at[p]] = x
                n[at[p], at[q]] = k
        if not names:
            return pd.DataFrame(columns=["factor_a", "factor_b", "n", "correlation", "covariance"])
        corr = positive(corr)
        i, j = np.triu_indices(len(names))
        return pd.DataFrame({"factor_a": np.array(names, dtype=object)[i], "factor_b": np.array(names, dtype=object)[j], "n": n[i, j], "correlation": corr[i, j], "covariance": corr[i, j] * deviation[i] * deviation[j]})

    # The one group is the matrix: a row for each pair of factors.
    return found.groupBy().applyInPandas(repaired, "factor_a string, factor_b string, n long, correlation double, covariance double")
