"""Regression from distributed Gram matrices: sums of products made map-side, and their elimination on arrays.

A cross-section never meets in one place.  Each group's products are plain sums, combined before they are shuffled, and what travels is
one row a group, whatever the number of its members; the normal equations are then solved inside a row by higher-order functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A pivot below this share of its column's own square is no longer trusted: such equations need the least-norm solution.
WEAK_PIVOT = 1e-8


def centred_products(df: DataFrame, by: list[str], weight: str, xs: list[str], y: str) -> DataFrame:
    """For each group ``(*by, w, n, have, m, g)``: weights' sum, rows, how many values each x has, weighted means of xs and y (nulls of an x are
    0), and ``g[i][j]``, the weighted products of x i with x j and, last, with y, less their means.
    """
    w = F.col(weight)
    at = {c: F.coalesce(c, F.lit(0.0)) for c in xs} | {y: F.col(y)}
    pairs = [(a, b) for i, a in enumerate(xs) for b in [*xs[i:], y]]
    sums = df.groupBy(*by).agg(
        F.sum(w).alias("w"), F.count("*").alias("n"), *[F.count(x).alias(f"__n{i}") for i, x in enumerate(xs)], *[F.sum(w * v).alias(f"__m_{c}") for c, v in at.items()],
        *[F.sum(w * at[a] * at[b]).alias(f"__g_{a}_{b}") for a, b in pairs],
    )
    mean = lambda c: F.col(f"__m_{c}") / F.col("w")
    product = {(a, b): F.col(f"__g_{a}_{b}") - F.col(f"__m_{a}") * mean(b) for a, b in pairs}
    rows = [F.array(*[product[(a, b) if (a, b) in product else (b, a)] for b in [*xs, y]]) for a in xs]
    none = F.array().cast("array<bigint>")
    return sums.select(
        *by, "w", "n", (F.array(*[F.col(f"__n{i}") for i in range(len(xs))]) if xs else none).alias("have"), F.array(*[mean(c) for c in at]).alias("m"),
        (F.array(*rows) if rows else F.array().cast("array<array<double>>")).alias("g"),
    )


def added(arrays: Column, start: Column) -> Column:
    """Sum of an array of arrays, element by element."""
    return F.aggregate(arrays, start, lambda a, b: F.zip_with(a, b, lambda x, y: x + y))


def zeros(n: int) -> Column:
    return F.array_repeat(F.lit(0.0), n)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def eliminate(rows: Column, scale: Column, n: int) -> Column:
    """``struct<m, least>``: the augmented matrix ``rows`` (n rows, n + 1 columns or more) with its first n columns made unit ones, and the least
    pivot as a share of ``scale``, 0 where one vanishes.  Meant for positive definite equations, which need no exchange of rows."""

    def step(state: Column, k: Column) -> Column:
        m = state["m"]
        top = F.get(m, k)
        pivot = F.get(top, k)
        cleared = F.transform(
            m, lambda row, i: F.when(i == k, F.transform(row, lambda v: F.try_divide(v, pivot))).otherwise(F.zip_with(row, top, lambda v, p: v - F.try_divide(F.get(row, k) * p, pivot)))
        )
        share = F.coalesce(F.try_divide(pivot, F.get(scale, k)), F.lit(0.0))
        return F.struct(cleared.alias("m"), F.least(state["least"], share).alias("least"))

    start = F.struct(rows.alias("m"), F.lit(1.0).alias("least"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(n - 1)), start, step) if n else start
