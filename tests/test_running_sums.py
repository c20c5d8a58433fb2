"""Windows as differences of running sums against sums over each window's own rows, moment by moment."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import rolling


def series(spark, n=700, codes=2, seed=0, holes=0.05):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(codes):
        x, y = rng.normal(0, 0.02, n), rng.normal(0, 0.02, n)
        for i in range(n):
            rows.append((i + 1 + 3 * c, f"c{c}", None if rng.uniform() < holes else float(x[i]), None if rng.uniform() < holes else float(y[i])))
    return rows, spark.createDataFrame(rows, "idx int, code string, x double, y double").repartition(4)


def values(df, columns):
    return {(r["code"], r["idx"]): [r[c] for c in columns] for r in df.collect()}


MOMENTS = {"x": "x", "xx": "x * x", "xy": "x * y", "n": "if(x is null, 0D, 1D)"}


@pytest.mark.parametrize("window,lag,rows,half_life", [(1, 0, 1, None), (21, 0, 21, None), (21, 0, 64, None), (60, 7, 64, None), (64, 100, 64, None), (252, 0, 252, 63.0), (50, 3, 300, 5.0), (252, 21, 504, 126.0)])
def test_each_moment(spark, window, lag, rows, half_life):
    data, df = series(spark)
    got = values(rolling.frame_sums(df, {k: (v, half_life) for k, v in MOMENTS.items()}, {f"s_{k}": (k, window, lag) for k in MOMENTS}, rows), [f"s_{k}" for k in MOMENTS])
    for code in ("c0", "c1"):
        own = [r for r in data if r[1] == code]
        x, y = (np.array([0.0 if r[k] is None else r[k] for r in own]) for k in (2, 3))
        terms = np.stack([x, x * x, np.where([r[2] is None or r[3] is None for r in own], 0.0, x * y), [float(r[2] is not None) for r in own]])
        for i, r in enumerate(own):
            lo, hi = max(0, i - lag - window + 1), max(0, i - lag + 1)
            w = np.ones(hi - lo) if half_life is None else 0.5 ** (np.arange(hi - lo)[::-1] / half_life)
            want = (terms[:, lo:hi] * w).sum(axis=1)
            # The bound of the docstring: rows of two blocks times the sum of sizes.
            near = np.abs(terms[:, max(0, i - 2 * rows - lag) : i + 1]).sum(axis=1)
            assert (np.abs(np.array(got[code, r[0]]) - want) <= 2 * rows * 2.0**-52 * near + 1e-300).all(), (code, i)


def test_an_old_outlier_is_forgotten(spark):
    """A running sum over the whole history would keep its rounding errors for ever."""
    rows = [(i + 1, "c", 1e12 if i == 10 else 0.01 * (i % 7)) for i in range(400)]
    df = spark.createDataFrame(rows, "idx int, code string, x double")
    got = values(rolling.frame_sums(df, {"xx": ("x * x", None)}, {"s": ("xx", 20, 0)}, 20), ["s"])
    for i in range(60, 400):
        assert got["c", i + 1][0] == pytest.approx(sum((0.01 * (j % 7)) ** 2 for j in range(i - 19, i + 1)), rel=1e-12)


def test_long_history(spark):
    """Half-life weights don't outgrow doubles: 3,000 half-lives."""
    df = spark.range(6000).select((F.col("id") + 1).cast("int").alias("idx"), F.lit("c").alias("code"), F.lit(2.0).alias("x"))
    last = rolling.with_deviation(rolling.with_strength(df, "s", "x", 20, 2.0, 3, 20), "d", "x", 20, 2.0).where("idx = 6000").first()
    assert last["s"] == pytest.approx(2.0, abs=1e-12) and last["d"] == pytest.approx(0, abs=1e-7)


def test_same_as_frames(spark):
    """Whole descriptors: the forms over running sums and over ROWS frames agree, guards included."""
    _, df = series(spark, n=300, holes=0.01)
    df = df.withColumn("p", F.abs("x"))
    both = rolling.with_deviation(df, "d1", "x", 40, 9.0, rows=64)
    both = rolling.with_range(both, "r1", "x", 5, 6, rows=64)
    both = rolling.with_strength(both, "s1", "x", 50, 12.0, 7, 45, rows=64)
    both = rolling.with_log_turnover(both, "p", {"t1": (21, 18, 1), "u1": (60, 50, 3)}, rows=64)
    direct = {"d2": rolling.weighted_deviation("x", 40, 9.0), "r2": rolling.cumulative_range("x", 5, 6), "s2": rolling.lagged_strength("x", 50, 12.0, 7, 45), "t2": rolling.log_turnover("p", 21, 18, 1), "u2": rolling.log_turnover("p", 60, 50, 3)}
    rows = both.withColumns(direct).collect()
    for c in "drstu":
        assert all((r[f"{c}1"] is None) == (r[f"{c}2"] is None) for r in rows) and any(r[f"{c}1"] is not None for r in rows)
        assert all(r[f"{c}1"] == pytest.approx(r[f"{c}2"], abs=1e-12) for r in rows if r[f"{c}1"] is not None), c


def test_blocks_must_hold_a_window(spark):
    _, df = series(spark, n=10)
    with pytest.raises(ValueError, match="shorter"):
        rolling.frame_sums(df, {"x": ("x", None)}, {"s": ("x", 30, 0)}, 20)
    assert rolling.with_range(df.limit(0), "r", "x", 2, 3).count() == 0


def test_one_shuffle(spark):
    """Running sums and what looks back share a shuffle by code."""
    _, df = series(spark, n=10)
    out = rolling.with_range(rolling.with_deviation(rolling.with_blocks(df, 12), "d", "x", 5, 2.0, rows=12), "r", "x", 2, 6, rows=12)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(code") == 1
