"""Gram matrices and their elimination against dense solutions of each date's whole cross-section."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import gram, model

STYLES = [f"s{i}" for i in range(10)]
ROWS = "trade_date date, code string, industry string, ret double, float_cap double, " + ", ".join(f"{s} double" for s in STYLES)


def cross_sections(days=4, n=90, seed=5, holes=0.1):
    rng = np.random.default_rng(seed)
    rows = []
    for d in range(days):
        day = datetime.date(2024, 1, 1) + datetime.timedelta(d)
        for i in range(n):
            x = [None if rng.uniform() < holes else float(v) for v in rng.normal(size=10)]
            if d == 1:
                x[3] = None
            if d == 2:
                x[7] = x[2]
            rows.append((day, f"{i:03}", "ABCDE"[int(rng.integers(5))], float(rng.normal(0, 0.02)), float(rng.lognormal(3, 1)), *x))
    rows.append((rows[0][0], "x1", None, 0.1, 1.0, *[1.0] * 10))
    rows.append((rows[0][0], "x2", "A", None, 1.0, *[1.0] * 10))
    rows.append((rows[0][0], "x3", "A", 0.1, 0.0, *[1.0] * 10))
    return rows


def dense(rows):
    """Least squares on the whole design of each date, the constraint kept by leaving out an industry; least norm for styles that repeat."""
    out = {}
    for day in sorted({r[0] for r in rows}):
        of = [r for r in rows if r[0] == day and r[2] is not None and r[3] is not None and r[4] > 0]
        names = sorted({r[2] for r in of})
        have = [i for i in range(10) if any(r[5 + i] is not None for r in of)]
        if len(of) <= 1 + len(names) + len(have):
            continue
        w = np.sqrt([r[4] for r in of])
        w /= w.sum()
        d = np.array([[float(r[2] == x) for x in names] for r in of])
        x = np.column_stack([np.ones(len(of)), d, [[r[5 + i] or 0.0 for i in have] for r in of]])
        share = d.T @ w
        k = len(names)
        keep = np.zeros((x.shape[1], x.shape[1] - 1))
        keep[0, 0] = 1
        keep[1:k, 1:k] = np.eye(k - 1)
        keep[k, 1:k] = -share[:-1] / share[-1]
        keep[k + 1 :, k:] = np.eye(len(have))
        root = np.sqrt(w)[:, None]
        f = keep @ np.linalg.lstsq(root * (x @ keep), root[:, 0] * np.array([r[3] for r in of]), rcond=None)[0]
        for name, v in zip(["country", *names, *[STYLES[i] for i in have]], f, strict=True):
            out[str(day), name] = v
    return out


def test_many_styles_equal_the_dense_solve(spark):
    rows = cross_sections()
    got = {(str(r["trade_date"]), r["factor"]): r["value"] for r in model.factor_returns(spark.createDataFrame(rows, ROWS).repartition(5), STYLES).collect()}
    want = dense(rows)
    assert set(got) == set(want) and len(got) == 4 * 16 - 1
    repeated = {("2024-01-03", s) for s in STYLES}
    for key, v in want.items():
        if key[0] != "2024-01-03":
            assert got[key] == pytest.approx(v, abs=1e-9), key
    # Two styles that are the same share their return; what they earn together, and all else, is as in the dense solve.
    assert got["2024-01-03", "s2"] == pytest.approx(got["2024-01-03", "s7"], abs=1e-9)
    for key in set(want) - repeated:
        assert got[key] == pytest.approx(want[key], abs=1e-9), key
    for s in STYLES:
        assert got["2024-01-03", s] == pytest.approx(want["2024-01-03", s], abs=1e-9)


def test_few_rows_and_none(spark):
    rows = cross_sections(days=1, n=15)
    assert model.factor_returns(spark.createDataFrame(rows, ROWS), STYLES).count() == 0
    assert model.factor_returns(spark.createDataFrame([], ROWS), STYLES).count() == 0
    assert {r["factor_group"] for r in model.factor_returns(spark.createDataFrame(rows, ROWS), []).collect()} == {"country", "industry"}


def test_normal_equations_hold(spark):
    """What ten styles leave over is orthogonal to each of them, on dates that have enough rows."""
    df = spark.createDataFrame(cross_sections(days=2), ROWS)
    found = model.normal_residual(df, model.factor_returns(df, STYLES), STYLES).collect()
    assert len(found) == 2 and all(r["residual"] < 1e-12 for r in found)


def test_a_style_without_spread_within_industries(spark):
    """Such a style can't be told from the industries: the date gets the solution of the least norm instead of a quotient of rounding errors."""
    rows = [(*r[:5], float("ABCDE".index(r[2])), *r[6:]) for r in cross_sections(days=1) if r[2] is not None]
    got = {r["factor"]: r["value"] for r in model.factor_returns(spark.createDataFrame(rows, ROWS), STYLES).collect()}
    assert len(got) == 16 and max(abs(v) for v in got.values()) < 0.1
    assert model.factor_returns_native(spark.createDataFrame(rows, ROWS), STYLES).count() == 0


def test_elimination(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(size=(30, 6))
    g = a.T @ a
    right = rng.normal(size=6)
    df = spark.createDataFrame([([[*map(float, row), float(b)] for row, b in zip(g, right, strict=True)], [float(x) for x in np.diag(g)])], "m array<array<double>>, scale array<double>")
    got = df.select(gram.eliminate(F.col("m"), F.col("scale"), 6).alias("e")).select("e.*").first()
    assert [r[6] for r in got["m"]] == pytest.approx(np.linalg.solve(g, right).tolist(), abs=1e-12) and 0 < got["least"] <= 1
    flat = spark.createDataFrame([([[1.0, 1.0, 2.0], [1.0, 1.0, 2.0]], [1.0, 1.0])], "m array<array<double>>, scale array<double>")
    assert flat.select(gram.eliminate(F.col("m"), F.col("scale"), 2)["least"]).first()[0] == 0
