"""Factor covariance against plain numpy, with missing values and matrices that need repair."""

import datetime

import numpy as np
import pytest

from riskloom.operators import covariance

SCHEMA = "trade_date date, factor string, value double"


def rows_of(x, names):
    day = datetime.date(2024, 1, 1)
    return [(day + datetime.timedelta(i), n, None if np.isnan(v) else float(v)) for i, r in enumerate(x) for n, v in zip(names, r, strict=True)]


def matrix(df, names, column="covariance"):
    out = np.full((len(names), len(names)), np.nan)
    for r in df.collect():
        i, j = names.index(r["factor_a"]), names.index(r["factor_b"])
        out[i, j] = out[j, i] = r[column]
    return out


def plain(x, hv, hc, shrink=0.0):
    age = np.arange(len(x))[::-1]
    k = x.shape[1]
    corr, var = np.eye(k), np.zeros(k)
    for i in range(k):
        ok = ~np.isnan(x[:, i])
        w = 0.5 ** (age[ok] / hv)
        var[i] = np.average((x[ok, i] - np.average(x[ok, i], weights=w)) ** 2, weights=w)
        for j in range(i):
            ok = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            w = 0.5 ** (age[ok] / hc)
            a, b = (x[ok, c] - np.average(x[ok, c], weights=w) for c in (i, j))
            corr[i, j] = corr[j, i] = (1 - shrink) * np.average(a * b, weights=w) / np.sqrt(np.average(a * a, weights=w) * np.average(b * b, weights=w))
    return corr, np.sqrt(var)


@pytest.mark.parametrize("shrink", [0.0, 0.2])
def test_pairs(spark, shrink):
    rng = np.random.default_rng(0)
    x = rng.normal(0, 0.01, size=(300, 5)) @ rng.normal(size=(5, 5))
    x[:120, 3] = np.nan
    x[rng.uniform(size=x.shape) < 0.05] = np.nan
    names = list("abcde")
    df = spark.createDataFrame(rows_of(x, names), SCHEMA).repartition(3)
    got = covariance.factor_covariance(df, 40, 90, shrink)
    corr, dev = plain(x, 40, 90, shrink)
    assert np.linalg.eigvalsh(corr)[0] > 0
    assert matrix(got, names, "correlation") == pytest.approx(corr, abs=1e-12)
    assert matrix(got, names) == pytest.approx(corr * dev * dev[:, None], abs=1e-14)


def test_repair(spark):
    """Pairs that never meet on the same dates can contradict each other."""
    rng = np.random.default_rng(1)
    x = np.full((90, 3), np.nan)
    z = rng.normal(size=90)
    x[:30, 0] = x[:30, 1] = z[:30]
    x[30:60, 1] = x[30:60, 2] = z[30:60]
    x[60:, 0], x[60:, 2] = z[60:], -z[60:]
    names = list("abc")
    corr, dev = plain(x, 90, 250)
    assert np.linalg.eigvalsh(corr)[0] < -0.5
    out = covariance.factor_covariance(spark.createDataFrame(rows_of(x, names), SCHEMA)).cache()
    got = matrix(out, names, "correlation")
    assert np.linalg.eigvalsh(got)[0] > -1e-12 and np.diag(got) == pytest.approx(np.ones(3), abs=1e-12)
    assert np.sqrt(np.diag(matrix(out, names))) == pytest.approx(dev, rel=1e-12)


def test_edges(spark):
    x = np.array([[1.0, 2.0, 5.0], [2.0, 2.0, np.nan], [4.0, 2.0, np.nan]])
    got = {(r["factor_a"], r["factor_b"]): r for r in covariance.factor_covariance(spark.createDataFrame(rows_of(x, list("abc")), SCHEMA)).collect()}
    assert set(got) == {("a", "a"), ("a", "b"), ("b", "b")}  # one value isn't enough
    assert got["a", "b"]["covariance"] == 0 and got["b", "b"]["covariance"] == pytest.approx(0, abs=1e-15)
    assert covariance.factor_covariance(spark.createDataFrame([], SCHEMA)).count() == 0
