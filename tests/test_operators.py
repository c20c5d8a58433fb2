"""Rules of single operators on small tables, and invariants of whole ones."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskloom.functions import codes, dates
from riskloom.operators import attribution, exposure, model, panel, performance, rolling, xsection
from riskloom.plans import descriptors as d

DAY0 = dt.date(2024, 1, 1)


def day(i):
    return DAY0 + dt.timedelta(days=i)


def series(spark, values, code="a", name="x"):
    rows = [(day(i), i + 1, code, None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"trade_date date, idx int, code string, {name} double")


def column(df, name, order="trade_date"):
    return [r[name] for r in df.orderBy(order).collect()]


def section(spark, rows, schema="code string, x double, float_cap double"):
    return spark.createDataFrame(rows, schema).withColumn("trade_date", F.lit(DAY0))


# --- panel
def test_upsert_keeps_old_value_under_new_null(spark):
    old = spark.createDataFrame([(day(1), "a", 1.0), (day(2), "a", 2.0)], "trade_date date, code string, x double")
    new = spark.createDataFrame([(day(2), "a", None), (day(3), "a", 5.0)], "trade_date date, code string, x double")
    assert column(panel.upsert(old, new), "x") == [1.0, 2.0, 5.0]


def test_upsert_unites_columns(spark):
    old = spark.createDataFrame([(day(1), "a", 1.0)], "trade_date date, code string, x double")
    new = spark.createDataFrame([(day(1), "a", 7.0)], "trade_date date, code string, y double")
    assert [tuple(r) for r in panel.upsert(old, new).select("x", "y").collect()] == [(1.0, 7.0)]


def test_keep_largest(spark):
    df = spark.createDataFrame([(day(1), "a", 1.0), (day(1), "a", 3.0), (day(1), "a", None)], "trade_date date, code string, x double")
    assert column(panel.keep_largest(df, "x"), "x") == [3.0]


def test_align_drops_dates_that_are_not_wanted_before_filling(spark):
    s = spark.createDataFrame([(day(0), 1.0), (day(2), 9.0)], "trade_date date, rf double")
    wanted = spark.createDataFrame([(day(0),), (day(1),), (day(3),)], "trade_date date")
    assert column(panel.align(s, wanted, ["rf"]), "rf") == [1.0, 1.0, 1.0]
    assert column(panel.align(s, wanted, ["rf"], None), "rf") == [1.0, None, None]


def test_interior_fill(spark):
    df = panel.interior_fill(series(spark, [None, 1, None, 2, None]), {"y": "x"})
    assert column(df, "y") == [None, 1.0, 0.0, 2.0, None]


def test_merge_columns_and_wide(spark):
    a = spark.createDataFrame([(day(0), "a", 1.0)], "trade_date date, code string, x double")
    b = spark.createDataFrame([(day(0), "a", 2.0), (day(0), "b", 3.0)], "trade_date date, code string, y double")
    assert sorted(tuple(r)[1:] for r in panel.merge_columns([a, b]).collect()) == [("a", 1.0, 2.0), ("b", None, 3.0)]
    assert panel.to_wide(b, "y").columns == ["trade_date", "a", "b"]


def test_require_keys(spark):
    have = spark.createDataFrame([(day(0),)], "trade_date date")
    panel.require_keys(have, have)
    with pytest.raises(ValueError, match="missing trade_date"):
        panel.require_keys(spark.createDataFrame([(day(5),)], "trade_date date"), have)


def test_nan_becomes_null(spark):
    assert column(panel.nan_to_null(series(spark, [math.nan, 1])), "x") == [None, 1.0]


# --- codes and dates
def test_codes(spark):
    df = spark.createDataFrame([("600000",), ("000001",), ("300001",), ("430001",), ("830001",), ("900001",)], "c string")
    assert [r[0][6:] for r in df.select(codes.with_suffix(F.col("c"))).collect()] == [".XSHG", ".XSHE", ".XSHE", ".XBJG", ".XBJG", ""]
    df = spark.createDataFrame([("600000.SH",), ("1.SZ",), ("2.BJ",), ("3.HK",), (None,)], "c string")
    there = df.select(codes.to_vendor(F.col("c")).alias("c"))
    assert [r[0] for r in there.collect()] == ["600000.XSHG", "1.XSHE", "2.XBJG", "3.HK", None]
    assert [r[0] for r in there.select(codes.to_terminal(F.col("c"))).collect()] == [r[0] for r in df.collect()]


def test_account_codes(spark):
    df = spark.createDataFrame([("11020101600000",), ("11020199600000",), ("1102C101688001",), ("31020101000001",)], "a string")
    assert [r[0] for r in df.select(codes.is_stock_account(F.col("a"))).collect()] == [True, False, True, False]


def test_report_date(spark):
    df = spark.createDataFrame([(dt.date(2024, 4, 30),), (dt.date(2024, 5, 1),)], "d date")
    assert [r[0] for r in df.select(dates.report_effective_date(F.col("d"))).collect()] == [dt.date(2023, 4, 30), dt.date(2024, 4, 30)]


# --- rolling
def test_rolling_wls_against_numpy(spark):
    rng = np.random.default_rng(0)
    n, w, h = 40, 12, 5.0
    x, y = rng.normal(size=n), rng.normal(size=n)
    rows = [(i + 1, "a", float(y[i]), float(x[i])) for i in range(n)]
    df = rolling.rolling_wls(spark.createDataFrame(rows, "idx int, code string, y double, x double"), "y", "x", w, h, 2)
    got = df.orderBy("idx").collect()
    k = 0.5 ** (np.arange(w)[::-1] / h)
    k /= k.sum()
    for i in range(n):
        if i < w - 1:
            assert got[i]["beta"] is None
            continue
        a, b = x[i - w + 1 : i + 1], y[i - w + 1 : i + 1]
        slope = (k @ (a * b) - (k @ a) * (k @ b)) / (k @ (a * a) - (k @ a) ** 2)
        rest = b - slope * a - (k @ b - slope * (k @ a))
        assert got[i]["beta"] == pytest.approx(slope, abs=1e-12)
        assert got[i]["sigma"] == pytest.approx(rest.std(ddof=1), abs=1e-12)


@pytest.mark.parametrize("missing,null", [(2, False), (3, True)])
def test_rolling_wls_missing(spark, missing, null):
    rows = [(i + 1, "a", None if i < missing else float(i * i), float(i)) for i in range(8)]
    df = rolling.rolling_wls(spark.createDataFrame(rows, "idx int, code string, y double, x double"), "y", "x", 8, 4, 2)
    assert (df.where("idx = 8").first()["beta"] is None) == null


def test_momentum_edge(spark):
    w, lag, least = 10, 2, 8
    for gap, null in ((0, False), (1, True)):
        values = [None if i < gap else 0.1 * (i + 1) for i in range(12)]
        out = column(series(spark, values).withColumn("m", rolling.lagged_strength("x", w, 4, lag, least)), "m")
        assert out[: w - 1] == [None] * (w - 1)
        assert (out[9] is None) == null
        k = 0.5 ** (np.arange(w)[::-1] / 4)
        if not null:
            assert out[11] == pytest.approx(float(np.dot(k / k.sum(), np.array(values[:10], dtype=float))), abs=1e-12)


def test_liquidity_counts(spark):
    for have, null in ((18, False), (17, True)):
        df = series(spark, [1.0 if i < have else None for i in range(21)]).withColumn("s", rolling.log_turnover("x", 21, 18, 1))
        assert (column(df, "s")[-1] is None) == null
    assert column(series(spark, [0] * 21).withColumn("s", rolling.log_turnover("x", 21, 18, 1)), "s")[-1] is None


def test_range_and_deviation(spark):
    x = [0.01, -0.02, 0.03, 0.01, -0.01, 0.02]
    df = series(spark, x).withColumns({"r": rolling.cumulative_range("x", 2, 3), "s": rolling.weighted_deviation("x", 6, 3)})
    z = [sum(x[-2 * t :]) for t in (1, 2, 3)]
    k = 0.5 ** (np.arange(6)[::-1] / 3)
    k /= k.sum()
    assert column(df, "r")[-1] == pytest.approx(max(z) - min(z))
    assert column(df, "s")[-1] == pytest.approx(math.sqrt(k @ (np.array(x) - k @ np.array(x)) ** 2))
    holes = series(spark, [*x[:3], None, *x[4:]]).withColumns({"r": rolling.cumulative_range("x", 2, 3), "s": rolling.weighted_deviation("x", 6, 3)})
    assert column(holes, "r")[-1] is None and column(holes, "s")[-1] is None


def test_cumulative_return(spark):
    w = Window.partitionBy("code").orderBy("idx")
    out = column(series(spark, [0.1, None, -0.5, -1.0, 0.2]).withColumn("c", rolling.cumulative_return("x", w)), "c")
    assert out == [pytest.approx(0.1), None, pytest.approx(-0.45), -1.0, -1.0]


def test_losing_streak(spark):
    df = series(spark, [1, 0, 0, 1, 0]).withColumn("win", F.col("x") > 0)
    assert column(rolling.losing_streak(df, "win", "code", "idx"), "streak") == [0, 1, 2, 0, 1]


def test_report_trend(spark):
    rows = [("a", y, float(e), float(r)) for y, e, r in [(2015, 1, 10), (2016, 2, 11), (2018, 3, 12), (2019, 4, 13), (2020, 5, 14)]]
    rows += [("b", y, 1.0, None if y == 2017 else 2.0) for y in range(2015, 2020)] + [("c", y, float(y - 2017), 1.0) for y in range(2015, 2020)]
    out = rolling.report_trend(spark.createDataFrame(rows, "code string, year int, eps double, revenue double"), {"e": "eps", "r": "revenue"})
    got = {r["code"]: (r["e"], r["r"]) for r in out.where("year = 2020 or (code <> 'a' and year = 2019)").collect()}
    x, y = np.array([2015, 2016, 2018, 2019, 2020.0]), np.arange(1, 6.0)
    assert got["a"][0] == pytest.approx(np.polyfit(x, y, 1)[0] / 3)
    assert got["b"] == (None, None)
    assert got["c"] == (None, 0.0)


# --- cross-section
def test_standardize(spark):
    rng = np.random.default_rng(1)
    x = np.append(rng.normal(size=15), 40.0)
    cap = rng.uniform(1, 5, size=16)
    out = xsection.standardize(section(spark, [(f"{i:02}", float(a), float(c)) for i, (a, c) in enumerate(zip(x, cap, strict=True))]), ["x"])
    got = np.array(column(out, "x", "code"))
    w = cap / cap.sum()
    m, s = w @ x, x.std(ddof=1)
    clipped = np.clip(x, m - 3 * s, m + 3 * s)
    assert clipped[-1] < 40
    np.testing.assert_allclose(got, (clipped - m) / clipped.std(ddof=1), atol=1e-12)
    assert got.std(ddof=1) == pytest.approx(1)


def test_standardize_does_not_renormalise(spark):
    out = xsection.standardize(section(spark, [("a", 1.0, 1.0), ("b", 3.0, 1.0), ("c", None, 2.0)]), ["x"])
    # mean (1 + 3) / 4 = 1, deviation sqrt 2
    assert column(out, "x", "code") == [pytest.approx(0.0), pytest.approx(math.sqrt(2)), None]


@pytest.mark.parametrize("rows", [[("a", 1.0, 1.0)], [("a", 2.0, 1.0), ("b", 2.0, 1.0)], [("a", None, 1.0), ("b", None, 1.0)]])
def test_standardize_degenerate(spark, rows):
    assert set(column(xsection.standardize(section(spark, rows), ["x"]), "x", "code")) == {None}


def test_no_cross_section_meets_in_one_task(spark):
    """Standardising, residuals and the normal equations take a date's sums map-side: no window gathers its rows, and a null date keeps them."""
    rng = np.random.default_rng(5)
    rows = [("d" if i % 2 else None, str(i), "n" if i % 3 else "s", *[float(v) for v in rng.normal(size=4)], float(rng.uniform(1, 4))) for i in range(40)]
    df = spark.createDataFrame(rows, "day string, code string, industry string, ret double, y double, p double, q double, float_cap double")
    df = df.withColumn("trade_date", F.when(F.col("day") == "d", F.lit("2020-01-31").cast("date"))).drop("day")
    both = xsection.orthogonalize(xsection.orthogonalize(df, "y", ["p", "q"]), "q", ["p"])
    plan = lambda x: x._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan(both)
    assert "Window" not in plan(model.normal_residual(df, model.factor_returns(df, ["y"]), ["y"]))
    shared = xsection.orthogonalized(df, {"y": ["p", "q"], "q": ["p"]})
    a, b = ([tuple(r) for r in x.select("code", "y", "q").orderBy("code").collect()] for x in (both, shared))
    assert len(a) == 40 and all(r[1] is not None and r[2] is not None for r in a)
    np.testing.assert_allclose([r[1:] for r in a], [r[1:] for r in b], atol=1e-9)


@pytest.mark.parametrize("refs", [["p"], ["p", "q"]])
def test_residual(spark, refs):
    rng = np.random.default_rng(2)
    n = 9
    rows = [(str(i), *[float(v) for v in rng.normal(size=3)], float(rng.uniform(1, 4))) for i in range(n)]
    df = section(spark, rows, "code string, y double, p double, q double, float_cap double")
    got = np.array(column(xsection.residual(df, "y", refs, "float_cap", "r"), "r", "code"))
    a = np.array([r[1:] for r in rows])
    z = np.column_stack([np.ones(n), a[:, 1 : 1 + len(refs)]])
    w = np.sqrt(np.sqrt(a[:, 3]))
    beta = np.linalg.lstsq(z * w[:, None], a[:, 0] * w, rcond=None)[0]
    np.testing.assert_allclose(got, a[:, 0] - z @ beta, atol=1e-10)
    few = df.where(F.col("code").cast("int") < 2 + len(refs))
    assert set(column(xsection.residual(few, "y", refs, "float_cap", "r"), "r", "code")) == {None}


def test_unit_detection(spark):
    assert column(xsection.unit_scaled(series(spark, [-12, 13, 11]), ["x"]), "x") == [-0.12, 0.13, 0.11]
    assert column(xsection.unit_scaled(series(spark, [0.12, 0.3, 5]), ["x"]), "x") == [0.12, 0.3, 5.0]


def test_compose(spark):
    df = section(spark, [("a", 1.0, 2.0), ("b", None, 2.0)], "code string, p double, q double")
    assert column(model.compose(df, "s", {"p": 0.5, "q": 0.25, "gone": 0.25}), "s", "code") == [1.0, None]
    assert "s" not in model.compose(df, "s", {"gone": 1.0}).columns


# --- factor returns
def market(spark, n=24, seed=3, null_style=False):
    rng = np.random.default_rng(seed)
    rows = [(f"{i:02}", "ABC"[i % 3], float(rng.normal()), float(rng.uniform(1, 9)), float(rng.normal()), None if null_style else float(rng.normal())) for i in range(n)]
    return section(spark, rows, "code string, industry string, ret double, float_cap double, s1 double, s2 double")


def test_factor_return_invariants(spark):
    df = market(spark)
    f = model.factor_returns(df, ["s1", "s2"])
    residual = model.constraint_residual(f, model.industry_weights(model.estimation_sample(df))).first()["residual"]
    assert abs(residual) < 1e-12
    both = model.country_identity(df, f, ["s1", "s2"]).first()
    assert both["country"] == pytest.approx(both["implied"], abs=1e-12)
    native = {r["factor"]: r["value"] for r in model.factor_returns_native(df, ["s1", "s2"]).collect()}
    assert native == {r["factor"]: pytest.approx(r["value"], abs=1e-12) for r in f.collect()}


def test_factor_returns_drop_null_styles_and_small_samples(spark):
    f = model.factor_returns(market(spark, null_style=True), ["s1", "s2"])
    assert {r["factor"] for r in f.collect()} == {"country", "A", "B", "C", "s1"}
    assert model.factor_returns(market(spark, n=6), ["s1", "s2"]).count() == 0
    assert model.factor_returns(market(spark, n=7), ["s1", "s2"]).count() == 6


def test_factor_returns_of_collinear_styles_have_least_norm(spark):
    df = market(spark).withColumn("s2", F.col("s1"))
    got = {r["factor"]: r["value"] for r in model.factor_returns(df, ["s1", "s2"]).collect()}
    assert got["s1"] == pytest.approx(got["s2"], rel=1e-6)


# --- registry
def test_registry_order():
    assert d.ordered(d.FACTORS, ["volatility"]) == ["beta", "volatility"]
    assert sum(len(f.outputs) for f in d.FACTORS.values()) == 22 and len(d.STYLES) == 10
    f = lambda *deps: d.Factor((), lambda df, w, m: df, deps)
    with pytest.raises(ValueError, match="cycle"):
        d.ordered({"a": f("b"), "b": f("a")})
    with pytest.raises(ValueError, match="unknown"):
        d.ordered({"a": f("x")})


# --- exposures
def test_as_of_dates(spark):
    wanted = spark.createDataFrame([("f", dt.date(2024, 1, 6)), ("f", dt.date(2025, 3, 1)), ("f", dt.date(2023, 1, 1))], "fund_id string, value_date date")
    known = spark.createDataFrame([(dt.date(2024, 1, 5),), (dt.date(2024, 1, 8),)], "trade_date date")
    got = {r["value_date"]: r["trade_date"] for r in exposure.as_of_dates(wanted, known).collect()}
    assert got == {dt.date(2024, 1, 6): dt.date(2024, 1, 5), dt.date(2025, 3, 1): dt.date(2024, 1, 8), dt.date(2023, 1, 1): None}


def test_last_complete_date(spark):
    members = spark.createDataFrame([(c,) for c in "abcde"], "code string")
    rows = [(day(0), c, 1.0 if c < "b" else None) for c in "abcde"] + [(day(1), c, 1.0 if c < "d" else None) for c in "abcde"] + [(day(2), c, 1.0 if c < "c" else None) for c in "abcde"]
    e = spark.createDataFrame(rows, "trade_date date, code string, size double")
    assert exposure.last_complete_date(e, members).first()[0] == day(1)
    assert exposure.last_complete_date(e.where("trade_date <> date'2024-01-02'"), members).first()[0] == day(0)


def test_fund_exposure_of_percentages(spark):
    held = spark.createDataFrame([("f", day(1), "a", 30.0), ("f", day(1), "a", 20.0), ("f", day(1), "b", 50.0)], "fund_id string, value_date date, code string, weight double")
    e = spark.createDataFrame([(day(0), "a", 2.0), (day(0), "c", 9.0)], "trade_date date, code string, size double")
    r = exposure.fund_exposure(held, e, ["size"]).first()
    assert (r["trade_date"], r["exposure"], r["covered"]) == (day(0), 1.0, 1)


def test_valuation_sheet_fallback(spark):
    rows = [("f", 0, ["估值日期:2024-03-05", None]), ("f", 1, ["科目代码", "市值占净值%"]), ("f", 2, ["X600000", "12.5%"]), ("f", 3, ["合计", "100"]), ("f", 4, ["Y000001", "n/a"])]
    got = exposure.parse_valuation_sheet(spark.createDataFrame(rows, "fund_id string, row_no int, cells array<string>")).orderBy("code").collect()
    assert [tuple(r) for r in got] == [("f", dt.date(2024, 3, 5), "000001.XSHE", None), ("f", dt.date(2024, 3, 5), "600000.XSHG", 12.5)]


# --- attribution and performance
def test_attribution_adds_up(spark):
    rng = np.random.default_rng(4)
    n, names = 20, [("country", "country"), ("industry", "A"), ("industry", "B"), ("style", "s")]
    values = rng.normal(scale=0.01, size=(n, 4))
    rows = [(day(i), g, f, None if f == "s" and i < 6 else float(values[i, j])) for i in range(n) for j, (g, f) in enumerate(names)]
    returns = spark.createDataFrame(rows, "trade_date date, factor_group string, factor string, value double")
    nav = spark.createDataFrame([("f", day(i), float(v)) for i, v in enumerate(np.cumprod(1 + rng.normal(scale=0.01, size=n)))], "fund_id string, trade_date date, nav double")
    parts = attribution.attribute(nav, returns, 8)
    r = attribution.identity_error(parts, nav).first()
    assert r["max_error"] < 1e-12 and r["n_days"] == 12
    style = parts.where("component = 'Style'").groupBy("trade_date").agg(F.sum(F.when(F.col("detail").isNull(), F.col("value"))).alias("a"), F.sum(F.when(F.col("detail").isNotNull(), F.col("value"))).alias("b")).collect()
    assert all(abs(x["a"] - (x["b"] or 0)) < 1e-12 for x in style)


def nav_of(spark, values, start=DAY0):
    return spark.createDataFrame([("f", start + dt.timedelta(days=i), float(v)) for i, v in enumerate(values)], "fund_id string, trade_date date, nav double")


def test_drawdown(spark):
    r = performance.max_drawdown(nav_of(spark, [1, 2, 1.5, 1, 1.8, 3])).first()
    assert (r["max_drawdown"], r["drawdown_start"], r["drawdown_end"]) == (-0.5, day(1), day(3))
    r = performance.max_drawdown(nav_of(spark, [1, 2, 3])).first()
    assert (r["max_drawdown"], r["drawdown_start"], r["drawdown_end"]) == (0.0, None, None)


def test_performance_fills_gaps_and_rejects_periods(spark):
    rng = np.random.default_rng(5)
    nav = nav_of(spark, np.cumprod(1 + rng.normal(scale=0.02, size=60))).where("day(trade_date) <> 17")
    calendar = spark.createDataFrame([(day(i),) for i in range(60)], "trade_date date")
    r = performance.performance(nav, calendar, "d").first()
    assert r["n_periods"] == 59 and r["n_weeks"] == r["n_wins"] + r["n_losses"]
    with pytest.raises(ValueError):
        performance.performance(nav, calendar, "m")
