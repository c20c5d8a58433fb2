"""Rolling attribution by running sums against least squares on each window's own rows."""

import datetime

import numpy as np
import pytest

from riskloom.operators import attribution, summaries


def plain(x, r, window):
    """``{row: (have, part)}`` by a fit of each window on its own."""
    out = {}
    for end in range(window - 1, len(x)):
        xs, rs = x[end - window + 1 : end + 1], r[end - window + 1 : end + 1]
        have = ~np.isnan(xs).all(axis=0)
        whole = ~np.isnan(xs[:, have]).any(axis=1)
        if whole[-1]:
            out[end] = (have, np.linalg.lstsq(xs[whole][:, have], rs[whole], rcond=None)[0] * xs[-1, have])
    return out


def same(x, r, window, first=0, tolerance=1e-12):
    got = {end: (have, part) for end, have, part in attribution.window_parts(x, r, window, first)}
    want = {k: v for k, v in plain(x, r, window).items() if k >= first}
    assert set(got) == set(want)
    for end, (have, part) in want.items():
        assert (got[end][0] == have).all()
        assert got[end][1] == pytest.approx(part, abs=tolerance), end


def test_five_thousand_dates():
    rng = np.random.default_rng(0)
    x = rng.normal(0, 0.01, size=(5000, 12)) * rng.uniform(0.1, 3, size=12)
    x[:, 5] += 0.9 * x[:, 0]
    x[2000:2003] *= 1e4  # a few wild days must not spoil the windows after them
    same(x, x @ rng.normal(size=12) + rng.normal(0, 0.005, size=5000), 252, tolerance=1e-10)


def test_missing_factors_and_ranks():
    rng = np.random.default_rng(1)
    x = rng.normal(0, 0.01, size=(400, 6))
    x[:150, 4] = np.nan  # starts late
    x[rng.integers(0, 400, 30), rng.integers(0, 4, 30)] = np.nan
    x[:, 5] = 2 * x[:, 1]  # repeats another
    r = rng.normal(0, 0.01, size=400)
    same(x, r, 40)
    same(x, r, 40, first=77)
    same(x[:50], r[:50], 60)
    same(np.full((30, 2), np.nan), r[:30], 10)
    same(x[:, :0], r, 40)


def table(spark, days=90, funds=2):
    rng = np.random.default_rng(3)
    dates = [datetime.date(2024, 1, 1) + datetime.timedelta(i) for i in range(days)]
    factors = [("country", "country"), ("industry", "A"), ("industry", "B"), ("style", "size"), ("style", "value")]
    f = {d: rng.normal(0, 0.01, size=5) for d in dates}
    returns = [(d, g, n, float(v)) for d in dates for (g, n), v in zip(factors, f[d], strict=True) if (d != dates[40] or n != "size") and d != dates[50]]
    nav, r = [], {}
    for k in range(funds):
        level = 1.0
        for i, d in enumerate(dates):
            if k == 1 and i < 33:
                continue
            step = float(f[d] @ np.arange(1, 6) / 5 + rng.normal(0, 0.002))
            r[k, d] = step
            level *= 1 + step
            nav.append((k, d, level if (k, i) != (0, 60) else None))
    return spark.createDataFrame(nav, "fund_id int, trade_date date, nav double"), spark.createDataFrame(returns, "trade_date date, factor_group string, factor string, value double")


def test_blocks_make_no_difference(spark):
    nav, returns = table(spark)
    key = lambda r: (r["fund_id"], r["trade_date"], r["component"], r["detail"] or "")
    one = {key(r): r["value"] for r in attribution.attribute(nav.repartition(4), returns, 20, block=1000).collect()}
    for block in (19, 20, 33):
        got = {key(r): r["value"] for r in attribution.attribute(nav.repartition(3), returns, 20, block=block).collect()}
        assert got == {k: pytest.approx(v, abs=1e-12) for k, v in one.items()}
    assert len({k[1] for k in one if k[0] == 0}) == 90 - 1 - 1 - 1 - 19 - 1  # no return, no factors, no value, warm-up, a date without size
    parts = attribution.attribute(nav, returns, 20)
    assert all(r["max_error"] < 1e-14 for r in attribution.identity_error(parts, nav).where("fund_id = 1").collect())
    with pytest.raises(ValueError, match="block"):
        attribution.attribute(nav, returns, 20, block=10)


def test_ranking_reads_what_attribution_writes(spark):
    nav, returns = table(spark)
    parts = attribution.attribute(nav, returns, 20)
    ranked = summaries.ranked_styles(parts).collect()
    assert {(r["fund_id"], r["style"]) for r in ranked} == {(k, s) for k in (0, 1) for s in ("size", "value")}
    assert all(r["place"] in (1, 2) for r in ranked) and len({(r["fund_id"], r["place"]) for r in ranked}) == 4
    top = {r["fund_id"]: r["annualised"] for r in ranked if r["place"] == 1}
    assert all(r["annualised"] <= top[r["fund_id"]] for r in ranked)
