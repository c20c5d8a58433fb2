"""Ten daily drops give the descriptors of one batch run."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators.panel import calendar, densify
from riskloom.operators.xsection import standardize
from riskloom.plans.descriptors import Windows, raw_descriptors
from riskloom.streaming import daily_append

SCHEMA = "trade_date date, code string, industry string, ret double, float_cap double, market_cap double, turnover double, rf double, rt double"
WINDOWS = Windows(beta=(8, 3, 2), momentum=(10, 4, 2, 9), deviation=(6, 3), range=(1, 4), liquidity=((3, 2, 1), (5, 4, 2), (8, 6, 3)))


def panel(days, codes=9):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(days):
        rt = float(rng.normal(0, 0.02))
        for c in range(codes):
            values = [float(rng.normal(0, 0.02)), float(rng.lognormal(2, 1)), float(rng.lognormal(3, 1)), float(rng.lognormal(0, 1))]
            gap = rng.uniform() < 0.05
            if not (gap and i != 0):
                rows.append((dt.date(2023, 12, 10) + dt.timedelta(i), f"c{c}", "AB"[c % 2], *values, 0.02, rt))
    return rows


def test_drops_and_one_batch(spark, tmp_path):
    rows = panel(34)
    days = sorted({r[0] for r in rows})
    drops, table, out = (str(tmp_path / n) for n in ("drops", "table", "out"))
    schema = spark.createDataFrame([], SCHEMA).schema
    for n, part in enumerate([days[:24], *[[d] for d in days[24:]]]):
        spark.createDataFrame([r for r in rows if r[0] in part], SCHEMA).coalesce(1).write.mode("append").parquet(drops)
        for f in (tmp_path / "drops").glob("*.parquet"):
            if not f.name.startswith("n"):
                new = f.with_name(f"n{n:03}.parquet")
                f.rename(new)
                os.utime(new, (1_700_000_000 + n, 1_700_000_000 + n))  # the order of arrival
    q = daily_append.follow(spark, drops, schema, table, out, str(tmp_path / "cp"), WINDOWS, files_per_batch=1)
    q.awaitTermination()
    assert len(q.recentProgress) >= 11 and spark.read.parquet(table).count() == len(rows)
    whole = spark.createDataFrame(rows, SCHEMA)
    series = whole.groupBy("trade_date").agg(F.max("rf").alias("rf"), F.max("rt").alias("rt"))
    dense = densify(whole.drop("rf", "rt", "industry"), calendar(whole), whole.select("code", "industry").distinct()).join(series, "trade_date")
    df, names = raw_descriptors(dense, WINDOWS, list(daily_append.TRAILING))
    want = {(r["trade_date"], r["code"]): r for r in standardize(df, names).collect()}
    got = {(r["trade_date"], r["code"]): r for r in spark.read.parquet(out).collect()}
    assert set(got) == set(want) and {"lncap", "beta", "sigma", "rstr", "stom", "stoq", "stoa"} <= set(names)
    for key, r in want.items():
        for c in names:
            assert got[key][c] == (None if r[c] is None else pytest.approx(r[c], abs=1e-9)), (key, c)
    assert any(r["rstr"] is not None for r in want.values())


def test_a_late_correction(spark, tmp_path):
    """A drop for an old date changes what follows it, and nothing before."""
    rows = panel(20)
    table, out = str(tmp_path / "table"), str(tmp_path / "out")
    daily_append.upsert_panel(spark.createDataFrame(rows, SCHEMA), table)
    daily_append.bring_up(spark, table, out, str(rows[0][0]), WINDOWS, ("liquidity",))
    before = {(r["trade_date"], r["code"]): r["stom"] for r in spark.read.parquet(out).collect()}
    day = dt.date(2023, 12, 20)
    daily_append.upsert_panel(spark.createDataFrame([next((*r[:6], 99.0, *r[7:]) for r in rows if r[0] == day)], SCHEMA), table)
    daily_append.bring_up(spark, table, out, str(day), WINDOWS, ("liquidity",))
    after = {(r["trade_date"], r["code"]): r["stom"] for r in spark.read.parquet(out).collect()}
    assert set(before) == set(after) and all(after[k] == pytest.approx(v, abs=1e-12) for k, v in before.items() if k[0] < day)
    assert any(after[k] != v for k, v in before.items() if k[0] == day)
    with pytest.raises(ValueError, match="past alone"):
        daily_append.bring_up(spark, table, out, str(day), WINDOWS, ("volatility",))
