"""The whole model from stored vendor tables, step by step."""

import datetime as dt

import numpy as np
import pytest

from riskloom.operators.model import factor_returns
from riskloom.plans import build as b
from riskloom.plans.descriptors import MONTHLY, STYLES, style_table
from riskloom.sources.extracts import TABLES

N, DAYS = 60, 45


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    rng = np.random.default_rng(8)
    codes = [f"{600000 + i}.XSHG" for i in range(N)]
    days = [dt.date(2020, 1, 10) + dt.timedelta(30 * i) for i in range(DAYS)]
    for name, fields in TABLES.items():
        rows = [(d, c, *[float(rng.normal(0, 0.05)) if f.name == "ret" else float(rng.lognormal(2, 0.5)) for f in fields]) for d in days for c in codes if rng.uniform() < 0.999]
        spark.createDataFrame(rows, "trade_date date, code string, " + ", ".join(f"{f.name} double" for f in fields)).write.parquet(f"{root}/{name}")
    spark.createDataFrame([(d, 0.03) for d in days], "trade_date date, rf double").write.parquet(f"{root}/rates")
    spark.createDataFrame([(d, float(rng.normal(0, 0.03))) for d in days], "trade_date date, rt double").write.parquet(f"{root}/benchmark")
    spark.createDataFrame([(c.replace("XSHG", "SH"), "ABC"[i % 3]) for i, c in enumerate(codes)], "stock_code string, industry_code string").write.parquet(f"{root}/industries")
    spark.createDataFrame([(c, y, float(rng.lognormal(0, 0.3)), float(rng.lognormal(3, 0.3))) for c in codes for y in range(2014, 2024)], "code string, year int, eps double, revenue double").write.parquet(f"{root}/reports")
    return root


def test_all_steps(spark, tables, tmp_path):
    out = str(tmp_path / "out")
    assert b.build(spark, tables, out, windows=MONTHLY) == [f"{out}/{n}" for n in ("panel", "descriptors", "styles", "factor_returns")]
    panel = spark.read.parquet(f"{out}/panel")
    assert panel.count() == N * DAYS and panel.where("rf is null or rt is null or industry is null").count() == 0
    described = spark.read.parquet(f"{out}/descriptors")
    assert len([c for f in STYLES.values() for c in f if c in described.columns]) == 21 and "sigma" in described.columns
    returns = {(r["trade_date"], r["factor"]): r["value"] for r in spark.read.parquet(f"{out}/factor_returns").collect()}
    last = max(k[0] for k in returns)
    assert {k[1] for k in returns if k[0] == last} == {"country", "A", "B", "C", *STYLES}
    direct = factor_returns(style_table(described.drop("year")), list(STYLES))
    assert returns == {(r["trade_date"], r["factor"]): pytest.approx(r["value"], abs=1e-12) for r in direct.collect()}
    # Late years alone, from a later start, are the same: windows look back over the whole history.
    late = str(tmp_path / "late")
    b.build(spark, tables, late, "panel")
    b.build(spark, tables, late, "descriptors", "2023-01-01", windows=MONTHLY)
    again = spark.read.parquet(f"{late}/descriptors")
    assert again.agg({"trade_date": "min"}).first()[0] >= dt.date(2023, 1, 1)
    key = lambda df: {(r["trade_date"], r["code"]): r["rstr"] for r in df.where("trade_date >= date'2023-01-01'").collect()}
    assert key(again) == {k: None if v is None else pytest.approx(v, abs=1e-12) for k, v in key(described).items()}


def test_errors(spark, tables, tmp_path):
    with pytest.raises(ValueError, match="no step"):
        b.build(spark, tables, str(tmp_path), "nope")
    with pytest.raises(ValueError, match="none of"):
        b.build(spark, str(tmp_path), str(tmp_path), "panel")


def test_command_line(tables, tmp_path, capsys):
    b.main(["--tables", tables, "--out", str(tmp_path / "o"), "--step", "panel", "--end", "2021-01-01"])
    assert capsys.readouterr().out.strip() == f"{tmp_path}/o/panel"
