"""Batched extracts: declared fields, failed batches, and updates from the high-water mark."""

import datetime as dt

import pandas as pd
import pytest

from riskloom.sources import extracts, sinks

CODES = [f"{i:06}.XSHE" for i in range(25)]


def store(root, table="valuation", days=3, extra=()):
    names = [f.vendor for f in extracts.TABLES[table]]
    rows = [{"order_book_id": c, "date": dt.date(2024, 1, 1 + d), **{n: float(i + d + k) for k, n in enumerate(names)}} for i, c in enumerate([*CODES, "other"]) for d in range(days)]
    (root / table).mkdir(parents=True, exist_ok=True)
    pd.DataFrame([*rows, *extra]).to_parquet(root / table / "a.parquet")


def universe(spark):
    return spark.createDataFrame([(c,) for c in [*CODES, CODES[0], None]], "code string")


@pytest.mark.parametrize("table", sorted(extracts.TABLES))
def test_every_table(spark, tmp_path, table):
    store(tmp_path, table)
    rows, failed = extracts.extract(universe(spark), table, extracts.folder(str(tmp_path), table), "2024-01-02", "2024-01-03", batch=10)
    assert rows.columns == ["trade_date", "code", *[f.name for f in extracts.TABLES[table]]] and failed.count() == 0
    got = {(r["code"], str(r["trade_date"])): r for r in rows.collect()}
    assert len(got) == 50 == rows.count() and all(f.unit for f in extracts.TABLES[table])
    assert [got[CODES[4], "2024-01-03"][f.name] for f in extracts.TABLES[table]] == [6.0 + k for k in range(len(extracts.TABLES[table]))]


def test_projection_and_units(spark, tmp_path):
    asked = []

    def fetch(codes, fields, start, end):
        assert fields == ["pb_ratio"]
        return pd.DataFrame({"tradedate": [dt.date(2024, 1, 1)] * 4, "code": [*codes[:2], codes[0], codes[1]], "pb_ratio": ["1.5", "bad", "9", float("inf")]}).set_index(["code", "tradedate"])

    rows, failed = extracts.extract(universe(spark), "valuation", fetch, "2024-01-01", "2024-01-01", ["pb"], batch=100)
    assert sorted((r["code"], r["pb"]) for r in rows.collect()) == [(CODES[0], 1.5), (CODES[1], None)] and not asked and failed.count() == 0
    with pytest.raises(ValueError, match="has no"):
        extracts.extract(universe(spark), "valuation", fetch, "2024-01-01", "2024-01-01", ["nope"])
    none, failed = extracts.extract(universe(spark).limit(0), "valuation", fetch, "2024-01-01", "2024-01-01", ["pb"])
    assert none.count() == failed.count() == 0


def test_failed_batches_are_listed(spark, tmp_path):
    store(tmp_path)
    good = extracts.folder(str(tmp_path), "valuation")
    marks = tmp_path / "tries"
    marks.mkdir()

    def fetch(codes, fields, start, end):
        tries = len(list(marks.glob(f"{codes[0]}-*")))
        (marks / f"{codes[0]}-{tries}").touch()
        if codes[0] == CODES[10]:
            raise OSError("refused")
        if codes[0] == CODES[0] and not tries:
            raise OSError("busy")  # goes through the second time
        out = good(codes, fields, start, end)
        return out.drop(columns="pb_ratio") if codes[0] == CODES[20] else out

    rows, failed = extracts.extract(universe(spark), "valuation", fetch, "2024-01-01", "2024-01-03", batch=10)
    assert {r["code"] for r in rows.collect()} == set(CODES[:10]) and rows.count() == 30
    lost = {r["batch"]: r for r in failed.collect()}
    assert set(lost) == {1, 2} and lost[1]["codes"] == CODES[10:20] and "refused" in lost[1]["error"] and "pb_ratio" in lost[2]["error"]
    assert len(list(marks.glob(f"{CODES[10]}-*"))) == 2  # each batch is fetched once, with one more try


def test_rows_out_of_what_was_asked_for(spark):
    make = lambda code, day: lambda *_: pd.DataFrame({"code": [code], "date": [day], "today": [1.0]})
    for code, day, what in (("x", dt.date(2024, 1, 1), "asked for"), (CODES[0], dt.date(2023, 1, 1), "out of")):
        _, failed = extracts.extract(universe(spark), "turnover", make(code, day), "2024-01-01", "2024-01-02")
        assert what in failed.first()["error"]


def test_updates_from_the_mark(spark, tmp_path):
    path, asked = str(tmp_path / "table"), []
    store(tmp_path, days=2)
    fetch = extracts.folder(str(tmp_path), "valuation")
    assert extracts.update(spark, universe(spark), "valuation", fetch, path, "2010-01-01", "2024-12-31", batch=10).count() == 0
    assert sinks.latest_date(spark, path, "") == "2024-01-02" and spark.read.parquet(path).count() == 50
    store(tmp_path, days=5)
    extracts.update(spark, universe(spark), "valuation", fetch, path, "2010-01-01", "2024-12-31", batch=10)
    assert spark.read.parquet(path).count() == 125 and not asked

    def broken(codes, fields, start, end):
        assert start == "2024-01-05"
        raise OSError("down")

    with pytest.raises(RuntimeError, match="nothing was written.*down"):
        extracts.update(spark, universe(spark), "valuation", broken, path, "2010-01-01", "2024-12-31")
    assert spark.read.parquet(path).count() == 125
