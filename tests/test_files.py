"""Sources, sinks and the daily stream on temporary folders."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskloom.sources import files, sinks
from riskloom.streaming.daily_append import append_daily

SCHEMA = "trade_date date, code string, x double"


def frame(spark, *rows):
    return spark.createDataFrame([(dt.date(*d), c, x) for d, c, x in rows], SCHEMA)


def content(spark, path):
    return sorted((str(r["trade_date"]), r["code"], r["x"]) for r in spark.read.parquet(path).collect())


def test_upsert_panel(spark, tmp_path):
    p = str(tmp_path / "panel")
    assert sinks.latest_date(spark, p, "2010-01-01") == "2010-01-01"
    assert sinks.upsert_panel(frame(spark, ((2023, 1, 2), "a", 1.0), ((2024, 1, 2), "a", 2.0)), p)
    assert sinks.upsert_panel(frame(spark, ((2024, 1, 2), "a", None), ((2024, 1, 3), "a", 5.0)), p)
    assert not sinks.upsert_panel(frame(spark), p)
    assert content(spark, p) == [("2023-01-02", "a", 1.0), ("2024-01-02", "a", 2.0), ("2024-01-03", "a", 5.0)]
    assert sinks.latest_date(spark, p, "2010-01-01") == "2024-01-03"
    with pytest.raises(ValueError, match="missing outputs"):
        sinks.upsert_outputs({}, ["beta"], str(tmp_path))
    assert files.load_panel(spark, p, "2024-01-01", "2024-01-02").count() == 1


def test_an_upsert_that_dies(spark, tmp_path, monkeypatch):
    """Killed before the years are marked as whole nothing has changed; killed after that, the next to open the table finishes."""
    p = str(tmp_path / "panel")
    old = [("2023-01-02", "a", 1.0), ("2024-01-02", "a", 2.0)]
    rows = ((2023, 1, 2), "a", 7.0), ((2024, 1, 3), "a", 5.0)
    sinks.upsert_panel(frame(spark, ((2023, 1, 2), "a", 1.0), ((2024, 1, 2), "a", 2.0)), p)
    assert content(spark, p) == old and not sinks.exists(spark, p + ".next")

    class Killed(BaseException):
        pass

    def die(*_):
        raise Killed

    for what in ("files", "take_places"):
        with monkeypatch.context() as m:
            real = getattr(sinks, what)
            if what == "files":  # the file system is asked for the mark only after the years are written
                m.setattr(sinks, what, lambda s, q, real=real: die() if real(s, q).exists(sinks.at(s, p + ".next")) else real(s, q))
            else:
                m.setattr(sinks, what, die)
            with pytest.raises(Killed):
                sinks.upsert_panel(frame(spark, *rows), p)
        assert content(spark, p) == old and sinks.exists(spark, p + ".next")
        if what == "files":
            assert sorted(files.load_panel(spark, p).select("x").collect()) == [(1.0,), (2.0,)] and not sinks.exists(spark, p + ".next")
    new = [("2023-01-02", "a", 7.0), ("2024-01-02", "a", 2.0), ("2024-01-03", "a", 5.0)]
    assert files.load_panel(spark, p).count() == 3 and content(spark, p) == new and not sinks.settle(spark, p)


def test_daily_stream(spark, tmp_path):
    drops, table = str(tmp_path / "drops"), str(tmp_path / "table")
    seen = []
    for rows in ([((2024, 1, 2), "a", 1.0)], [((2024, 1, 2), "a", None), ((2024, 1, 3), "b", 2.0)]):
        df = frame(spark, *rows)
        df.write.mode("append").parquet(drops)
        append_daily(spark, drops, df.schema, table, str(tmp_path / "checkpoint"), lambda b: seen.append(b.count())).awaitTermination()
    assert content(spark, table) == [("2024-01-02", "a", 1.0), ("2024-01-03", "b", 2.0)]
    assert seen == [1, 2]


def test_nav(spark):
    raw = spark.createDataFrame([("2024-01-02", "1.0", "1.0"), ("2024-01-03", "1.1", "1.3"), ("2024-01-03", "1.2", "1.4"), ("x", "1", "1"), ("2024-01-04", "-", "-")], "`日期` string, `单位净值` string, `累计净值` string")
    assert [r["nav"] for r in files.load_nav(raw).orderBy("trade_date").collect()] == [1.0, 1.4]
    assert [r["nav"] for r in files.load_nav(raw.drop("累计净值")).orderBy("trade_date").collect()] == [1.0, 1.2]


def test_encodings_and_fallback(spark, tmp_path):
    p = tmp_path / "w.csv"
    p.write_bytes("证券代码,权重\n000001.SZ,0.5\n".encode("gbk"))
    w = files.load_index_weights(files.read_table(spark, str(p)))
    assert [tuple(r) for r in w.collect()] == [("000001.SZ", 0.5)]
    got = files.first_that_works([("a", lambda: 1 / 0), ("b", lambda: w.limit(0)), ("c", lambda: w)])
    assert got.first()["source"] == "c"
    with pytest.raises(RuntimeError, match="a: ZeroDivisionError.*b: empty"):
        files.first_that_works([("a", lambda: 1 / 0), ("b", lambda: w.limit(0))])


def test_report_cache(spark):
    raw = spark.createDataFrame([("a", "2020q4", "2021-03-01", 1.0), ("a", "2020q4", "2021-05-01", 2.0), ("a", "2020q3", "2021-06-01", 9.0)], "code string, quarter string, info_date string, eps double")
    annual = files.annual_from_quarters(raw)
    assert [tuple(r) for r in annual.select("code", "year", "eps").collect()] == [("a", 2020, 2.0)]

    def broken():
        raise OSError

    assert files.cached_reports(annual, broken, 2020, 2020).count() == 1
    assert files.cached_reports(annual, broken, 2019, 2021).count() == 1
    newer = annual.withColumn("eps", F.lit(5.0))
    assert files.cached_reports(annual, lambda: newer, 2019, 2021).first()["eps"] == 5.0
    with pytest.raises(OSError):
        files.cached_reports(None, broken, 2019, 2021)


def test_settings(tmp_path):
    p = tmp_path / "s.json"
    p.write_text('{"window": 252}')
    assert files.load_settings(str(p)) == {"window": 252}
