"""Raw files and sheets: precedence of columns, dates, errors, workbooks and encodings; and the constrained solve."""

import datetime as dt
import gzip
import io
import zipfile

import numpy as np
import pytest

from riskloom.operators import exposure, model, summaries, xsection
from riskloom.sources import files

SHEET = "fund_id string, row_no int, cells array<string>, file_name string"


def nav(spark, names, *rows):
    df = spark.createDataFrame([tuple(map(str, r)) for r in rows], ", ".join(f"`{n}` string" for n in names))
    return [(str(r["trade_date"]), r["nav"]) for r in files.load_nav(df).orderBy("trade_date").collect()]


def test_nav_precedence(spark):
    assert nav(spark, ["日期", "净值日期", "复权净值", "单位净值"], ("2024-01-01", "2024-02-02", 9, 1)) == [("2024-02-02", 1.0)]
    assert nav(spark, ["估值日期", "累计净值"], ("2024-01-01", 2)) == [("2024-01-01", 2.0)]
    assert nav(spark, [" date ", "净值"], ("2024-01-01", 3)) == [("2024-01-01", 3.0)]
    assert nav(spark, ["date", "复权净值", "累计净值"], ("2024-01-01", 3, 4)) == [("2024-01-01", 3.0)]
    with pytest.raises(ValueError, match="单位净值"):
        nav(spark, ["date", "price"], ("2024-01-01", 3))


def test_gbk_at_any_size(spark, tmp_path):
    text = "证券代码,权重,名称\n000001.SZ,0.5,\"平,安\\\"\n000002.SZ,,万科\n"
    for name, data in (("a.csv.gz", gzip.compress(text.encode("gbk"))), ("b.csv", text.encode("gbk")), ("c.csv.gz", gzip.compress(text.replace("\\", "").encode()))):
        (tmp_path / name).write_bytes(data)
        rows = files.read_table(spark, str(tmp_path / name)).orderBy("`证券代码`").collect()
        assert [r["证券代码"] for r in rows] == ["000001.SZ", "000002.SZ"] and rows[1]["权重"] is None and rows[1]["名称"] == "万科"
    with pytest.raises(ValueError, match="none of"):
        (tmp_path / "d.csv").write_bytes(b"a,b\n\xff\xff,1\n")
        files.read_table(spark, str(tmp_path / "d.csv"), ["utf-8"])


def sheet(spark, rows, name="f"):
    return spark.createDataFrame([("f", n, cells, name) for n, cells in enumerate(rows)], SHEET)


def test_valuation_sheet_rules(spark):
    rows = [["成立日期 2010-05-05"], ["估值日期:2024-04-30"], ["科目代码", "名称", "市值占比"], ["11020101600000", "x", "60"], ["11020101000001", "y", "40"]]
    got = exposure.parse_valuation_sheet(sheet(spark, rows)).orderBy("code").collect()
    assert [(r["value_date"], r["code"], r["weight"]) for r in got] == [(dt.date(2024, 4, 30), "000001.XSHE", 40.0), (dt.date(2024, 4, 30), "600000.XSHG", 60.0)]
    named = exposure.parse_valuation_sheet(sheet(spark, rows[2:], "/x/sheet_20240229.xlsx")).first()
    assert named["value_date"] == dt.date(2024, 2, 29)
    assert exposure.parse_valuation_sheet(sheet(spark, rows[2:]), "2024-01-31").first()["value_date"] == dt.date(2024, 1, 31)
    for bad, given, what in (
        (rows[:2] + rows[3:], None, "header"), (rows[2:], None, "date"), ([*rows[:2], ["科目代码", "名称"], *rows[3:]], None, "weight column"),
        (rows[:3], None, "without stock positions"), (rows, "2024-05-31", "another date"),
    ):
        with pytest.raises(ValueError, match=what):
            exposure.parse_valuation_sheet(sheet(spark, bad), given)


def workbook(path):
    space = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {space}><si><t>净值日期</t></si><si><r><t>单位</t></r><r><t>净值</t></r></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {space}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row><row r="3"><c r="A3" t="inlineStr"><is><t>2024-03-01</t></is></c><c r="C3"><v>1.25</v></c></row></sheetData></worksheet>')
    path.write_bytes(out.getvalue())


def test_workbooks(spark, tmp_path):
    workbook(tmp_path / "nav.xlsx")
    rows = files.read_sheets(spark, str(tmp_path / "nav.xlsx")).orderBy("row_no").collect()
    assert [(r["row_no"], r["cells"]) for r in rows] == [(0, ["净值日期", None, "单位净值"]), (2, ["2024-03-01", None, "1.25"])]
    got = files.load_nav(files.read_table(spark, str(tmp_path / "nav.xlsx"))).first()
    assert (got["trade_date"], got["nav"]) == (dt.date(2024, 3, 1), 1.25)


def dated_workbook(path, from_1904=False):
    """As a spreadsheet program writes it: dates as styled numbers, the first sheet not the first file."""
    space = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    cell = lambda at, v, s="": f'<c r="{at}"{s}><v>{v}</v></c>'
    less = 1462 if from_1904 else 0
    rows = [(45352 - less, ' s="1"', 1.25), (45353.75 - less, ' s="2"', 1.5), (45354, ' s="3"', 1.75), (99999999, ' s="1"', 2)]
    body = "".join(f'<row r="{i}">{cell(f"A{i}", d, s)}{cell(f"B{i}", v)}</row>' for i, (d, s, v) in enumerate(rows, 2))
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {space}><workbookPr date1904="{int(from_1904)}"/><sheets><sheet name="b" r:id="r7"/><sheet name="a" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="x"><Relationship Id="r1" Target="worksheets/sheet1.xml"/><Relationship Id="r7" Target="/xl/worksheets/sheet2.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'<styleSheet {space}><numFmts><numFmt numFmtId="170" formatCode="[$-804]yyyy&quot;d&quot;mm"/><numFmt numFmtId="171" formatCode="[Red]0.00&quot;yd&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {space}><sheetData/></worksheet>")
        z.writestr("xl/worksheets/sheet2.xml", f'<worksheet {space}><sheetData><row r="1"><c r="A1" t="inlineStr"><is><t>净值日期</t></is></c><c r="B1" t="inlineStr"><is><t>单位净值</t></is></c></row>{body}</sheetData></worksheet>')


@pytest.mark.parametrize("from_1904", [False, True])
def test_date_cells(spark, tmp_path, from_1904):
    dated_workbook(tmp_path / "nav.xlsx", from_1904)
    rows = files.read_sheets(spark, str(tmp_path / "nav.xlsx")).orderBy("row_no").collect()
    assert [r["cells"][0] for r in rows] == ["净值日期", "2024-03-01", "2024-03-02 18:00:00", "45354", "99999999"]
    got = files.load_nav(files.read_table(spark, str(tmp_path / "nav.xlsx"))).orderBy("trade_date").collect()
    assert [(r["trade_date"], r["nav"]) for r in got] == [(dt.date(2024, 3, 1), 1.25), (dt.date(2024, 3, 2), 1.5)]
    assert files.serial_date("59", False) == "1900-02-28" and files.serial_date("61", False) == "1900-03-01" and files.serial_date("-1", False) == "-1" and files.serial_date("x", False) == "x"


def test_a_utf8_file_may_hold_the_replacement_character(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("代码,名称\n1,a\ufffdb\ufffd\n2,万科\n".encode())
    assert {r["名称"] for r in files.read_table(spark, str(tmp_path / "a.csv")).collect()} == {"a\ufffdb\ufffd", "万科"}
    (tmp_path / "b.csv").write_bytes("代码,名称\n1,a\ufffd\n".encode() + b"2,\xff\n")
    with pytest.raises(ValueError, match="none of"):
        files.read_table(spark, str(tmp_path / "b.csv"), ["utf-8"])


def test_industry_sources(spark):
    rows = [("600000.XSHG", 40, "bank"), ("000001.XSHE", 41, "other"), ("430001.XBJG", 7, None), (None, 1, "x"), ("000001.XSHE", 41, "other")]
    make = lambda *names: spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in zip(names, ("string", "int", "string"), strict=True)))
    want = {("600000.SH", "40", "bank"), ("000001.SZ", "41", "other"), ("430001.BJ", "7", None)}

    def broken():
        raise OSError("not there")

    for names in (("order_book_id", "first_industry_code", "first_industry_name"), ("code", "industry_code", "industry_name"), ("stock_code", "index_code", "index_name")):
        got = files.load_industries([("a", broken), ("b", lambda names=names: make(*names).limit(0)), ("c", lambda names=names: make(*names))])
        assert got.columns == ["stock_code", "industry_code", "industry_name", "source"] and got.count() == 3
        assert {tuple(r)[:3] for r in got.collect()} == want and {r["source"] for r in got.collect()} == {"c"}
    with pytest.raises(ValueError, match="none of"):
        files.load_industries([("a", lambda: make("code", "p", "q"))])


def test_sheet_columns_go_by_whole_captions(spark):
    rows = [["估值日期:2024-04-30"], [" 科目代码 ", "市值占净值变动", " 市值占净值% "], ["11020101600000", "7", "60"]]
    assert exposure.parse_valuation_sheet(sheet(spark, rows)).first()["weight"] == 60.0
    with pytest.raises(ValueError, match="weight column"):
        exposure.parse_valuation_sheet(sheet(spark, [rows[0], ["科目代码", "市值占净值变动"], rows[2]]))
    # A date that isn't named the valuation date is none.
    with pytest.raises(ValueError, match="date"):
        exposure.parse_valuation_sheet(sheet(spark, [["成立日期 2010-05-05"], *rows[1:]]))


def test_no_factor_date_is_an_error(spark):
    held = spark.createDataFrame([("f", dt.date(2020, 1, 1), "a", 1.0)], "fund_id string, value_date date, code string, weight double")
    factors = spark.createDataFrame([(dt.date(2021, 1, 1), "a", 1.0)], "trade_date date, code string, size double")
    with pytest.raises(ValueError, match="no factor date"):
        exposure.fund_exposure(held, factors, ["size"])


def test_solve_against_a_reduced_problem():
    r = np.random.default_rng(0)
    n = 60
    d = np.eye(4)[r.integers(0, 4, n)]
    s = r.normal(size=(n, 3))
    x, w, y = np.column_stack([np.ones(n), d, s]), r.uniform(0.5, 1.5, n), r.normal(size=n)
    c = d.T @ w
    solve = lambda x, y: model.least_norm((x.T * w) @ x, x.T @ (w * y), c)
    f = solve(x, y)
    # Unknowns within the null space of the constraint.
    basis = np.linalg.svd(np.array([[0, *c, 0, 0, 0]]))[2][1:].T
    root = np.sqrt(w)[:, None]
    want = basis @ np.linalg.lstsq(root * x @ basis, root[:, 0] * y, rcond=None)[0]
    assert np.allclose(f, want) and abs(c @ f[1:5]) < 1e-9
    twice = solve(np.column_stack([x, s[:, 0]]), y)
    assert np.allclose(np.column_stack([x, s[:, 0]]) @ twice, x @ want) and np.isclose(twice[5], twice[8])
    assert solve(x, y * np.nan) is None


@pytest.mark.parametrize("values,large", [([2.0, 3.0, 0.5], True), ([2.0, 0.5, 0.1], False), ([0.9, 1.2], True), ([0.5, 1.2], False), ([None, 2.0], True), ([None], False), ([1.0, 1.0], False)])
def test_unit_detection_is_by_the_median(spark, values, large):
    got = xsection.unit_scaled(spark.createDataFrame([(v,) for v in values], "x double"), ["x"]).collect()
    assert sorted(r["x"] for r in got if r["x"] is not None) == sorted(v / (100 if large else 1) for v in values if v is not None)


def test_as_of_dates(spark):
    day = lambda n: dt.date(2023, 12, 20) + dt.timedelta(n)
    dates = spark.createDataFrame([(day(0),), (day(5),), (day(5),), (day(30),), (None,)], "trade_date date")
    wanted = spark.createDataFrame([("f", day(n)) for n in (-1, 0, 4, 5, 29, 30, 400)] + [("f", None)], "fund_id string, value_date date")
    got = {r["value_date"]: r["trade_date"] for r in exposure.as_of_dates(wanted, dates).collect()}
    assert got == {day(-1): None, day(0): day(0), day(4): day(0), day(5): day(5), day(29): day(5), day(30): day(30), day(400): day(30), None: None}
    assert exposure.as_of_dates(wanted, dates.limit(0)).where("trade_date is not null").count() == 0


def test_securities_and_style_weights(spark, tmp_path):
    df = spark.createDataFrame([("a", "Active"), ("b", "Delisted")], "order_book_id string, status string")
    assert [r["code"] for r in files.load_securities(df).collect()] == ["a"] and files.load_securities(df, False).count() == 2
    (tmp_path / "w.json").write_text('{"styles": {"size": {"lncap": 1}}}')
    assert files.load_style_weights(str(tmp_path / "w.json")) == {"size": {"lncap": 1.0}}


def test_ranked_styles(spark):
    parts = spark.createDataFrame([("f", "Style", "a", 1.0), ("f", "Style", "b", 2.0), ("f", "Style", None, 3.0), ("f", "Country", None, 9.0)], "fund_id string, component string, detail string, value double")
    assert [(r["style"], r["place"]) for r in summaries.ranked_styles(parts, 10).orderBy("place").collect()] == [("b", 1), ("a", 2)]
