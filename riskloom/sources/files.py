"""Files that the library reads: panels, NAV and weight tables, valuation sheets, and settings."""

from __future__ import annotations

import datetime as dt
import io
import json
import re
import zipfile
from collections.abc import Callable, Iterable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.functions.codes import to_terminal
from riskloom.operators.panel import between, nan_to_null
from riskloom.sources.sinks import settle

# Names under which the date and the net asset value are looked for, in order.
DATE_NAMES = ["净值日期", "日期", "估值日期", "trade_date", "date"]
NAV_NAMES = ["单位净值", "复权净值", "累计净值", "净值"]
#: Columns of an index's weights.
CODE_NAMES = ["stock_code", "order_book_id", "code", "证券代码"]
WEIGHT_NAMES = ["weight", "权重"]


def read_table(spark: SparkSession, path: str, encodings: Iterable[str] = ("utf-8", "gbk")) -> DataFrame:
    """Parquet, an .xlsx sheet with a header, or CSV with a header, all columns as strings.

    A CSV of any size, compressed or not, is read in the first of the encodings that leaves no character undecoded.
    """
    if path.lower().endswith(".xlsx"):
        return with_header(read_sheets(spark, path))
    if not path.lower().endswith((".csv", ".csv.gz", ".txt")):
        return spark.read.parquet(path)
    for encoding in encodings:
        df = decoded_csv(spark, path, encoding)
        lost = occurrences(df, "\ufffd")
        # A UTF-8 file may hold that character itself, as three bytes of its own.
        if not lost or (encoding.lower() == "utf-8" and lost == occurrences(decoded_csv(spark, path, "iso-8859-1"), "\ufffd".encode().decode("latin-1"))):
            return df
    raise ValueError(f"{path}: none of {list(encodings)} reads it")


def occurrences(df: DataFrame, text: str) -> int:
    """How often a text occurs in a table of strings, its columns' names included."""
    found = [F.sum((F.length(c) - F.length(F.replace(c, F.lit(text), F.lit("")))) / len(text)) for c in (F.col(f"`{x}`") for x in df.columns)]
    return sum(c.count(text) for c in df.columns) + sum(int(x or 0) for x in df.agg(*found).first())


def decoded_csv(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """A CSV with a header, what isn't in the encoding as U+FFFD.  Encodings that Spark lacks are read byte by byte and decoded in tasks."""
    if encoding.lower() in ("utf-8", "utf-16", "iso-8859-1"):
        return spark.read.option("header", True).option("encoding", encoding).csv(path)
    raw = spark.read.option("header", True).option("encoding", "iso-8859-1").option("escape", '"').csv(path)
    decode = lambda x: x.encode("latin-1").decode(encoding, "replace")
    names = [decode(c) for c in raw.columns]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            yield df.map(decode, na_action="ignore").set_axis(names, axis=1)

    return raw.mapInPandas(run, ", ".join(f"`{c}` string" for c in names))


# Numbers of the built-in cell formats that show a date.
DATE_FORMATS = {14, 15, 16, 17, 22, *range(27, 32), 34, 35, 36, *range(50, 59)}
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
#: Years that a date cell may have; what lies outside is no date.
YEARS = (1900, 2200)


def date_styles(book: zipfile.ZipFile) -> list[bool]:
    """Of each cell style of a workbook, whether it shows a date."""
    if "xl/styles.xml" not in book.namelist():
        return []
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    own = {f.get("numFmtId"): re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode", "")).lower() for f in root.iter(f"{MAIN}numFmt")}
    shows = lambda i: any(c in own[i] for c in "yd") if i in own else int(i) in DATE_FORMATS
    styles = root.find(f"{MAIN}cellXfs")
    return [shows(x.get("numFmtId", "0")) for x in styles] if styles is not None else []


def serial_date(text: str, from_1904: bool) -> str:
    """A date cell's number of days as a date, with the time if it has one; as it is if it is no day of YEARS."""
    try:
        days = float(text)
        start = dt.datetime(1904, 1, 1) if from_1904 else dt.datetime(1899, 12, 31 if days < 60 else 30)
        at = start + dt.timedelta(seconds=round(days * 86400))
    except (ValueError, OverflowError):
        return text
    if not YEARS[0] <= at.year <= YEARS[1] or days < 0:
        return text
    return at.strftime("%Y-%m-%d" if at.time() == dt.time() else "%Y-%m-%d %H:%M:%S")


def sheet_rows(data: bytes) -> Iterator[tuple[int, list[str | None]]]:
    """(row number from 0, cells) of the first sheet, in the workbook's order, of an .xlsx workbook; dates as text, numbers as they are written, empty cells null."""
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        names = book.namelist()
        shared = ElementTree.fromstring(book.read("xl/sharedStrings.xml")) if "xl/sharedStrings.xml" in names else []
        strings = ["".join(t.text or "" for t in item.iter(f"{MAIN}t")) for item in shared]
        dates, from_1904 = date_styles(book), False
        first = min((n for n in names if n.startswith("xl/worksheets/sheet")), key=lambda n: (len(n), n))
        if "xl/workbook.xml" in names:
            root = ElementTree.fromstring(book.read("xl/workbook.xml"))
            setup, sheet = root.find(f"{MAIN}workbookPr"), next(root.iter(f"{MAIN}sheet"), None)
            from_1904 = setup is not None and setup.get("date1904", "0") in ("1", "true")
            if sheet is not None and "xl/_rels/workbook.xml.rels" in names:
                targets = {r.get("Id"): r.get("Target", "") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
                found = targets.get(sheet.get(RELATION), "")
                found = found.lstrip("/") if found.startswith("/") else f"xl/{found}"
                first = found if found in names else first
        for row in ElementTree.fromstring(book.read(first)).iter(f"{MAIN}row"):
            cells: list[str | None] = []
            for c in row.iter(f"{MAIN}c"):
                at = 0
                for letter in "".join(x for x in c.get("r", "") if x.isalpha()):
                    at = 26 * at + ord(letter) - 64
                cells += [None] * (at - 1 - len(cells))
                text = "".join(t.text or "" for t in c.iter(f"{MAIN}t")) if c.get("t") == "inlineStr" else c.findtext(f"{MAIN}v")
                style = int(c.get("s", "0"))
                if text is not None and c.get("t", "n") == "n" and style < len(dates) and dates[style]:
                    text = serial_date(text, from_1904)
                cells.append(strings[int(text)] if c.get("t") == "s" and text is not None else text)
            yield int(row.get("r", "1")) - 1, cells


def read_sheets(spark: SparkSession, path: str) -> DataFrame:
    """``(fund_id, file_name, row_no, cells)`` of .xlsx workbooks (their first sheets); a file's path is its fund_id."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            for name, data in zip(df["path"], df["content"], strict=True):
                yield pd.DataFrame([(name, name, n, cells) for n, cells in sheet_rows(data)], columns=["fund_id", "file_name", "row_no", "cells"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "fund_id string, file_name string, row_no int, cells array<string>")


def with_header(sheet: DataFrame) -> DataFrame:
    """A sheet's rows as a table of strings named by its first row."""
    head = sheet.orderBy("row_no").select("row_no", "cells").first()
    names = [(c or f"column {i}").strip() for i, c in enumerate(head["cells"])]
    return sheet.where(F.col("row_no") > head["row_no"]).orderBy("row_no").select(*[F.get("cells", F.lit(i)).alias(c) for i, c in enumerate(names)])


def pick(df: DataFrame, names: Iterable[str], required: bool = True) -> str | None:
    """The first of several possible columns that a table has."""
    found = next((n for n in names if n in df.columns), None)
    if found is None and required:
        raise ValueError(f"none of {list(names)} among {df.columns}")
    return found


def number(c: str | Column) -> Column:
    """A number, or null for what isn't one."""
    return F.expr(f"try_cast(`{c}` as double)") if isinstance(c, str) else c.try_cast("double")


def load_nav(df: DataFrame, fund_id: str = "fund") -> DataFrame:
    """``(fund_id, trade_date, nav)`` of a raw table: the first of NAV_NAMES that it has; a cumulative NAV takes the unit NAV's place if
    the two differ by more than 1e-9 anywhere.  What is no number or date goes; of rows of a date the last stays."""
    df = df.select(*[F.col(f"`{c}`").alias(c.strip()) for c in df.columns])
    date, unit = pick(df, DATE_NAMES), pick(df, NAV_NAMES)
    more = "累计净值" if unit == "单位净值" and "累计净值" in df.columns else None
    rows = df.withColumn("__n", F.monotonically_increasing_id()).select(
        F.expr(f"if(year(try_cast(`{date}` as date)) between {YEARS[0]} and {YEARS[1]}, try_cast(`{date}` as date), null)").alias("trade_date"), number(unit).alias("nav"), (number(more) if more else F.lit(None).cast("double")).alias("__c"), "__n"
    )
    apart = rows.agg(F.max(F.abs(F.col("nav") - F.col("__c"))).alias("__d"))
    rows = rows.join(F.broadcast(apart), F.lit(True)).withColumn("nav", F.when(F.col("__d") > 1e-9, F.col("__c")).otherwise(F.col("nav")))
    rows = rows.where("trade_date is not null and nav is not null")
    last = F.row_number().over(Window.partitionBy("trade_date").orderBy(F.desc("__n")))
    return rows.withColumn("__r", last).where("__r = 1").select(F.lit(fund_id).alias("fund_id"), "trade_date", "nav")


def load_index_weights(df: DataFrame) -> DataFrame:
    """``([date,] code, weight)`` of a raw weight table."""
    date = pick(df, ["date"], required=False)
    cols = [F.col(pick(df, CODE_NAMES)).cast("string").alias("code"), number(pick(df, WEIGHT_NAMES)).alias("weight")]
    return df.select(*([F.to_date(date).alias("date")] if date else []), *cols)


def load_securities(df: DataFrame, active_only: bool = True) -> DataFrame:
    """A security master; by default only what is active, where it says so."""
    code = pick(df, CODE_NAMES)
    df = df.withColumnRenamed(code, "code")
    return df.where("status = 'Active'") if active_only and "status" in df.columns else df


def load_style_weights(path: str) -> dict[str, dict[str, float]]:
    """Weights of descriptors in styles, ``{style: {descriptor: weight}}``, from a settings file (also under ``styles`` there)."""
    found = load_settings(path)
    found = found.get("styles", found)
    return {s: {d: float(w) for d, w in of.items()} for s, of in found.items()}


def load_panel(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """A stored panel, sliced by dates (which reach the scan), NaN as null; an upsert that died is finished first."""
    settle(spark, path)
    return nan_to_null(between(spark.read.parquet(path), start, end))


def first_that_works(sources: list[tuple[str, Callable[[], DataFrame]]]) -> DataFrame:
    """The first source that can be read and isn't empty, with its name in ``source``; an error that names all if none is."""
    failed = []
    for name, load in sources:
        try:
            df = load()
            if df.head(1):
                return df.withColumn("source", F.lit(name))
            failed.append(f"{name}: empty")
        except Exception as e:  # noqa: BLE001 - the next source is tried, and all reasons are reported
            failed.append(f"{name}: {type(e).__name__}: {str(e)[:200]}")
    raise RuntimeError("no source works: " + "; ".join(failed))


# Names of industry sources' columns, in order.
INDUSTRY_CODES = ["first_industry_code", "industry_code", "index_code"]
INDUSTRY_NAMES = ["first_industry_name", "industry_name", "index_name"]


def load_industries(sources: list[tuple[str, Callable[[], DataFrame]]]) -> DataFrame:
    """``(stock_code, industry_code, industry_name, source)``, all strings, of the first source that works.

    Sources name their columns differently (CODE_NAMES, INDUSTRY_CODES, INDUSTRY_NAMES); a source that lacks one is an error, not a reason to
    try the next.  Codes get the terminal's suffixes; of repeated codes the smallest industry counts; rows without a code go.
    """
    found = first_that_works(sources)
    code, industry, name = (pick(found, names) for names in (CODE_NAMES, INDUSTRY_CODES, INDUSTRY_NAMES))
    rows = found.where(F.col(code).isNotNull()).select(to_terminal(F.col(code).cast("string")).alias("stock_code"), F.col(industry).cast("string").alias("industry_code"), F.col(name).cast("string").alias("industry_name"), "source")
    return rows.groupBy("stock_code").agg(F.min(F.struct("industry_code", "industry_name", "source")).alias("i")).select("stock_code", "i.*")


def annual_from_quarters(raw: DataFrame, latest_only: bool = True) -> DataFrame:
    """Annual rows ``(code, year, ...)`` of quarterly reports ``(code, quarter 'YYYYqN', info_date, ...)``; of a quarter's versions the newest."""
    q4 = raw.where(F.lower("quarter").endswith("q4")).withColumn("year", F.substring("quarter", 1, 4).cast("int"))
    if latest_only:
        q4 = q4.withColumn("__r", F.row_number().over(Window.partitionBy("code", "quarter").orderBy(F.desc_nulls_last("info_date")))).where("__r = 1").drop("__r")
    return q4.drop("quarter", "info_date")


def cached_reports(cache: DataFrame | None, fetch: Callable[[], DataFrame], first_year: int, last_year: int) -> DataFrame:
    """Annual reports out of a cache that covers the years asked for, else fetched and merged, newest first; if fetching fails, what the cache has."""
    if cache is not None:
        have = cache.agg(F.min("year").alias("a"), F.max("year").alias("z")).first()
        if have["a"] is not None and have["a"] <= first_year and have["z"] >= last_year:
            return cache.where(F.col("year").between(first_year, last_year))
    try:
        new = fetch()
    except Exception:
        if cache is None:
            raise
        return cache.where(F.col("year").between(first_year, last_year))
    if cache is not None:
        both = cache.withColumn("__v", F.lit(0)).unionByName(new.withColumn("__v", F.lit(1)))
        new = both.withColumn("__r", F.row_number().over(Window.partitionBy("code", "year").orderBy(F.desc("__v")))).where("__r = 1").drop("__r", "__v")
    return new.where(F.col("year").between(first_year, last_year))


def load_settings(path: str) -> dict:
    """Settings from JSON, or from YAML where a parser is installed."""
    with open(path, encoding="utf-8") as f:
        if path.endswith(".json"):
            return json.load(f)
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError("YAML settings need PyYAML; JSON works without it") from e
        return yaml.safe_load(f)
