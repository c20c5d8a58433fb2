"""Vendor extracts in batches of codes: declared fields and units, one task a batch, and a list of the batches that failed.

A vendor's interface serves some hundred codes at a time.  ``fetch(codes, fields, start, end)`` is whatever calls it and returns a pandas frame with the
vendor's names; here ``folder`` makes one over stored extracts.  Batches are rows, so executors fetch side by side, and each holds one
batch.  What a batch brings is checked against the table's declaration; a batch that fails is tried again and then listed with its
error, so that nobody takes a hole for a fact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.operators.panel import KEY
from riskloom.sources.sinks import latest_date, upsert_panel
from riskloom.sources.staging import staged

#: Codes of one request.
BATCH = 800
Fetch = Callable[[list[str], list[str], str, str], pd.DataFrame]


@dataclass(frozen=True)
class Field:
    """A column, the vendor's name for it, its unit, and what the vendor's numbers are multiplied by to get it."""

    name: str
    vendor: str
    unit: str
    scale: float = 1.0


# The vendor's field names, by table.
TABLES: dict[str, tuple[Field, ...]] = {
    "price": (
        Field("open", "open", "currency, adjusted"), Field("high", "high", "currency, adjusted"), Field("low", "low", "currency, adjusted"),
        Field("close", "close", "currency, adjusted"), Field("volume", "volume", "shares"), Field("total_turnover", "total_turnover", "currency"),
    ),
    "price_unadjusted": (Field("close_unadjusted", "close", "currency"),),
    "returns": (Field("ret", "ret", "fraction"),),
    "valuation": (
        Field("market_cap", "market_cap", "currency"), Field("float_cap", "a_share_market_val_in_circulation", "currency"), Field("pe", "pe_ratio", "ratio"),
        Field("pb", "pb_ratio", "ratio"), Field("ep_ttm", "ep_ratio_ttm", "ratio"), Field("pcf_ttm", "pcf_ratio_ttm", "ratio"),
    ),
    "turnover": (Field("turnover_rate", "today", "percent"),),
    "financial": (
        Field("total_assets", "total_assets", "currency"), Field("total_liabilities", "total_liabilities", "currency"),
        Field("non_current_liabilities", "non_current_liabilities", "currency"), Field("equity_parent", "equity_parent_company", "currency"),
        Field("cash_flow_ops", "cash_flow_from_operating_activities", "currency"), Field("basic_eps", "basic_earnings_per_share", "currency a share"),
        Field("operating_revenue", "operating_revenue", "currency"),
    ),
    "consensus": (
        Field("eps_ftm", "comp_con_eps_ftm", "currency a share"), Field("np_growth_t3", "comp_con_net_profit_growth_ratio_t3", "fraction or percent"),
        Field("np_growth_ftm", "comp_con_net_profit_growth_ratio_ftm", "fraction or percent"),
    ),
}
#: Names under which vendors give codes and dates.
CODES, DATES = ("order_book_id", "code"), ("date", "tradedate", "datetime", "trade_date")


def folder(root: str, table: str) -> Fetch:
    """A fetch over stored extracts, Parquet files in ``root/table``; codes, dates and columns reach the scan."""

    def fetch(codes: list[str], fields: list[str], start: str, end: str) -> pd.DataFrame:
        import pyarrow.dataset as ds

        found = ds.dataset(f"{root}/{table}", format="parquet")
        code, date = (next(n for n in names if n in found.schema.names) for names in (CODES, DATES))
        day = lambda x: pd.Timestamp(x).to_pydatetime().date()
        kept = ds.field(code).isin(codes) & (ds.field(date) >= day(start)) & (ds.field(date) <= day(end))
        return found.to_table(columns=[code, date, *fields], filter=kept).to_pandas()

    return fetch


def conformed(found: pd.DataFrame | None, fields: list[Field], codes: list[str], start: str, end: str) -> pd.DataFrame:
    """What a batch brought under the library's names: a row for each date and code, the first of several; infinities are missing.

    A missing field, a code that wasn't asked for, or a date out of range is an error; nothing at all is fine.
    """
    columns = ["trade_date", "code", *[f.name for f in fields]]
    if found is None or not len(found):
        return pd.DataFrame(columns=columns)
    if any(n is not None for n in found.index.names):
        found = found.reset_index()
    code, date = (next((n for n in names if n in found.columns), None) for names in (CODES, DATES))
    lacks = [n for n, c in (("code", code), ("date", date)) if c is None] + [f.vendor for f in fields if f.vendor not in found.columns]
    if lacks:
        raise ValueError(f"no {', '.join(lacks)} among {list(found.columns)}")
    out = pd.DataFrame({"trade_date": pd.to_datetime(found[date]).dt.date, "code": found[code].astype(str)})
    for f in fields:
        out[f.name] = (pd.to_numeric(found[f.vendor], errors="coerce") * f.scale).replace([float("inf"), float("-inf")], float("nan")).to_numpy()
    strange = set(out["code"]) - set(codes)
    if strange:
        raise ValueError(f"codes that weren't asked for: {sorted(strange)[:5]}")
    if len(out) and not (out["trade_date"].min() >= pd.Timestamp(start).date() and out["trade_date"].max() <= pd.Timestamp(end).date()):
        raise ValueError(f"dates out of {start} to {end}")
    return out.drop_duplicates(["trade_date", "code"])[columns]


def extract(codes: DataFrame, table: str, fetch: Fetch, start: str, end: str, names: list[str] | None = None, batch: int = BATCH, attempts: int = 2) -> tuple[DataFrame, DataFrame]:
    """``(rows, failed)`` of a table for the codes of ``codes(code)``: ``(trade_date, code, *fields)``, and ``(batch, codes, error)``.

    ``names`` are the fields wanted, all by default.  Null and repeated codes are asked for once or not at all; the universe, some thousand codes, is numbered by
    one task.  Both results read what was written once, so nothing is fetched twice.
    """
    fields = [f for f in TABLES[table] if names is None or f.name in names]
    unknown = set(names or []) - {f.name for f in fields}
    if unknown:
        raise ValueError(f"{table} has no {sorted(unknown)}")
    known = codes.where(F.col("code").isNotNull()).select(F.col("code").cast("string")).distinct()
    numbered = known.withColumn("batch", F.floor((F.row_number().over(Window.orderBy("code")) - 1) / batch).cast("int"))
    batches = numbered.groupBy("batch").agg(F.sort_array(F.collect_list("code")).alias("codes"))
    kinds = ", ".join(f"{f.name} double" for f in fields)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            for n, own in zip(df["batch"], df["codes"], strict=True):
                own, error = list(own), ""
                for _ in range(attempts):
                    try:
                        rows = conformed(fetch(own, [f.vendor for f in fields], start, end), fields, own, start, end)
                        yield rows.assign(__batch=n, __codes=None, __error=None)
                        break
                    except Exception as e:  # noqa: BLE001 - a failed batch is a result: it is listed
                        error = f"{type(e).__name__}: {str(e)[:500]}"
                else:
                    yield pd.DataFrame([{"trade_date": None, "code": None, **{f.name: None for f in fields}, "__batch": n, "__codes": own, "__error": error}])

    # A task for each batch, whatever the planner makes of so few rows.
    dealt = batches.repartition(max(1, -(-known.count() // batch)), "batch")
    out = staged(dealt.mapInPandas(run, f"trade_date date, code string, {kinds}, __batch int, __codes array<string>, __error string"), "extract")
    measures = [F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name) for f in fields]
    rows = out.where("__error is null").select(*KEY, *measures)
    return rows, out.where("__error is not null").select(F.col("__batch").alias("batch"), F.col("__codes").alias("codes"), F.col("__error").alias("error"))


def update(spark: SparkSession, codes: DataFrame, table: str, fetch: Fetch, path: str, first: str, end: str, batch: int = BATCH, allow_failures: bool = False) -> DataFrame:
    """Bring a stored table up to date from its high-water mark (``first`` where there is none); returns the failed batches.

    With a failed batch nothing is written, for the mark would pass over what is missing, unless ``allow_failures``.
    """
    rows, failed = extract(codes, table, fetch, latest_date(spark, path, first), end, batch=batch)
    lost = failed.limit(5).collect()
    if lost and not allow_failures:
        raise RuntimeError(f"{table}: batches failed and nothing was written: " + "; ".join(f"{r['batch']}: {r['error']}" for r in lost))
    upsert_panel(rows, path)
    return failed
