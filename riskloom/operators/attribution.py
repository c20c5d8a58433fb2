"""Attribution of fund returns to factors by rolling regression."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.rolling import simple_return

GROUPS = {"country": "Country", "industry": "Industry", "style": "Style"}
#: Equations whose smallest eigenvalue is below this share of the largest are solved by least squares on the window's own rows.
WEAK_EIGENVALUE = 1e-10


def window_betas(x: np.ndarray, r: np.ndarray, window: int) -> np.ndarray:
    """Least-squares coefficients of r on x, without intercept, of each full window of rows; of the least norm where x lacks rank.

    A window's matrix is the last one's with a row added and a row taken away: the difference of running sums of products, which begin
    anew with each call.  One step of refinement with the window's own residuals takes back what the sums have lost.
    """
    k = x.shape[1]
    both = np.concatenate([x, r[:, None]], axis=1)
    running = np.concatenate([np.zeros((1, k, k + 1)), np.cumsum(x[:, :, None] * both[:, None, :], axis=0)])
    moments = running[window:] - running[:-window]
    g, c = moments[:, :, :k], moments[:, :, k]
    betas = np.zeros((len(g), k))
    if not k:
        return betas
    values = np.linalg.eigvalsh(g)
    good = np.nonzero(values[:, 0] > WEAK_EIGENVALUE * np.maximum(values[:, -1], 1e-300))[0]
    rows = np.lib.stride_tricks.sliding_window_view(both, window, axis=0)
    if len(good):
        b = np.linalg.solve(g[good], c[good][:, :, None])[:, :, 0]
        for at in range(0, len(good), 64):
            part = good[at : at + 64]
            left = rows[part, k] - np.einsum("mkw,mk->mw", rows[part, :k], b[at : at + 64])
            b[at : at + 64] += np.linalg.solve(g[part], np.einsum("mkw,mw->mk", rows[part, :k], left)[:, :, None])[:, :, 0]
        betas[good] = b
    for i in np.setdiff1d(np.arange(len(g)), good):
        betas[i] = np.linalg.lstsq(rows[i, :k].T, rows[i, k], rcond=None)[0]
    return betas


def window_parts(x: np.ndarray, r: np.ndarray, window: int, first: int = 0) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(row, have, part)`` for each window that ends at row ``first`` or later and keeps its last row: which factors it has, and what they earn there.

    Factors without a value in the window leave it; rows that lack another count for nothing.  Windows with the same factors share their sums.
    """
    start = max(first, window - 1)
    if start >= len(x):
        return
    missing = np.isnan(x)
    seen = np.concatenate([np.zeros((1, x.shape[1]), dtype=np.int64), np.cumsum(~missing, axis=0)])
    have = (seen[window:] - seen[:-window] > 0)[start - window + 1 :]
    patterns, which = np.unique(have, axis=0, return_inverse=True)
    which = which.ravel()
    for p, pattern in enumerate(patterns):
        ends = start + np.nonzero(which == p)[0]
        lo, hi = ends[0] - window + 1, ends[-1] + 1
        whole = ~missing[lo:hi][:, pattern].any(axis=1)
        xs = np.where(whole[:, None], x[lo:hi][:, pattern], 0.0)
        betas = window_betas(xs, np.where(whole, r[lo:hi], 0.0), window)
        for end in ends:
            if whole[end - lo]:
                yield end, pattern, betas[end - lo - window + 1] * xs[end - lo]


def attribute(nav: DataFrame, returns: DataFrame, window: int = 252, block: int | None = None) -> DataFrame:
    """``(fund_id, trade_date, component, detail, value)``; a date's components Alpha, Country, Industry and Style add up to its return.

    ``nav(fund_id, trade_date, nav)``; ``returns(trade_date, factor_group, factor, value)``.  Windows of common dates; factors without a value
    in the window leave it, dates lacking another do, too, and a window that loses its last date gives nothing.
    Least squares without intercept, of the least norm.  ``detail`` names a style's own part and is null for the components.
    A group is a block of a fund's dates with the window before it, so a long history is many tasks; the factor table, a row per date, goes by broadcast.
    """
    block = block or max(window, 64)
    if block < window - 1:
        raise ValueError("a block holds a window at least")
    by_fund = Window.partitionBy("fund_id").orderBy("trade_date")
    own = nav.where(F.col("nav").isNotNull()).withColumn("r", simple_return("nav", by_fund)).where(F.col("r").isNotNull())
    table = returns.groupBy("trade_date").agg(F.sort_array(F.collect_list(F.struct("factor_group", "factor", "value"))).alias("f"))
    dated = own.join(table.select("trade_date"), "trade_date", "left_semi").withColumn("at", F.row_number().over(by_fund) - 1)
    home = F.floor(F.col("at") / block)
    next_too = F.when(F.col("at") % block > block - window, F.array(home, home + 1)).otherwise(F.array(home))
    blocks = dated.select("fund_id", "trade_date", "r", "at", F.explode(next_too).alias("block"))
    joined = blocks.join(F.broadcast(table), "trade_date").select("fund_id", "block", "at", "trade_date", "r", F.transform("f", lambda x: F.concat_ws("\t", x["factor_group"], x["factor"])).alias("names"), F.transform("f", lambda x: x["value"]).alias("values"))
    kind = nav.schema["fund_id"].dataType.simpleString()
    columns = ["fund_id", "trade_date", "component", "detail", "value"]

    def one_block(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values("at").reset_index(drop=True)
        names = sorted({n for row in df["names"] for n in row})
        at = {n: i for i, n in enumerate(names)}
        x = np.full((len(df), len(names)), np.nan)
        for i, (ns, vs) in enumerate(zip(df["names"], df["values"], strict=True)):
            for n, v in zip(ns, vs, strict=True):
                x[i, at[n]] = np.nan if v is None else v
        group, name = np.array([n.split("\t")[0] for n in names]), np.array([n.split("\t")[1] for n in names])
        first = int((df["at"] // block < df["block"]).sum())
        fund, days, r = df["fund_id"].iloc[0], df["trade_date"], df["r"].to_numpy(dtype=float)
        out: list[tuple] = []
        for end, have, part in window_parts(x, r, window, first):
            kept = group[have]
            out.append((fund, days.iloc[end], "Alpha", None, r[end] - part.sum()))
            out += [(fund, days.iloc[end], label, None, part[kept == g].sum()) for g, label in GROUPS.items()]
            out += [(fund, days.iloc[end], GROUPS["style"], n, p) for n, p, g in zip(name[have], part, kept, strict=True) if g == "style"]
        return pd.DataFrame(out, columns=columns)

    return joined.groupBy("fund_id", "block").applyInPandas(one_block, f"fund_id {kind}, trade_date date, component string, detail string, value double")


def identity_error(parts: DataFrame, nav: DataFrame) -> DataFrame:
    """Per fund: the greatest difference between a date's return and its components' sum."""
    own = nav.withColumn("r", simple_return("nav", Window.partitionBy("fund_id").orderBy("trade_date")))
    summed = parts.where("detail is null").groupBy("fund_id", "trade_date").agg(F.sum("value").alias("s"))
    return summed.join(own, ["fund_id", "trade_date"]).groupBy("fund_id").agg(F.max(F.abs(F.col("s") - F.col("r"))).alias("max_error"), F.count("*").alias("n_days"))
