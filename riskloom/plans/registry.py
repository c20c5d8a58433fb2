"""All queries of the library, each with its oracle where SQL can express it.

A query takes (spark, sf_dir) and reads whole tables.  Doubles are rounded alike on both sides of a comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.functions.codes import account_digits, is_stock_account, to_terminal, to_vendor, with_suffix
from riskloom.functions.dates import calendar_parts, report_effective_date
from riskloom.functions.numeric import rounded
from riskloom.operators import attribution, covariance, exposure, model, panel, performance, rolling, summaries, xsection
from riskloom.plans import oracle as sql
from riskloom.plans.descriptors import FACTORS, MONTHLY, ORTHOGONAL, STYLES, Windows, descriptors, excess, raw_descriptors, style_table
from riskloom.sources import driver_tables as t

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        if oracle:
            ORACLE[name or f.__name__] = oracle
        return f

    return add


def neat(df: DataFrame, keys: list[str], values: list[str], digits: int = 6) -> DataFrame:
    return df.select(*keys, *[rounded(F.col(v), digits).alias(v) for v in values])


def log_price():
    """Prices are compared as logarithms: quotients of short decimals are often exact ties for rounding."""
    return rounded(F.ln("price"), 8).alias("log_price")


KEY = ["trade_date", "code"]
WITH = f"with {sql.CELLS}"


# --- panel ---------------------------------------------------------------------------------------------------------
@query(f"{WITH} select trade_date, code, industry, round(market_cap, 5) + 0.0 as market_cap, round(ln(price), 8) + 0.0 as log_price from panel")
def panel_densify(spark, sf):
    p = t.monthly_panel(spark, sf)
    return p.select(*KEY, "industry", rounded(F.col("market_cap"), 5).alias("market_cap"), log_price())


@query("""
with c as (select cast(l_shipdate as date) as trade_date, s_nationkey as nk, sum(l_extendedprice) / sum(l_quantity) as price from lineitem join supplier on l_suppkey = s_suppkey group by 1, 2),
g as (select d.trade_date, n_nationkey as nk from (select distinct trade_date from c) d cross join nation)
select g.trade_date, cast(g.nk as varchar) as code,
       round(ln(last_value(price ignore nulls) over (partition by g.nk order by g.trade_date rows between unbounded preceding and current row)), 8) + 0.0 as log_price
from g left join c on c.trade_date = g.trade_date and c.nk = g.nk
""")
def panel_ffill_asof(spark, sf):
    return t.nation_days(spark, sf).select(*KEY, log_price())


@query(f"""
{WITH}, d as (select distinct cast(l_shipdate as date) as trade_date from lineitem)
select d.trade_date, round(last_value(r.rf ignore nulls) over (order by d.trade_date rows between unbounded preceding and current row), 6) + 0.0 as rf
from d left join rates r on r.trade_date = d.trade_date
""")
def align_rate(spark, sf):
    """Monthly rates on the daily calendar: those dated on a trading day, filled forward."""
    days = panel.calendar(t.table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("trade_date")))
    return neat(panel.align(t.rates(spark, sf), days, ["rf"]), ["trade_date"], ["rf"])


def _event_batches(spark, sf):
    e = t.table(spark, sf, "events").withColumns({"trade_date": F.to_date("ts"), "code": F.col("user_id").cast("string")})
    make = lambda odd, c: F.sum(F.when(F.col("event_id") % 2 == odd, F.col("value"))).alias(c)
    old = e.where("trade_date <= date'2024-01-20'").groupBy(*KEY).agg(make(0, "x"), F.count("*").alias("n"))
    new = e.where("trade_date >= date'2024-01-10'").groupBy(*KEY).agg(make(1, "x"), F.max("event_id").alias("last_event"))
    return old, new


@query("""
with e as (select *, cast(ts as date) as trade_date, cast(user_id as varchar) as code from events),
o as (select trade_date, code, sum(value) filter (event_id % 2 = 0) as x, count(*) as n from e where trade_date <= date '2024-01-20' group by 1, 2),
w as (select trade_date, code, sum(value) filter (event_id % 2 = 1) as x, max(event_id) as last_event from e where trade_date >= date '2024-01-10' group by 1, 2)
select coalesce(o.trade_date, w.trade_date) as trade_date, coalesce(o.code, w.code) as code, round(coalesce(w.x, o.x), 4) + 0.0 as x, n, last_event
from o full join w on o.trade_date = w.trade_date and o.code = w.code
""")
def upsert_latest_non_null(spark, sf):
    return neat(panel.upsert(*_event_batches(spark, sf)), [*KEY, "n", "last_event"], ["x"], 4)


@query("select coalesce(max(cast(ts as date)), date '2010-01-01') as latest from events")
def high_water_mark(spark, sf):
    return panel.high_water_mark(t.table(spark, sf, "events").select(F.to_date("ts").alias("trade_date")), "2010-01-01")


@query("select least((select max(cast(l_shipdate as date)) from lineitem), (select max(cast(o_orderdate as date)) from orders)) as latest")
def common_high_water_mark(spark, sf):
    frames = [t.table(spark, sf, n).select(F.to_date(c).alias("trade_date")) for n, c in (("lineitem", "l_shipdate"), ("orders", "o_orderdate"))]
    return panel.common_high_water_mark(frames, "2010-01-01")


@query("select cast(l_shipdate as date) as trade_date, cast(l_suppkey as varchar) as code, max(l_extendedprice) as value from lineitem group by 1, 2")
def dedupe_keep_max(spark, sf):
    li = t.table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("trade_date"), F.col("l_suppkey").cast("string").alias("code"), F.col("l_extendedprice").alias("value"))
    return panel.keep_largest(li, "value")


@query("select o_custkey, o_orderkey, cast(o_orderdate as date) as o_orderdate from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as k from orders) where k = 1")
def dedupe_keep_last(spark, sf):
    o = t.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return panel.keep_one(o, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).withColumn("o_orderdate", F.to_date("o_orderdate"))


@query("select trade_date, cast(year(trade_date) as integer) as year, cast(quarter(trade_date) as integer) as quarter, cast(month(trade_date) as integer) as month, cast(weekofyear(trade_date) as integer) as week from (select distinct cast(l_shipdate as date) as trade_date from lineitem)")
def trade_calendar_parts(spark, sf):
    return calendar_parts(panel.calendar(t.table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("trade_date"))).select("trade_date"))


@query(f"{WITH} select trade_date, " + ", ".join(f"round(sum(market_cap) filter (industry = '{i}'), 2) + 0.0 as \"{i}\"" for i in range(5)) + " from panel group by 1")
def long_to_wide_industries(spark, sf):
    """Market cap of all industries, a column each, which the table names; SQL lists the five that the regions are."""
    p = t.monthly_panel(spark, sf).where(F.col("industry").isNotNull()).groupBy("trade_date", F.col("industry").alias("code")).agg(F.sum("market_cap").alias("market_cap"))
    w = panel.to_wide(p, "market_cap")
    return w.select("trade_date", *[rounded(F.col(f"`{c}`"), 2).alias(c) for c in w.columns[1:]])


@query(f"{WITH} select trade_date, code, measure, round(value, 5) + 0.0 as value from (unpivot (select trade_date, code, market_cap, float_cap, liabilities from panel) on market_cap, float_cap, liabilities into name measure value value)")
def wide_to_long(spark, sf):
    p = t.monthly_panel(spark, sf).select(*KEY, "market_cap", "float_cap", "liabilities")
    return neat(panel.to_long(p, ids=("trade_date", "code"), variable="measure"), [*KEY, "measure"], ["value"], 5)


@query(f"{WITH}, s as (select min(idx) as i from cal where trade_date >= date '1998-06-15') select trade_date, code, round(ln(price), 8) + 0.0 as log_price from panel where idx >= greatest(1, (select i from s) - 23)")
def warm_up_slice(spark, sf):
    p = t.monthly_panel(spark, sf)
    return panel.warm_up(p, panel.calendar(p), "1998-06-15", 24).select(*KEY, log_price())


@query(f"{WITH}, {sql._filled()} select trade_date, code, round(fx, 6) + 0.0 as fx from filled")
def interior_fill(spark, sf):
    p = t.monthly_panel(spark, sf).withColumn("ex", F.col("ret") - F.col("rf") / 365)
    return neat(panel.interior_fill(p, {"fx": "ex"}), KEY, ["fx"])


@query("select distinct cast(o_orderdate as date) as trade_date from orders where cast(o_orderdate as date) not in (select cast(l_shipdate as date) from lineitem)")
def missing_dates(spark, sf):
    o, li = (t.table(spark, sf, n).select(F.to_date(c).alias("trade_date")) for n, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate")))
    return panel.missing_keys(o, li)


@query(f"{WITH} select trade_date, count(ret) / count(*) as share, count(*) as n from panel group by 1")
def completeness(spark, sf):
    return t.monthly_panel(spark, sf).groupBy("trade_date").agg((F.count("ret") / F.count("*")).alias("share"), F.count("*").alias("n"))


# --- codes and dates -------------------------------------------------------------------------------------------------
@query("""
with c as (select s_suppkey, lpad(cast((s_suppkey * 7919) % 1000000 as varchar), 6, '0') as bare, case s_suppkey % 4 when 0 then '.SH' when 1 then '.SZ' when 2 then '.BJ' else '.HK' end as suffix from supplier),
v as (select *, bare || replace(replace(replace(suffix, '.SH', '.XSHG'), '.SZ', '.XSHE'), '.BJ', '.XBJG') as vendor from c)
select s_suppkey, vendor, bare || suffix as terminal,
       bare || case when bare[1] = '6' then '.XSHG' when bare[1] in ('0', '3') then '.XSHE' when bare[1] in ('4', '8') then '.XBJG' else '' end as suffixed
from v
""")
def suffix_translate(spark, sf):
    bare = F.lpad(((F.col("s_suppkey") * 7919) % 1000000).cast("string"), 6, "0")
    suffix = F.get(F.array(*[F.lit(x) for x in (".SH", ".SZ", ".BJ", ".HK")]), (F.col("s_suppkey") % 4).cast("int"))
    c = t.table(spark, sf, "supplier").select("s_suppkey", bare.alias("bare"), F.concat(bare, suffix).alias("code")).withColumn("vendor", to_vendor(F.col("code")))
    return c.select("s_suppkey", "vendor", to_terminal(F.col("vendor")).alias("terminal"), with_suffix(F.col("bare")).alias("suffixed"))


@query(r"""
with a as (select p_partkey, case p_partkey % 4 when 0 then '1102' when 1 then '1102C1' when 2 then '3102' else '1102A' end || '0101' || lpad(cast(p_partkey as varchar), 6, '0') as account from part)
select p_partkey, regexp_matches(account, '^1102[0-9A-Z]{2}01\d{6}$') as is_stock,
       case when regexp_matches(account, '^1102[0-9A-Z]{2}01\d{6}$') then right(account, 6) else nullif(regexp_extract(account, '(\d{6})', 1), '') end as digits
from a
""")
def account_code_filter(spark, sf):
    head = F.get(F.array(*[F.lit(x) for x in ("1102", "1102C1", "3102", "1102A")]), (F.col("p_partkey") % 4).cast("int"))
    a = t.table(spark, sf, "part").select("p_partkey", F.concat(head, F.lit("0101"), F.lpad(F.col("p_partkey").cast("string"), 6, "0")).alias("account"))
    return a.select("p_partkey", is_stock_account(F.col("account")).alias("is_stock"), account_digits(F.col("account")).alias("digits"))


@query("select d as trade_date, make_date(case when month(d) <= 4 then year(d) - 1 else year(d) end, 4, 30) as report from (select distinct cast(l_shipdate as date) as d from lineitem)")
def report_in_force(spark, sf):
    d = t.table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("trade_date")).distinct()
    return d.select("trade_date", report_effective_date(F.col("trade_date")).alias("report"))


@query("""
select cast(s_nationkey as varchar) as fund_id, date '2001-10-31' as value_date,
       lpad(cast(s_suppkey as varchar), 6, '0') || case when lpad(cast(s_suppkey as varchar), 6, '0')[1] = '0' then '.XSHE' else '' end as code, s_acctbal as weight
from supplier
""")
def valuation_sheet(spark, sf):
    """Holdings parsed from sheets of text cells, one sheet per nation."""
    s = t.table(spark, sf, "supplier").select(F.col("s_nationkey").cast("string").alias("fund_id"), "s_suppkey", "s_name", "s_acctbal")
    body = s.select("fund_id", (F.col("s_suppkey") + 10).cast("int").alias("row_no"), F.array(F.concat(F.lit("1102C101"), F.lpad(F.col("s_suppkey").cast("string"), 6, "0")), "s_name", F.col("s_acctbal").cast("string")).alias("cells"))
    funds = s.select("fund_id").distinct()
    date = funds.select("fund_id", F.lit(0).alias("row_no"), F.array(F.lit("估值日期:2001-10-31"), F.lit(None).cast("string"), F.lit("")).alias("cells"))
    head = funds.select("fund_id", F.lit(3).alias("row_no"), F.array(F.lit(exposure.ACCOUNT_CAPTION), F.lit("科目名称"), F.lit(f"{exposure.WEIGHT_CAPTION}%")).alias("cells"))
    return exposure.parse_valuation_sheet(body.unionByName(date).unionByName(head))


@query("""
with q as (select cast(l_suppkey as varchar) as code, last_day(cast(date_trunc('quarter', l_shipdate) as date) + interval 2 month)::date as trade_date, sum(l_extendedprice) as s from lineitem group by 1, 2),
c as (select code, trade_date, sum(s) over (partition by code, year(trade_date) order by trade_date) as v, dense_rank() over (order by trade_date) as i from q)
select a.code, a.trade_date, round(case when a.i > 4 then case when month(a.trade_date) = 12 then a.v else f.v + a.v - p.v end end, 2) + 0.0 as ttm
from c a left join c f on f.code = a.code and f.trade_date = make_date(year(a.trade_date) - 1, 12, 31)
left join c p on p.code = a.code and year(p.trade_date) = year(a.trade_date) - 1 and month(p.trade_date) = month(a.trade_date)
""")
def ttm(spark, sf):
    end = F.last_day(F.add_months(F.to_date(F.date_trunc("quarter", "l_shipdate")), 2))
    q = t.table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").cast("string").alias("code"), end.alias("trade_date")).agg(F.sum("l_extendedprice").alias("s"))
    q = q.withColumn("v", F.sum("s").over(Window.partitionBy("code", F.year("trade_date")).orderBy("trade_date")))
    return neat(rolling.trailing_twelve_months(q, "v"), ["code", "trade_date"], ["ttm"], 2)


# --- cross-section -----------------------------------------------------------------------------------------------------
@query(f"{WITH} select trade_date, code, round(float_cap / sum(float_cap) over (partition by trade_date), 8) + 0.0 as w from panel")
def cap_weights(spark, sf):
    return neat(t.monthly_panel(spark, sf).withColumn("w", xsection.cap_weight("float_cap")), KEY, ["w"], 8)


@query(f"{WITH} select trade_date, code, round(sqrt(float_cap) / sum(sqrt(float_cap)) over (partition by trade_date), 8) + 0.0 as w from panel")
def sqrt_cap_weights(spark, sf):
    return neat(t.monthly_panel(spark, sf).withColumn("w", xsection.sqrt_cap_weight("float_cap")), KEY, ["w"], 8)


@query(f"{WITH}, w as (select *, float_cap / sum(float_cap) over (partition by trade_date) as w from panel) select trade_date, round(coalesce(sum(w * ret), 0), 8) + 0.0 as mean_ret from w group by 1")
def weighted_mean_xs(spark, sf):
    p = t.monthly_panel(spark, sf).withColumn("w", xsection.cap_weight("float_cap"))
    p = p.withColumn("mean_ret", xsection.weighted_mean("ret", F.col("w")))
    return neat(p.groupBy("trade_date").agg(F.first("mean_ret").alias("mean_ret")), ["trade_date"], ["mean_ret"], 8)


@query(f"{WITH}, s as (select *, avg(ret) over d as m, stddev_samp(ret) over d as s from panel window d as (partition by trade_date)) select trade_date, code, round(case when ret is not null and s is not null then greatest(m - 1.5 * s, least(m + 1.5 * s, ret)) end, 6) + 0.0 as x from s")
def winsorize_xs(spark, sf):
    return neat(xsection.winsorize(t.monthly_panel(spark, sf), "ret", "x", threshold=1.5), KEY, ["x"])


@query(f"{WITH}, r as (select trade_date, code, float_cap, ret as x from panel), {sql.standardised('r')} select trade_date, code, round(x, 6) + 0.0 as ret from z")
def standardize_xs(spark, sf):
    return neat(xsection.standardize(t.monthly_panel(spark, sf), ["ret"]), KEY, ["ret"])


@query(f"{WITH} select trade_date, code, round(case when (select median(abs(tax * 100)) from panel) > 1 then tax * 100 / 100 else tax * 100 end, 8) + 0.0 as x from panel")
def unit_detection(spark, sf):
    return neat(xsection.unit_scaled(t.monthly_panel(spark, sf).withColumn("x", F.col("tax") * 100), ["x"]), KEY, ["x"], 8)


# --- descriptors ---------------------------------------------------------------------------------------------------------
def _monthly(spark, sf, wanted=None) -> DataFrame:
    more = {"reports": t.annual_reports(spark, sf)} if wanted is None or "growth" in wanted else {}
    return descriptors(t.monthly_panel(spark, sf), MONTHLY, wanted, **more)


def _descriptor(name: str, factor: str) -> Query:
    def run(spark, sf):
        raw = _monthly(spark, sf, [factor]).where(F.col(name).isNotNull())
        return neat(raw, KEY, [name])

    return run


for _factor, _entry in FACTORS.items():
    for _name in _entry.outputs:
        if _name in sql.RAW:
            query(sql.descriptor(_name), _name)(_descriptor(_name, _factor))
query(f"{WITH}, {sql.nlsize_ctes()} select trade_date, code, round(x, 6) + 0.0 as nlsize from nl where x is not null", "nlsize")(_descriptor("nlsize", "size"))
query(sql.descriptor("sigma").replace("as sigma from", "as hsigma from"), "hsigma")(_descriptor("hsigma", "volatility"))


@query("""
with c as (select cast(l_shipdate as date) as trade_date, s_nationkey as nk, sum(l_extendedprice) / sum(l_quantity) as price, sum(l_quantity) / 100 as turnover from lineitem join supplier on l_suppkey = s_suppkey group by 1, 2),
cal as (select trade_date, row_number() over (order by trade_date) as idx from (select distinct trade_date from c)),
g as (select cal.trade_date, idx, n_nationkey as nk, turnover, last_value(price ignore nulls) over (partition by n_nationkey order by idx rows between unbounded preceding and current row) as price
      from cal cross join nation left join c on c.trade_date = cal.trade_date and c.nk = n_nationkey),
r as (select *, price / lag(price) over (partition by nk order by idx) - 1 as ret from g),
m as (select *, avg(ret) over (partition by trade_date) as rt, min(case when ret is not null then idx end) over () as f from r),
q as (select *, pow(2.0, idx / 63.0) as u, coalesce(ret, 0) as y, coalesce(rt, 0) as v from m),
s as (select *, sum(u) over w as s0, sum(u * v) over w as sx, sum(u * y) over w as sy, sum(u * v * v) over w as sxx, sum(u * v * y) over w as sxy,
             count(case when idx >= f then 1 end) over w as n, count(ret) over w as ny, count(rt) over w as nx
      from q window w as (partition by nk order by idx rows between 251 preceding and current row))
select trade_date, cast(nk as varchar) as code, round((sxy / s0 - sx / s0 * sy / s0) / nullif(sxx / s0 - sx / s0 * sx / s0, 0), 6) + 0.0 as beta
from s where n = 252 and n - ny <= 42 and n - nx <= 42
""")
def beta_daily(spark, sf):
    """Beta with the default window of 252 days on the daily panel of nations."""
    p = t.nation_days(spark, sf).withColumn("from_", F.min(F.when(F.col("rt").isNotNull(), F.col("idx"))).over(Window.partitionBy("code")))
    b = rolling.rolling_wls(p, "ret", "rt", *Windows().beta, active=F.col("idx") >= F.col("from_"))
    return neat(b.where(F.col("beta").isNotNull()), KEY, ["beta"])


def _daily(name: str, factor: str) -> Query:
    def run(spark, sf):
        p = excess(t.nation_days(spark, sf).withColumn("rf", F.lit(0.0)), Windows())
        return neat(FACTORS[factor].add(p, Windows(), {}).where(F.col(name).isNotNull()), KEY, [name])

    return run


for _name, _factor in {"rstr": "momentum", "dastd": "volatility", "cmra": "volatility", "stom": "liquidity", "stoq": "liquidity", "stoa": "liquidity"}.items():
    query(sql.daily(_name), f"{_name}_daily")(_daily(_name, _factor))


# --- styles and factor returns ---------------------------------------------------------------------------------------------
@query(f"{WITH}, {sql.joined(['stom', 'stoq', 'stoa'])} select trade_date, code, round(stom * 0.35 + stoq * 0.35 + stoa * 0.30, 6) + 0.0 as liquidity from d")
def compose_style(spark, sf):
    d = model.compose(_monthly(spark, sf, ["liquidity"]), "liquidity", STYLES["liquidity"])
    return neat(d, KEY, ["liquidity"])


def _orthogonal(style: str, parts: list[str], refs: dict[str, str]) -> str:
    names = list(dict.fromkeys([*parts, *refs.values()]))
    combined = " + ".join(f"{'sigma' if p == 'hsigma' else p} * {w}" for p, w in STYLES[style].items())
    ref_cols = ", ".join(f"{d} as r_{s}" for s, d in refs.items())
    return (
        f"{WITH}, {sql.joined(names)}, c as (select trade_date, code, float_cap, {combined} as y, {ref_cols} from d), {sql.residuals('c', 'y', [f'r_{s}' for s in refs], 'res', 'x')}, "
        f"{sql.standardised('res')} select trade_date, code, round(x, 6) + 0.0 as {style} from z"
    )


@query(_orthogonal("liquidity", ["stom", "stoq", "stoa"], {"size": "lncap"}))
def orthogonalize_1(spark, sf):
    return neat(style_table(_monthly(spark, sf, ["liquidity", "size"]), orthogonal={"liquidity": ORTHOGONAL["liquidity"]}), KEY, ["liquidity"])


@query(_orthogonal("residual_volatility", ["dastd", "cmra", "sigma"], {"beta": "beta", "size": "lncap"}))
def orthogonalize_2(spark, sf):
    return neat(style_table(_monthly(spark, sf, ["volatility", "size"])), KEY, ["residual_volatility"])


_PLAIN = ["size", "beta", "momentum", "book_to_price", "earnings_yield", "growth", "leverage"]
_PARTS = list(dict.fromkeys(d for s in _PLAIN for d in STYLES[s]))


@query(f"{WITH}, {sql.joined(_PARTS)} select trade_date, code, " + ", ".join("round(" + " + ".join(f"d.{d} * {w}" for d, w in STYLES[s].items()) + f", 6) + 0.0 as {s}" for s in _PLAIN) + " from d")
def style_table_plain(spark, sf):
    """The seven styles that need neither regression nor orthogonalisation."""
    return neat(style_table(_monthly(spark, sf), plain=True), KEY, _PLAIN)


_ALL = f"""select p.*, residual_volatility, liquidity, nlsize as non_linear_size from ({ORACLE["style_table_plain"]}) p
left join ({ORACLE["orthogonalize_1"]}) using (trade_date, code) left join ({ORACLE["orthogonalize_2"]}) using (trade_date, code) left join ({ORACLE["nlsize"]}) using (trade_date, code)"""


@query(_ALL, name="style_table")
def all_styles(spark, sf):
    return neat(style_table(_monthly(spark, sf)), KEY, list(STYLES))


@query(f"{WITH}, s as (select *, sqrt(float_cap) / sum(sqrt(float_cap)) over (partition by trade_date) as w from panel where ret is not null and float_cap > 0) select trade_date, industry, round(sum(w), 8) + 0.0 as weight from s group by 1, 2")
def industry_weights(spark, sf):
    return neat(model.industry_weights(model.estimation_sample(t.monthly_panel(spark, sf))), ["trade_date", "industry"], ["weight"], 8)


_RETURNS = "select trade_date, factor_group, factor, round(value, 6) + 0.0 as value from f"
_SIZED = f"{WITH}, {sql.RAW['lncap']}, {sql.standardised('raw')}, sz as (select * exclude (x), x as size from z)"
RETURN_KEY = ["trade_date", "factor_group", "factor"]


def _sized(spark, sf) -> DataFrame:
    return xsection.standardize(t.monthly_panel(spark, sf).withColumn("size", F.ln("market_cap")), ["size"])


@query(f"{WITH}, {sql.fwl([], 'panel')} {_RETURNS}")
def factor_return_industry(spark, sf):
    return neat(model.factor_returns(t.monthly_panel(spark, sf), []), RETURN_KEY, ["value"])


@query(f"{_SIZED}, {sql.fwl(['size'], 'sz')} {_RETURNS}")
def factor_return_style1(spark, sf):
    """The dense solve of each date, held against the closed form."""
    return neat(model.factor_returns(_sized(spark, sf), ["size"]), RETURN_KEY, ["value"])


@query(f"{WITH}, {sql.joined(['lncap', 'btop'])}, {sql.fwl(['lncap', 'btop'], 'd')} {_RETURNS}")
def factor_return_style2(spark, sf):
    """Two styles without Python."""
    return neat(model.factor_returns_native(_monthly(spark, sf, ["size", "value"]), ["lncap", "btop"]), RETURN_KEY, ["value"])


def full_factor_returns(spark, sf) -> DataFrame:
    return model.factor_returns(style_table(_monthly(spark, sf)), list(STYLES))


#: The ten styles as they are, with what a regression needs of the panel.
_EXPOSED = f"""
exposed as (select s.*, industry, ret, float_cap from ({_ALL.replace(", 6) + 0.0", ", 15) + 0.0")}) s join (with {sql.CELLS} select trade_date, code, industry, ret, float_cap from panel) using (trade_date, code))"""


@query(f"with recursive {_EXPOSED}, {sql.many_styles(list(STYLES), 'exposed')} {_RETURNS}")
def factor_return_full(spark, sf):
    """All ten styles."""
    return neat(full_factor_returns(spark, sf), RETURN_KEY, ["value"])


@query(f"""{WITH}, {sql.fwl([], 'panel')},
x as (select *, dense_rank() over (order by trade_date desc) - 1 as age from f),
p as (select a.factor as factor_a, b.factor as factor_b, a.value as x, b.value as y, pow(0.5, a.age / 12.0) as v, pow(0.5, a.age / 36.0) as c from x a join x b on a.trade_date = b.trade_date and a.factor <= b.factor),
m as (select *, x - sum(c * x) over k / sum(c) over k as dx, y - sum(c * y) over k / sum(c) over k as dy, x - sum(v * x) over k / sum(v) over k as ux from p window k as (partition by factor_a, factor_b)),
r as (select factor_a, factor_b, count(*) as n, sum(c * dx * dy) / sqrt(sum(c * dx * dx) * sum(c * dy * dy)) * case when factor_a = factor_b then 1 else 0.9 end as r, sqrt(sum(v * ux * ux) / sum(v)) as s from m group by 1, 2),
s as (select factor_a as f, s from r where factor_a = factor_b)
select factor_a, factor_b, n, round(r, 6) + 0.0 as correlation, round(r * a.s * b.s, 8) + 0.0 as covariance from r join s a on a.f = factor_a join s b on b.f = factor_b
""")
def factor_covariance(spark, sf):
    """Country and industries, with half-lives of 12 and 36 months and a tenth of shrinkage."""
    found = covariance.factor_covariance(_industry_returns(spark, sf), 12, 36, 0.1)
    return found.select("factor_a", "factor_b", "n", rounded(F.col("correlation"), 6).alias("correlation"), rounded(F.col("covariance"), 8).alias("covariance"))


@query(f"{_SIZED}, {sql.fwl(['size'], 'sz')} select trade_date, 0.0::double as residual from fit")
def normal_equations(spark, sf):
    """What a date's factors leave over is orthogonal to each of them, held against 0 for industries and size."""
    s = _sized(spark, sf)
    return neat(model.normal_residual(s, model.factor_returns(s, ["size"]), ["size"]), ["trade_date"], ["residual"])


@query()
def normal_equations_full(spark, sf):
    """The same with all ten styles; which dates have enough rows for them depends on the styles."""
    styles = style_table(_monthly(spark, sf))
    return neat(model.normal_residual(styles, model.factor_returns(styles, list(STYLES)), list(STYLES)), ["trade_date"], ["residual"])


_PARTS_SQL = f"{_SIZED.replace('with', 'with recursive', 1)}, {sql.fwl(['size'], 'sz')}, {sql.attribution(24)}"


@query(f"{_PARTS_SQL}, a as (select fund_id, detail as style, avg(value) * 12 as annualised from parts where detail is not null group by 1, 2) select fund_id, style, cast(row_number() over (partition by fund_id order by annualised desc, style) as integer) as place, round(annualised, 6) + 0.0 as annualised from a")
def style_ranking(spark, sf):
    return neat(summaries.ranked_styles(_attributed(spark, sf)[0], 12), ["fund_id", "style", "place"], ["annualised"])


@query(f"{_SIZED}, {sql.fwl(['size'], 'sz')} select trade_date, round(fc, 6) + 0.0 as country, round(fc, 6) + 0.0 as implied from ctry")
def country_identity(spark, sf):
    s = _sized(spark, sf)
    return neat(model.country_identity(s, model.factor_returns(s, ["size"]), ["size"]), ["trade_date"], ["country", "implied"])


@query(f"{_SIZED}, {sql.fwl(['size'], 'sz')} select trade_date, 0.0::double as residual from fit")
def constraint_residual(spark, sf):
    s = _sized(spark, sf)
    returns = model.factor_returns(s, ["size"])
    return neat(model.constraint_residual(returns, model.industry_weights(model.estimation_sample(s))), ["trade_date"], ["residual"])


# --- exposures -----------------------------------------------------------------------------------------------------------------
@query("""
with v as (select cast(o_custkey as varchar) as fund_id, cast(o_orderdate as date) as value_date from orders group by 1, 2),
d as (select distinct cast(date_trunc('month', l_shipdate) as date) as trade_date from lineitem)
select fund_id, value_date, (select max(trade_date) from d where trade_date <= value_date) as trade_date from v
""")
def asof_factor_date(spark, sf):
    o = t.table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("fund_id"), F.to_date("o_orderdate").alias("value_date")).distinct()
    return exposure.as_of_dates(o, t.table(spark, sf, "lineitem").select(t.month("l_shipdate").alias("trade_date")).distinct())


@query(f"{_SIZED}, g as (select trade_date, count(size) >= 0.5 * (select count(*) from uni where industry = '1') as ok from sz where industry = '1' group by 1) select coalesce(max(trade_date) filter (ok), min(trade_date)) as trade_date from g")
def last_complete_date(spark, sf):
    members = t.securities(spark, sf).where("industry = '1'").select("code")
    return exposure.last_complete_date(_sized(spark, sf), members)


_HELD = f"""{_SIZED}, l as (select max(trade_date) as d from panel),
h as (select industry as fund_id, (select d from l) + 9 as value_date, code, float_cap / sum(float_cap) over (partition by industry) as w from panel where trade_date = (select d from l) and float_cap > 0)"""


@query(f"{_HELD} select h.fund_id, h.value_date, (select d from l) as trade_date, 'size' as style, round(sum(w * coalesce(size, 0)), 6) + 0.0 as exposure, count(size) as covered from h left join sz on sz.code = h.code and sz.trade_date = (select d from l) group by 1, 2")
def fund_exposure(spark, sf):
    s = _sized(spark, sf)
    return neat(exposure.fund_exposure(t.region_holdings(t.monthly_panel(spark, sf)), s, ["size"]), ["fund_id", "value_date", "trade_date", "style", "covered"], ["exposure"])


@query(f"{_SIZED}, w as (select trade_date, code, float_cap / sum(float_cap) over (partition by trade_date) as w from panel where industry = '1' and float_cap is not null) select trade_date, 'size' as style, round(sum(w * coalesce(size, 0)), 6) + 0.0 as exposure, count(size) as covered from w left join sz using (trade_date, code) group by 1")
def index_exposure_dated(spark, sf):
    w = t.monthly_panel(spark, sf).where("industry = '1'").select(F.col("trade_date").alias("date"), "code", F.col("float_cap").alias("weight"))
    return neat(exposure.index_exposure(w, _sized(spark, sf), ["size"]), ["trade_date", "style", "covered"], ["exposure"])


@query(f"{_SIZED}, c as (select max(trade_date) as d from (select trade_date, count(size) as n from sz where industry = '1' group by 1) where n >= 0.5 * (select count(*) from uni where industry = '1')), m as (select code, 1.0 / count(*) over () as w from uni where industry = '1') select d as trade_date, 'size' as style, round(sum(w * coalesce(size, 0)), 6) + 0.0 as exposure, count(size) as covered from m cross join c left join sz on sz.code = m.code and sz.trade_date = d group by 1")
def index_exposure_snapshot(spark, sf):
    w = t.securities(spark, sf).where("industry = '1'").select("code", F.lit(1.0).alias("weight"))
    return neat(exposure.index_exposure(w, _sized(spark, sf), ["size"]), ["trade_date", "style", "covered"], ["exposure"])


# --- attribution and summaries -----------------------------------------------------------------------------------------------------
def _attributed(spark, sf) -> tuple[DataFrame, DataFrame]:
    nav = t.region_nav_monthly(t.monthly_panel(spark, sf))
    return attribution.attribute(nav, model.factor_returns(_sized(spark, sf), ["size"]), 24), nav


@query(f"{_PARTS_SQL} select fund_id, trade_date, component, detail, round(value, 6) + 0.0 as value from parts", name="attribution")
def rolling_attribution(spark, sf):
    """Rolling regressions without intercept; the SQL solves windows of full rank, which these are."""
    return neat(_attributed(spark, sf)[0], ["fund_id", "trade_date", "component", "detail"], ["value"])


@query(f"{WITH}, n as (select industry as fund_id, trade_date from panel where price is not null group by 1, 2) select distinct fund_id, 0.0::double as max_error from n")
def attribution_identity(spark, sf):
    return neat(attribution.identity_error(*_attributed(spark, sf)), ["fund_id"], ["max_error"])


@query(f"{_PARTS_SQL}, a as (select fund_id, component, avg(value) * 12 as annualised from parts where detail is null group by 1, 2) select fund_id, component, round(annualised, 6) + 0.0 as annualised, round(annualised / nullif(sum(annualised) over (partition by fund_id), 0), 6) + 0.0 as share from a")
def attribution_shares(spark, sf):
    return neat(summaries.contribution_shares(_attributed(spark, sf)[0], 12), ["fund_id", "component"], ["annualised", "share"])


_IND = f"{WITH}, {sql.fwl([], 'panel')}"


def _industry_returns(spark, sf) -> DataFrame:
    return model.factor_returns_native(t.monthly_panel(spark, sf), [])


@query(f"{_IND} select trade_date, factor, round(product(1 + value) over (partition by factor order by trade_date) - 1, 6) + 0.0 as cumulative from f")
def cumulative_return(spark, sf):
    return neat(summaries.cumulative(_industry_returns(spark, sf)), ["trade_date", "factor"], ["cumulative"])


@query(f"with {sql.DAYS}, r as (select fund_id, trade_date, nav / lag(nav) over (partition by fund_id order by trade_date) - 1 as value from nav) select fund_id as factor, cast(date_trunc('month', trade_date) as date) as month, round(sum(value), 6) + 0.0 as value from r where value is not null group by 1, 2")
def monthly_factor_return(spark, sf):
    return neat(summaries.monthly(_nav_returns(spark, sf)), ["factor", "month"], ["value"])


def _nav_returns(spark, sf) -> DataFrame:
    n = t.region_nav(spark, sf).withColumnRenamed("fund_id", "factor")
    return n.withColumn("value", rolling.simple_return("nav", Window.partitionBy("factor").orderBy("trade_date"))).where(F.col("value").isNotNull())


@query(f"{_IND}, c as (select *, count(value) over w as n, stddev_samp(value) over w as s from f window w as (partition by factor order by trade_date rows between 11 preceding and current row)) select trade_date, factor, round(case when n = 12 then s * sqrt(242.0) end, 6) + 0.0 as volatility from c")
def rolling_vol(spark, sf):
    return neat(summaries.rolling_volatility(_industry_returns(spark, sf), 12), ["trade_date", "factor"], ["volatility"])


@query(f"{_IND}, s as (select factor, count(*) as n, product(1 + value) - 1 as c, stddev_samp(value) * sqrt(12.0) as v from f group by 1), a as (select *, case when c > -1 then pow(1 + c, 12.0 / n) - 1 end as a from s) select factor, n, round(c, 6) + 0.0 as cumulative, round(a, 6) + 0.0 as annualised, round(v, 6) + 0.0 as volatility, round(a / nullif(v, 0), 6) + 0.0 as sharpe from a")
def factor_summary(spark, sf):
    return neat(summaries.summary(_industry_returns(spark, sf), per_year=12), ["factor", "n"], ["cumulative", "annualised", "volatility", "sharpe"])


_PERF = ["cumulative", "annualised", "volatility", "downside", "ret_1m", "ret_3m", "ret_6m", "ret_12m", "ret_ytd", "max_drawdown", "win_rate", "profit_loss", "mean_week", "min_week", "vol_week", "sharpe", "calmar", "sortino"]
_COUNTS = ["fund_id", "n_periods", "drawdown_start", "drawdown_end", "n_weeks", "n_wins", "n_losses", "longest_losing"]


def _performance(period: str) -> Query:
    def run(spark, sf):
        dates = t.table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("trade_date")).distinct()
        return neat(performance.performance(t.region_nav(spark, sf), dates, period), _COUNTS, _PERF)

    return run


query(sql.performance("d"), "perf_daily")(_performance("d"))
query(sql.performance("w"), "perf_weekly")(_performance("w"))


@query(f"with {sql.DAYS}, k as (select *, max(nav) over (partition by fund_id order by trade_date) as peak from nav), r as (select *, (peak - nav) / peak as fall, row_number() over (partition by fund_id order by (peak - nav) / peak desc, trade_date) as k from k) select fund_id, round(-fall, 6) + 0.0 as max_drawdown, case when fall > 0 then trade_date end as drawdown_end from r where k = 1")
def max_drawdown(spark, sf):
    return neat(performance.max_drawdown(t.region_nav(spark, sf)), ["fund_id", "drawdown_end"], ["max_drawdown"])


@query(f"with {sql.DAYS}, e as (select *, max(trade_date) over (partition by fund_id) as e from nav) select fund_id, " + ", ".join(f"round(arg_max(nav, trade_date) / arg_min(nav, trade_date) filter (trade_date >= (e - interval {m} month)::date) - 1, 6) + 0.0 as ret_{m}m" for m in (1, 3, 6, 12)) + ", round(arg_max(nav, trade_date) / arg_min(nav, trade_date) filter (year(trade_date) = year(e)) - 1, 6) + 0.0 as ret_ytd from e group by 1")
def trailing_returns(spark, sf):
    return neat(performance.trailing_returns(t.region_nav(spark, sf)), ["fund_id"], ["ret_1m", "ret_3m", "ret_6m", "ret_12m", "ret_ytd"])


@query(f"with {sql.DAYS}, r as (select *, coalesce(nav > lag(nav) over (partition by fund_id order by trade_date), false) as win from nav), g as (select *, sum(case when win then 1 else 0 end) over (partition by fund_id order by trade_date) as g from r) select fund_id, trade_date, cast(sum(case when win then 0 else 1 end) over (partition by fund_id, g order by trade_date) as bigint) as streak from g")
def losing_streak(spark, sf):
    w = Window.partitionBy("fund_id").orderBy("trade_date")
    n = t.region_nav(spark, sf).withColumn("win", F.coalesce(F.col("nav") > F.lag("nav").over(w), F.lit(False)))
    return rolling.losing_streak(n, "win", "fund_id", "trade_date").select("fund_id", "trade_date", "streak")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly constrained factor returns on industries and size.  (The smallest tables have too few securities for all ten styles.)"""
    return factor_return_style1(spark, sf_dir)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


__all__ = ["flagship", "oracle_sql", "queries", "raw_descriptors"]
