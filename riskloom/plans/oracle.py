"""The registered queries in DuckDB's SQL, over the same tables."""

from __future__ import annotations

from riskloom.plans.descriptors import MONTHLY as M
from riskloom.plans.descriptors import Windows

CELLS = """
cells as (
  select cast(date_trunc('month', l_shipdate) as date) as trade_date, cast(l_suppkey as varchar) as code, sum(l_extendedprice) as market_cap,
         sum(l_extendedprice * (1 - l_discount)) as float_cap, sum(l_quantity) as quantity,
         sum(case when l_returnflag = 'R' then l_extendedprice end) as liabilities, sum(case when l_returnflag = 'N' then l_extendedprice end) as equity,
         sum(case when l_returnflag = 'A' then l_extendedprice end) as ncl, avg(l_tax) as tax, avg(l_discount) as discount
  from lineitem group by 1, 2
),
cal as (select trade_date, row_number() over (order by trade_date) as idx from (select distinct trade_date from cells)),
uni as (select cast(s_suppkey as varchar) as code, cast(n_regionkey as varchar) as industry from supplier join nation on s_nationkey = n_nationkey),
grid as (
  select cal.trade_date, idx, uni.code, industry, cells.* exclude (trade_date, code), market_cap / nullif(quantity, 0) as price
  from cal cross join uni left join cells on cells.trade_date = cal.trade_date and cells.code = uni.code
),
priced as (select *, price / lag(price) over (partition by code order by idx) - 1 as ret, quantity / 100 as turnover from grid),
rates as (select cast(date_trunc('month', l_shipdate) as date) as trade_date, avg(l_discount) as rf from lineitem group by 1),
bench as (select trade_date, sum(float_cap * ret) / sum(float_cap) filter (ret is not null) as rt from priced group by 1),
panel as (
  select p.*, rf, rt, ret - rf / 365 as ex, ln(1 + ret) - ln(1 + rf / 365) as lx, rt - rf / 365 as bx
  from priced p join rates using (trade_date) join bench using (trade_date)
)"""


def standardised(raw: str, x: str = "x", name: str = "z", cap: str = "float_cap") -> str:
    """CTEs that standardise ``x`` of ``raw`` into the column ``x`` of ``name``."""
    return f"""
{name}1 as (select *, {cap} / nullif(sum({cap}) over (partition by trade_date), 0) as w from {raw}),
{name}2 as (select *, coalesce(sum(w * {x}) over d, 0) as wm, stddev_samp({x}) over d as sd from {name}1 window d as (partition by trade_date)),
{name}3 as (select * exclude ({x}), case when {x} is not null and sd is not null then greatest(wm - 3 * sd, least(wm + 3 * sd, {x})) end as {x} from {name}2),
{name}4 as (select *, stddev_samp({x}) over (partition by trade_date) as sd2 from {name}3),
{name} as (select * exclude ({x}, w, wm, sd, sd2), ({x} - wm) / nullif(sd2, 0) as {x} from {name}4)"""


def residuals(raw: str, y: str, refs: list[str], name: str, out: str = "x") -> str:
    """CTEs that regress y of ``raw`` on one or two references with root-cap weights into the column ``out`` of ``name``."""
    ok = " and ".join(f"{c} is not null" for c in [y, *refs, "float_cap"])
    cols = {"y": y} | {f"x{i}": r for i, r in enumerate(refs)}
    means = ", ".join(f"{c} - sum(u * {c}) over d / nullif(sum(u) over d, 0) as c_{k}" for k, c in cols.items())
    sums = {"xx": "sum(u * c_x0 * c_x0) over d", "xy": "sum(u * c_x0 * c_y) over d"}
    fit = "xy / nullif(xx, 0) * c_x0"
    if len(refs) == 2:
        sums |= {"zz": "sum(u * c_x1 * c_x1) over d", "xz": "sum(u * c_x0 * c_x1) over d", "zy": "sum(u * c_x1 * c_y) over d"}
        fit = "(xy * zz - zy * xz) / nullif(xx * zz - xz * xz, 0) * c_x0 + (zy * xx - xy * xz) / nullif(xx * zz - xz * xz, 0) * c_x1"
    return f"""
{name}1 as (select *, case when {ok} then sqrt(float_cap) end as u from {raw}),
{name}2 as (select *, {means}, count(u) over d as k from {name}1 window d as (partition by trade_date)),
{name}3 as (select *, {", ".join(f"{v} as {k}" for k, v in sums.items())} from {name}2 window d as (partition by trade_date)),
{name} as (select * exclude (u, k, {", ".join(f"c_{k}" for k in cols)}, {", ".join(sums)}), case when u is not null and k >= {3 + len(refs)} then c_y - ({fit}) end as {out} from {name}3)"""


def frame(rows: int, lag: int = 0) -> str:
    return f"(partition by code order by idx rows between {rows - 1 + lag} preceding and " + (f"{lag} preceding)" if lag else "current row)")


def _wls(out: str) -> str:
    n, h, most = M.beta
    return f"""
q0 as (select *, pow(2.0, idx / {h}.0) as u, coalesce(ex, 0) as y, coalesce(bx, 0) as v, idx >= min(case when rt is not null then idx end) over (partition by code) as on_ from panel),
q1 as (
  select *, sum(u) over f as s0, sum(u * v) over f as sx, sum(u * y) over f as sy, sum(u * v * v) over f as sxx, sum(u * v * y) over f as sxy,
         count(case when on_ then 1 end) over f as n, count(ex) over f as ny, count(bx) over f as nx, var_samp(v) over f as vx, var_samp(y) over f as vy, covar_samp(v, y) over f as c
  from q0 window f as {frame(n)}
),
q2 as (select *, case when n = {n} and n - ny <= {most} and n - nx <= {most} then (sxy / s0 - sx / s0 * sy / s0) / nullif(sxx / s0 - sx / s0 * sx / s0, 0) end as b from q1),
raw as (select trade_date, code, industry, ret, float_cap, {out} as x from q2)"""


def _filled() -> str:
    return """
span as (select *, min(case when ex is not null then idx end) over c as a, max(case when ex is not null then idx end) over c as z from panel window c as (partition by code)),
filled as (select *, case when idx between a and z then coalesce(ex, 0) end as fx, case when idx between a and z then coalesce(lx, 0) end as fl from span)"""


def _simple(x: str) -> str:
    return f"raw as (select trade_date, code, industry, ret, float_cap, {x} as x from panel)"


def _turnover(i: int, m: Windows = M) -> str:
    rows, least, months = m.liquidity[i]
    return f"""
t as (select *, case when count(turnover) over f >= {least} then sum(turnover) over f end as s from panel window f as {frame(rows)}),
raw as (select trade_date, code, industry, ret, float_cap, case when s > 0 then ln(s / {months}) end as x from t)"""


def _growth(column: str) -> str:
    return f"""
reports as (select cast(l_suppkey as varchar) as code, year(l_shipdate) as y, sum(l_extendedprice * (1 - l_discount)) as eps, sum(l_extendedprice) as revenue from lineitem group by 1, 2),
trend as (
  select code, y, case when count(*) over f = {M.years} then regr_slope({column}, y) over f / nullif(avg({column}) over f, 0) end as g
  from reports window f as (partition by code order by y rows between {M.years - 1} preceding and current row)
),
raw as (
  select p.trade_date, p.code, p.industry, p.ret, p.float_cap, g as x from panel p
  left join trend t on t.code = p.code and t.g is not null and make_date(t.y + 1, 4, 30) = make_date(case when month(p.trade_date) <= 4 then year(p.trade_date) - 1 else year(p.trade_date) end, 4, 30)
)"""


def _scaled(column: str) -> str:
    return f"raw as (select trade_date, code, industry, ret, float_cap, case when (select median(abs({column})) from panel) > 1 then {column} / 100 else {column} end as x from panel)"


def _range(m: Windows = M) -> str:
    step, points = m.range
    sums = ", ".join(f"sum(fl) over {frame(step * t)}" for t in range(1, points + 1))
    return f"{_filled()}, raw as (select trade_date, code, industry, ret, float_cap, case when count(fl) over {frame(step * points)} = {step * points} then greatest({sums}) - least({sums}) end as x from filled)"


def _deviation(m: Windows = M) -> str:
    n, h = m.deviation
    return f"""{_filled()},
m as (select *, sum(u * fx) over f / sum(u) over f as m1, sum(u * fx * fx) over f / sum(u) over f as m2, count(fx) over f as n from (select *, pow(2.0, idx / {h}.0) as u from filled) window f as {frame(n)}),
raw as (select trade_date, code, industry, ret, float_cap, case when n = {n} then sqrt(greatest(m2 - m1 * m1, 0)) end as x from m)"""


def _strength(m: Windows = M) -> str:
    n, h, lag, least = m.momentum
    total = sum(0.5 ** (j / h) for j in range(n))
    return f"""
m as (select *, sum(pow(2.0, idx / {h}.0) * lx) over f as s, count(lx) over f as n from panel window f as {frame(n, lag)}),
raw as (select trade_date, code, industry, ret, float_cap, case when n >= {least} and idx >= {n} then s / (pow(2.0, (idx - {lag}) / {h}.0) * {total!r}) end as x from m)"""


RAW = {
    "lncap": _simple("case when market_cap > 0 then ln(market_cap) end"),
    "beta": _wls("b"),
    "sigma": _wls("case when b is not null then sqrt(greatest(vy - 2 * b * c + b * b * vx, 0)) end"),
    "rstr": _strength(), "dastd": _deviation(), "cmra": _range(),
    "stom": _turnover(0), "stoq": _turnover(1), "stoa": _turnover(2),
    "btop": _simple("1 / nullif(market_cap / nullif(equity, 0), 0)"),
    "cetop": _simple("1 / nullif(market_cap / nullif(ncl, 0), 0)"),
    "etop": _simple("tax"), "epibs": _simple("tax / nullif(price, 0)"),
    "egro": _growth("eps"), "sgro": _growth("revenue"),
    "egibs": _scaled("(tax * 100)"), "egibs_s": _scaled("(discount * 100)"),
    "mlev": _simple("(market_cap + coalesce(ncl, 0)) / nullif(market_cap, 0)"),
    "dtoa": _simple("liabilities / nullif(market_cap, 0)"),
    "blev": _simple("(equity + coalesce(ncl, 0)) / nullif(equity, 0)"),
}


DAILY = """
c as (
  select cast(l_shipdate as date) as trade_date, s_nationkey as nk, sum(l_extendedprice) / sum(l_quantity) as price, sum(l_quantity) / 100 as turnover
  from lineitem join supplier on l_suppkey = s_suppkey group by 1, 2
),
cal as (select trade_date, row_number() over (order by trade_date) as idx from (select distinct trade_date from c)),
g as (
  select cal.trade_date, idx, n_nationkey as nk, turnover, last_value(price ignore nulls) over (partition by n_nationkey order by idx rows between unbounded preceding and current row) as price
  from cal cross join nation left join c on c.trade_date = cal.trade_date and c.nk = n_nationkey
),
panel as (
  select trade_date, idx, cast(nk as varchar) as code, null as industry, null as float_cap, turnover, ret, ret as ex, ln(1 + ret) as lx
  from (select *, price / lag(price) over (partition by nk order by idx) - 1 as ret from g)
)"""


def daily(name: str) -> str:
    """A descriptor with the default windows on the daily panel of nations, not standardised."""
    w = Windows()
    raw = {"rstr": _strength, "dastd": _deviation, "cmra": _range, "stom": lambda m: _turnover(0, m), "stoq": lambda m: _turnover(1, m), "stoa": lambda m: _turnover(2, m)}[name](w)
    return f"with {DAILY}, {raw} select trade_date, code, {rounded('x')} as {name} from raw where x is not null"


def rounded(x: str, digits: int = 6) -> str:
    return f"round({x}, {digits}) + 0.0"


def descriptor(name: str) -> str:
    return f"with {CELLS}, {RAW[name]}, {standardised('raw')} select trade_date, code, {rounded('x')} as {name} from z where x is not null"


def nlsize_ctes() -> str:
    return f"{RAW['lncap']}, {standardised('raw')}, cube as (select *, pow(x, 3) as x3 from z), {residuals('cube', 'x3', ['x'], 'res', 'r')}, rz as (select trade_date, code, industry, ret, float_cap, r as x from res), {standardised('rz', name='nl')}"


def prefixed(name: str, tag: str) -> str:
    """A descriptor's CTEs as one subquery, to be used beside others."""
    return f"{tag} as (select * from (with {RAW[name]}, {standardised('raw')} select trade_date, code, industry, ret, float_cap, x from z))"


def joined(names: list[str]) -> str:
    """CTE ``d`` with several standardised descriptors as columns."""
    parts = ", ".join(prefixed(n, f"d_{n}") for n in names)
    first = names[0]
    cols = ", ".join(f"d_{n}.x as {n}" for n in names)
    joins = " ".join(f"left join d_{n} on d_{n}.trade_date = a.trade_date and d_{n}.code = a.code" for n in names[1:])
    return f"{parts}, d as (select a.trade_date, a.code, a.industry, a.ret, a.float_cap, {cols.replace(f'd_{first}.', 'a.')} from d_{first} a {joins})"


def fwl(styles: list[str], source: str) -> str:
    """CTE ``f`` of factor returns (factor_group, factor, value) with one or two styles, by partialling out the industries."""
    a, b = [*styles, None, None][:2]
    cols = ", ".join(f"coalesce({s}, 0) as {s}" for s in styles)
    dem = ", ".join(f"{c} - sum(w * {c}) over i / sum(w) over i as d_{c}, sum(w * {c}) over i / sum(w) over i as m_{c}" for c in ["ret", *styles])
    if b:
        fits = f"""(sum(w*d_{a}*d_ret)*sum(w*d_{b}*d_{b}) - sum(w*d_{b}*d_ret)*sum(w*d_{a}*d_{b})) / nullif(sum(w*d_{a}*d_{a})*sum(w*d_{b}*d_{b}) - sum(w*d_{a}*d_{b})*sum(w*d_{a}*d_{b}), 0) as f_{a},
        (sum(w*d_{b}*d_ret)*sum(w*d_{a}*d_{a}) - sum(w*d_{a}*d_ret)*sum(w*d_{a}*d_{b})) / nullif(sum(w*d_{a}*d_{a})*sum(w*d_{b}*d_{b}) - sum(w*d_{a}*d_{b})*sum(w*d_{a}*d_{b}), 0) as f_{b}"""
    else:
        fits = f"sum(w*d_{a}*d_ret) / nullif(sum(w*d_{a}*d_{a}), 0) as f_{a}" if a else "1 as one"
    left = "m_ret" + "".join(f" - f_{s} * m_{s}" for s in styles)
    style_rows = "".join(f" union all select trade_date, 'style', '{s}', f_{s} from fit" for s in styles)
    ms = "".join(f", any_value(m_{s}) as m_{s}" for s in styles)
    return f"""
smp as (select trade_date, code, industry, ret, float_cap as cap{", " + cols if cols else ""} from {source} where industry is not null and ret is not null and float_cap > 0),
wts as (select *, sqrt(cap) / sum(sqrt(cap)) over (partition by trade_date) as w from smp),
dem as (select *, {dem} from wts window i as (partition by trade_date, industry)),
fit as (select trade_date, {fits} from dem group by trade_date having count(*) > count(distinct industry) + 1 + {len(styles)}),
cell as (select trade_date, industry, sum(w) as wi, any_value(m_ret) as m_ret{ms} from dem group by 1, 2),
rest as (select c.trade_date, industry, wi, {left} as r from cell c join fit using (trade_date)),
ctry as (select trade_date, sum(wi * r) as fc from rest group by 1),
f as (
  select trade_date, 'country' as factor_group, 'country' as factor, fc as value from ctry
  union all select trade_date, 'industry', industry, r - fc from rest join ctry using (trade_date){style_rows}
)"""


def eliminated(name: str, source: str, keys: str = "trade_date", matrix: str = "m") -> str:
    """CTE ``name`` with the augmented matrices of ``source`` (lists of rows) after a step of elimination for each row; needs WITH RECURSIVE."""
    return f"""
{name}_steps as (
  select {keys}, 0 as k, {matrix} as m from {source}
  union all
  select {keys}, k + 1, list_transform(m, lambda row, i: case when i = k + 1 then list_transform(row, lambda v: v / m[k + 1][k + 1])
    else list_transform(row, lambda v, j: v - row[k + 1] * m[k + 1][j] / m[k + 1][k + 1]) end)
  from {name}_steps where k < len(m)
),
{name} as (select {keys}, m from {name}_steps where k = len(m))"""


def many_styles(styles: list[str], source: str) -> str:
    """CTE ``f`` of factor returns with any number of styles: they and returns less their industry means, then elimination; needs WITH RECURSIVE."""
    n = len(styles)
    dem = ", ".join(f"{x} - sum(w * {x}) over i / sum(w) over i as d_{c}, sum(w * {x}) over i / sum(w) over i as m_{c}" for c, x in [("ret", "ret"), *[(s, f"coalesce({s}, 0)") for s in styles]])
    there = lambda s: f"count({s}) > 0"
    cell = lambda a, b: f"case when {there(a)} and {there(b) if b != 'ret' else 'true'} then sum(w * d_{a} * d_{b}) else {'1.0' if a == b else '0.0'} end"
    matrix = "[" + ", ".join("[" + ", ".join(cell(a, b) for b in [*styles, "ret"]) + "]" for a in styles) + "]"
    count = " + ".join(f"cast({there(s)} as integer)" for s in styles)
    left = "m_ret" + "".join(f" - e.m[{i}][{n + 1}] * m_{s}" for i, s in enumerate(styles, 1))
    rows = "".join(f" union all select trade_date, 'style', '{s}', e.m[{i}][{n + 1}] from e join fit using (trade_date) where has_{s}" for i, s in enumerate(styles, 1))
    return f"""
smp as (select trade_date, code, industry, ret, float_cap as cap, {", ".join(styles)} from {source} where industry is not null and ret is not null and float_cap > 0),
wts as (select *, sqrt(cap) / sum(sqrt(cap)) over (partition by trade_date) as w from smp),
dem as (select *, {dem} from wts window i as (partition by trade_date, industry)),
fit as materialized (
  select trade_date, {matrix} as m, {", ".join(f"{there(s)} as has_{s}" for s in styles)} from dem group by trade_date having count(*) > count(distinct industry) + 1 + {count}
),{eliminated("e", "fit")},
cell as (select trade_date, industry, sum(w) as wi, any_value(m_ret) as m_ret, {", ".join(f"any_value(m_{s}) as m_{s}" for s in styles)} from dem group by 1, 2),
rest as (select c.trade_date, industry, wi, {left} as r from cell c join e using (trade_date)),
ctry as (select trade_date, sum(wi * r) as fc from rest group by 1),
f as (
  select trade_date, 'country' as factor_group, 'country' as factor, fc as value from ctry
  union all select trade_date, 'industry', industry, r - fc from rest join ctry using (trade_date){rows}
)"""


def attribution(window: int) -> str:
    """CTE ``parts`` of the regions' rolling attribution to the factor returns ``f``, for windows of full rank that meet every factor; needs WITH RECURSIVE.

    Dates that lack a factor count for nothing, as their windows' other dates have it.
    """
    return f"""
px as (select industry as fund_id, trade_date, sum(market_cap) / sum(quantity) as price from panel where price is not null group by 1, 2),
nr as (select fund_id, trade_date, price / lag(price) over (partition by fund_id order by trade_date) - 1 as r from px),
own as materialized (select *, row_number() over (partition by fund_id order by trade_date) as t from nr where r is not null and trade_date in (select trade_date from f)),
known as (select trade_date from f group by 1 having count(*) = (select count(*) from (select distinct factor_group, factor from f))),
fx as materialized (select *, dense_rank() over (order by factor_group, factor) as j from f where trade_date in (select trade_date from known)),
win as (select e.fund_id, e.t, w.trade_date, w.r from own e join own w on w.fund_id = e.fund_id and w.t between e.t - {window - 1} and e.t where e.t >= {window}),
sq as (
  select fund_id, t, a.j as i, list(v order by b) as row from (
    select win.fund_id, win.t, a.j, b.j as b, sum(a.value * b.value) as v from win join fx a using (trade_date) join fx b using (trade_date) group by 1, 2, 3, 4
    union all select win.fund_id, win.t, a.j, 1000000, sum(a.value * r) from win join fx a using (trade_date) group by 1, 2, 3
  ) a group by 1, 2, 3
),
mx as materialized (select fund_id, t, list(row order by i) as m from sq group by 1, 2),{eliminated("e", "mx", "fund_id, t")},
earned as (select own.fund_id, own.trade_date, own.r, factor_group, factor, value * e.m[j][len(e.m) + 1] as v from own join e using (fund_id, t) join fx on fx.trade_date = own.trade_date),
parts as (
  select fund_id, trade_date, 'Alpha' as component, null::varchar as detail, any_value(r) - sum(v) as value from earned group by 1, 2
  union all select fund_id, trade_date, c.label, null, coalesce(sum(v) filter (factor_group = c.g), 0) from earned, (values ('country', 'Country'), ('industry', 'Industry'), ('style', 'Style')) c(g, label) group by 1, 2, 3
  union all select fund_id, trade_date, 'Style', factor, v from earned where factor_group = 'style'
)"""


DAYS = """
days as (select distinct cast(l_shipdate as date) as trade_date from lineitem),
px as (select cast(n_regionkey as varchar) as fund_id, cast(l_shipdate as date) as trade_date, sum(l_extendedprice) / sum(l_quantity) as price
       from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey group by 1, 2),
nav as (select fund_id, trade_date, price / first_value(price) over (partition by fund_id order by trade_date) as nav from px),
spn as (select fund_id, min(trade_date) as a, max(trade_date) as b from nav group by 1),
dn as (
  select s.fund_id, d.trade_date, last_value(nav ignore nulls) over (partition by s.fund_id order by d.trade_date rows between unbounded preceding and current row) as nav
  from spn s join days d on d.trade_date between a and b left join nav n on n.fund_id = s.fund_id and n.trade_date = d.trade_date
)"""


def performance(period: str) -> str:
    rows = "dn" if period == "d" else "(select * from dn where isodow(trade_date) = 5)"
    py = 250 if period == "d" else 52
    base = "case when k = 1 then first_nav else before end" if period == "d" else "before"
    keep = "" if period == "d" else "where k > 1"
    rate = "case when coalesce(abs(sum(r) filter (r < 0)), 0) = 0 then 9999 else coalesce(sum(r) filter (r > 0), 0) / abs(sum(r) filter (r < 0)) end" if period == "d" else "avg(r) filter (r > 0) / nullif(abs(avg(r) filter (r < 0)), 0)"
    trailing = ", ".join(f"arg_max(nav, trade_date) / arg_min(nav, trade_date) filter (trade_date >= (e - interval {m} month)::date) - 1 as ret_{m}m" for m in (1, 3, 6, 12))
    final = {
        "cumulative": "cumulative", "annualised": "annualised", "volatility": "volatility", "downside": "downside", "ret_1m": "ret_1m", "ret_3m": "ret_3m", "ret_6m": "ret_6m", "ret_12m": "ret_12m",
        "ret_ytd": "ret_ytd", "max_drawdown": "-fall", "win_rate": "win_rate", "profit_loss": "profit_loss", "mean_week": "mean_week", "min_week": "min_week", "vol_week": "vol_week",
        "sharpe": "(annualised - 0.03) / nullif(volatility, 0)", "calmar": "case when fall <> 0 then annualised / fall else 9999 end", "sortino": "case when downside <> 0 then (annualised - 0.03) / downside else 9999 end",
    }
    return f"""
with {DAYS},
rw as (select * from {rows}),
rr as (select *, nav / lag(nav) over (partition by fund_id order by trade_date) - 1 as r, max(trade_date) over (partition by fund_id) as e from rw),
st as (
  select fund_id, count(*) - 1 as n_periods, arg_max(nav, trade_date) / arg_min(nav, trade_date) - 1 as cumulative, sqrt({py}.0) * stddev_samp(r) as volatility,
         pow(arg_max(nav, trade_date) / arg_min(nav, trade_date), {py}.0 / (count(*) - 1)) - 1 as annualised,
         sqrt(coalesce(sum(r * r) filter (r < 0), 0)) * sqrt({py}.0 / (count(*) - 2)) as downside,
         {trailing}, arg_max(nav, trade_date) / arg_min(nav, trade_date) filter (year(trade_date) = year(e)) - 1 as ret_ytd
  from rr group by 1
),
pk as (select *, max(nav) over (partition by fund_id order by trade_date) as peak from rw),
dd as (select *, (peak - nav) / peak as fall, row_number() over (partition by fund_id order by (peak - nav) / peak desc, trade_date) as k from pk),
md as (select d.fund_id, d.fall, case when d.fall > 0 then d.trade_date end as drawdown_end, case when d.fall > 0 then (select min(p.trade_date) from pk p where p.fund_id = d.fund_id and p.nav = d.peak and p.trade_date <= d.trade_date) end as drawdown_start from dd d where k = 1),
we as (
  select fund_id, trade_date, nav, lag(nav) over (partition by fund_id order by trade_date) as before, row_number() over (partition by fund_id order by trade_date) as k
  from dn where isodow(trade_date) = 5
),
wr as (select we.fund_id, trade_date, nav / {base} - 1 as r from we join (select fund_id, arg_min(nav, trade_date) as first_nav from dn group by 1) using (fund_id) {keep}),
wg as (select *, sum(case when r > 0 then 1 else 0 end) over (partition by fund_id order by trade_date) as g from wr),
ws as (select *, sum(case when r > 0 then 0 else 1 end) over (partition by fund_id, g order by trade_date) as streak from wg),
wk as (
  select fund_id, count(*) as n_weeks, cast(sum(case when r > 0 then 1 else 0 end) as bigint) as n_wins, cast(sum(case when r > 0 then 0 else 1 end) as bigint) as n_losses,
         avg(case when r > 0 then 1.0 else 0.0 end) as win_rate, {rate} as profit_loss, avg(r) as mean_week, min(r) as min_week, sqrt(52.0) * stddev_samp(r) as vol_week, cast(max(streak) as bigint) as longest_losing
  from ws group by 1
)
select st.fund_id, n_periods, drawdown_start, drawdown_end, n_weeks, n_wins, n_losses, longest_losing, {", ".join(f"{rounded(v)} as {k}" for k, v in final.items())}
from st join md using (fund_id) join wk using (fund_id)
"""
