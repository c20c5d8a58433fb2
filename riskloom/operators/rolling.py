"""Rolling and cumulative operators over each code's history.

Windows of many rows are differences of running sums, which cost the same whatever their length.  Running sums begin anew with each block of
rows, at least as long as the longest window, so a window meets two blocks at most: it is what the current block has so far and what the one
before has left, or the difference of two running sums of one block.  The error of a sum is bounded by 2^-52 times the number of rows
of two blocks times the sum of the sizes of their values, however long the history and whatever lies before them.

Half-life weights 0.5^(j/H), j counting back from a window's end, are powers 2^(at/H) of the row's place in its block; a window's part in the block
before is scaled by 2^(-rows/H).  So they never outgrow doubles.  Blocks are partitions of a window that is ordered by block and row, and the
history is one ordered by both: all running sums and all that looks back share one sort and one shuffle by code.

Forms over ROWS frames (``weighted_deviation``, ``cumulative_range``, ``lagged_strength``, ``rolling_sum``) give the same as columns, for short windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.numeric import log, ratio


def frame(rows: int, lag: int = 0, by: str = "code") -> Window:
    return Window.partitionBy(by).orderBy("idx").rowsBetween(-(rows - 1) - lag, -lag)


def weight(half_life: float) -> Column:
    return F.pow(F.lit(2.0), F.col("idx") / F.lit(float(half_life)))


def normaliser(window: int, half_life: float) -> float:
    """Sum of a full window's weights, the newest being 1."""
    return sum(0.5 ** (j / half_life) for j in range(window))


def with_blocks(df: DataFrame, rows: int, by: str = "code") -> DataFrame:
    """The frame with each row's block and its place there, for ``frame_sums``."""
    n = f"row_number() over (partition by `{by}` order by idx) - 1"
    return df.selectExpr("*", f"{n} as __n").selectExpr("*", f"cast(floor(__n / {rows}) as int) as __block", f"__n % {rows} as __at").drop("__n")


def frame_sums(df: DataFrame, terms: dict[str, tuple[str, float | None]], frames: dict[str, tuple[str, int, int]], rows: int, by: str = "code") -> DataFrame:
    """New columns ``{out: (term, window, lag)}``: sums over the ``window`` rows that end ``lag`` rows ago, as far as there are any.

    ``terms`` are ``{name: (SQL of the value, half-life)}``; nulls add nothing; with a half-life the newest row weighs 1.  ``rows`` is the
    length of blocks, ``window`` at least; blocks that the frame has already (``with_blocks``) must have that length.
    (SQL text, for some dozens of columns are parsed faster than they are put together call by call.)
    """
    longest = max(window for _, window, _ in frames.values())
    if longest > rows:
        raise ValueError(f"blocks of {rows} rows are shorter than a window of {longest}")
    own = "__block" not in df.columns
    if own:
        df = with_blocks(df, rows, by)
    block = f"over (partition by `{by}`, __block order by idx rows between unbounded preceding and"
    history = f"over (partition by `{by}` order by __block, idx)"
    power = lambda x, h: f"pow(2D, ({x}) / {float(h)}D)"
    valued = {t: f"coalesce({x if h is None else f'({x}) * {power("__at", h)}'}, 0D)" for t, (x, h) in terms.items()}
    running = [e for t, v in valued.items() for e in (f"sum({v}) {block} current row) as __p_{t}", f"sum({v}) {block} unbounded following) as __t_{t}")]
    back: dict[int, set[str]] = {}
    for t, window, lag in frames.values():
        back.setdefault(window + lag, set()).add(t)
        if lag:
            back.setdefault(lag, set()).add(t)
    lags = [f"lag(struct(__block, {', '.join(f'__p_{t}, __t_{t}' for t in sorted(ts))}), {k}) {history} as __l_{k}" for k, ts in back.items()]
    made = []
    for out, (t, window, lag) in frames.items():
        half_life = terms[t][1]
        end, far = f"__l_{lag}." if lag else "", f"__l_{window + lag}"
        scale = "1D" if half_life is None else f"{2.0 ** (-rows / half_life)!r}D"
        value = f"coalesce({end}__p_{t}, 0D) + coalesce(if({far}.__block = {end}__block, -{far}.__p_{t}, ({far}.__t_{t} - {far}.__p_{t}) * {scale}), 0D)"
        made.append(f"{value if half_life is None else f'({value}) * {power(f"-pmod(__at - {lag}, {rows})", half_life)}'} as `{out}`")
    gone = [f"__{c}_{t}" for t in terms for c in "pt"] + [f"__l_{k}" for k in back] + (["__block", "__at"] if own else [])
    return df.selectExpr("*", *running).selectExpr("*", *lags).selectExpr("*", *made).drop(*gone)


def present(x: str) -> str:
    """1 where there is a value."""
    return f"if(`{x}` is null, 0D, 1D)"


def rolling_wls(
    df: DataFrame, y: str, x: str, window: int, half_life: float, max_missing: int, beta: str = "beta", sigma: str = "sigma", active: Column | None = None, rows: int | None = None
) -> DataFrame:
    """Weighted regression of y on x with intercept in each full window, and the plain standard deviation of its residuals.

    Null where y or x lacks more than ``max_missing`` values; other nulls count as 0.  A window holds ``active`` rows only.
    """
    if active is not None:
        df = df.withColumn("__active", active)
    a, b = f"coalesce(`{y}`, 0D)", f"coalesce(`{x}`, 0D)"
    plain = {"n": "1D" if active is None else "if(__active, 1D, 0D)", "ny": present(y), "nx": present(x), "b": b, "a": a, "bb": f"{b} * {b}", "aa": f"{a} * {a}", "ab": f"{a} * {b}"}
    terms = {k: (v, None) for k, v in plain.items()} | {f"w{k}": (plain[k], half_life) for k in ("b", "a", "bb", "ab")}
    df = frame_sums(df, terms, {f"__{t}": (t, window, 0) for t in terms}, rows or window)
    total = f"{normaliser(window, half_life)!r}D"
    mean = lambda k: f"(__w{k} / {total})"
    slope = f"try_divide({mean('ab')} - {mean('b')} * {mean('a')}, {mean('bb')} - {mean('b')} * {mean('b')})"
    cov = lambda p, q: f"(__{p}{q} - __{p} * __{q} / {window}) / {window - 1}"
    df = df.withColumn(beta, F.expr(f"if(__n = {window} and __n - __ny <= {max_missing} and __n - __nx <= {max_missing}, {slope}, null)"))
    rest = f"{cov('a', 'a')} - 2 * `{beta}` * {cov('a', 'b')} + `{beta}` * `{beta}` * {cov('b', 'b')}"
    return df.withColumn(sigma, F.expr(f"if(`{beta}` is null, null, sqrt(greatest({rest}, 0D)))")).drop("__active", *[f"__{t}" for t in terms])


def with_deviation(df: DataFrame, out: str, x: str, window: int, half_life: float, rows: int | None = None) -> DataFrame:
    """``weighted_deviation`` from running sums."""
    terms = {"n": (present(x), None), "x": (f"`{x}`", half_life), "xx": (f"`{x}` * `{x}`", half_life)}
    df = frame_sums(df, terms, {f"__{t}": (t, window, 0) for t in terms}, rows or window)
    total = f"{normaliser(window, half_life)!r}D"
    return df.withColumn(out, F.expr(f"if(__n = {window}, sqrt(greatest(__xx / {total} - __x / {total} * __x / {total}, 0D)), null)")).drop("__n", "__x", "__xx")


def with_range(df: DataFrame, out: str, x: str, step: int, points: int, rows: int | None = None) -> DataFrame:
    """``cumulative_range`` from one running sum and a look back for each point."""
    frames = {f"__s{t}": ("x", step * t, 0) for t in range(1, points + 1)} | {"__n": ("n", step * points, 0)}
    df = frame_sums(df, {"x": (f"`{x}`", None), "n": (present(x), None)}, frames, rows or step * points)
    sums = ", ".join(f"__s{t}" for t in range(1, points + 1))
    spread = f"greatest({sums}) - least({sums})" if points > 1 else "0D"
    return df.withColumn(out, F.expr(f"if(__n = {step * points}, {spread}, null)")).drop(*frames)


def with_strength(df: DataFrame, out: str, x: str, window: int, half_life: float, lag: int, min_count: int, rows: int | None = None) -> DataFrame:
    """``lagged_strength`` from running sums."""
    df = frame_sums(df, {"x": (f"`{x}`", half_life), "n": (present(x), None)}, {"__s": ("x", window, lag), "__n": ("n", window, lag)}, rows or window)
    return df.withColumn(out, F.expr(f"if(__n >= {min_count} and idx >= {window}, __s / {normaliser(window, half_life)!r}D, null)")).drop("__s", "__n")


def with_log_turnover(df: DataFrame, x: str, made: dict[str, tuple[int, int, int]], rows: int | None = None) -> DataFrame:
    """``log_turnover`` from one running sum, ``{out: (window, least values, periods)}``."""
    frames = {f"__{k}_{out}": (k, window, 0) for out, (window, _, _) in made.items() for k in "xn"}
    df = frame_sums(df, {"x": (f"`{x}`", None), "n": (present(x), None)}, frames, rows or max(m[0] for m in made.values()))
    return df.withColumns({out: F.expr(f"if(__n_{out} >= {least} and __x_{out} > 0, ln(__x_{out} / {periods}), null)") for out, (_, least, periods) in made.items()}).drop(*frames)


def weighted_deviation(x: str, window: int, half_life: float) -> Column:
    """Weighted standard deviation without a correction; null unless the window is full and complete."""
    f, u, v = frame(window), weight(half_life), F.col(x)
    m = F.sum(u * v).over(f) / F.sum(u).over(f)
    q = F.sum(u * v * v).over(f) / F.sum(u).over(f)
    return F.when(F.count(v).over(f) == window, F.sqrt(F.greatest(q - m * m, F.lit(0.0))))


def cumulative_range(x: str, step: int, points: int) -> Column:
    """Greatest less least of the trailing sums over step, 2 step, ... rows; null unless the longest window is complete."""
    sums = [F.sum(x).over(frame(step * t)) for t in range(1, points + 1)]
    return F.when(F.count(x).over(frame(step * points)) == step * points, F.greatest(*sums) - F.least(*sums))


def lagged_strength(x: str, window: int, half_life: float, lag: int, min_count: int) -> Column:
    """Weighted sum over a window that ends ``lag`` rows ago; nulls add nothing and weights aren't renormalised."""
    f = frame(window, lag)
    top = F.pow(F.lit(2.0), (F.col("idx") - lag) / F.lit(float(half_life))) * normaliser(window, half_life)
    return F.when((F.count(x).over(f) >= min_count) & (F.col("idx") >= window), F.sum(weight(half_life) * F.col(x)).over(f) / top)


def rolling_sum(x: str, window: int, min_count: int) -> Column:
    """Sum over the last rows if enough of them have a value; shorter frames at the start count, too."""
    f = frame(window)
    return F.when(F.count(x).over(f) >= min_count, F.sum(x).over(f))


def log_turnover(x: str, window: int, min_count: int, periods: int) -> Column:
    return log(rolling_sum(x, window, min_count) / periods)


def rolling_deviation(x: str, window: int, per_year: int = 242, by: str = "code") -> Column:
    """Annualised standard deviation of a full and complete window."""
    f = frame(window, by=by)
    return F.when(F.count(x).over(f) == window, F.stddev_samp(x).over(f) * F.sqrt(F.lit(float(per_year))))


def simple_return(price: str, w: Window) -> Column:
    return ratio(F.col(price), F.lag(price).over(w)) - 1


def cumulative_return(r: str, w: Window) -> Column:
    """Product of 1 + r so far less 1; a null adds nothing and stays null itself."""
    product = F.product(1 + F.col(r)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return F.when(F.col(r).isNotNull(), product - 1)


def drawdown(value: str, w: Window) -> Column:
    peak = F.max(value).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return ratio(peak - F.col(value), peak)


def losing_streak(df: DataFrame, win: str, by: str, order: str, out: str = "streak") -> DataFrame:
    """Length of the run of losses that each row ends; a win is 0."""
    w = Window.partitionBy(by).orderBy(order)
    df = df.withColumn("__wins", F.sum(F.when(F.col(win), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy(by, "__wins").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(F.when(F.col(win), 0).otherwise(1)).over(run).cast("long")).drop("__wins")


def report_trend(reports: DataFrame, columns: dict[str, str], years: int = 5) -> DataFrame:
    """Slope over mean of annual figures in windows of ``years`` report rows, new columns {new: old}.

    Rows, not calendar years, make the window; it is skipped if any figure in it is null; a mean of 0 gives null.
    """
    f = Window.partitionBy("code").orderBy("year").rowsBetween(-(years - 1), 0)
    y = F.col("year").cast("double")
    full = F.count(F.lit(1)).over(f) == years
    for old in columns.values():
        full = full & (F.count(old).over(f) == years)
    made = {}
    for new, old in columns.items():
        slope = ratio(F.covar_samp(y, F.col(old)).over(f), F.var_samp(y).over(f))
        made[new] = F.when(full, ratio(slope, F.avg(old).over(f)))
    return reports.withColumns(made)


def trailing_twelve_months(df: DataFrame, value: str, out: str = "ttm", skip: int = 4) -> DataFrame:
    """Cumulative quarterly figures to twelve months: December as it is, else this year so far plus last year less last year's same quarter.

    Keys are (code, trade_date); the first ``skip`` dates of all give null.
    """
    d = F.col("trade_date")
    dates = calendar_index(df)
    base = df.select("code", "trade_date", F.col(value).alias("__v"))
    full = base.where(F.month("trade_date") == 12).select("code", F.year("trade_date").alias("__y"), F.col("__v").alias("__full"))
    same = base.select("code", F.year("trade_date").alias("__y"), F.month("trade_date").alias("__m"), F.col("__v").alias("__same"))
    out_df = df.join(F.broadcast(dates), "trade_date").withColumns({"__y": F.year(d) - 1, "__m": F.month(d)})
    out_df = out_df.join(full, ["code", "__y"], "left").join(same, ["code", "__y", "__m"], "left")
    value_of = F.when(F.month(d) == 12, F.col(value)).otherwise(F.col("__full") + F.col(value) - F.col("__same"))
    return out_df.withColumn(out, F.when(F.col("__i") > skip, value_of)).drop("__y", "__m", "__full", "__same", "__i")


def calendar_index(df: DataFrame) -> DataFrame:
    return df.select("trade_date").distinct().withColumn("__i", F.row_number().over(Window.orderBy("trade_date")))
