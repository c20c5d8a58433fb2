"""Cross-sectional operators: everything within one trade date.

``standardize`` and ``residual`` take a date's sums map-side and broadcast them back, a row a date: no cross-section meets in one task and no row moves.
They read their frame once for each step, so what is costly to make should be a stored table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.numeric import clip, ratio
from riskloom.sources.staging import staged


def day() -> Window:
    """One date's cross-section.  (A function, for a window needs a running session.)"""
    return Window.partitionBy("trade_date")


def cap_weight(cap: str, w: Window | None = None) -> Column:
    """Share of the date's capitalisation."""
    return ratio(F.col(cap), F.sum(cap).over(w or day()))


def sqrt_cap_weight(cap: str, w: Window | None = None) -> Column:
    root = F.sqrt(F.when(F.col(cap) >= 0, F.col(cap)))
    return ratio(root, F.sum(root).over(w or day()))


def weighted_mean(x: str, weight: Column, w: Window | None = None) -> Column:
    """Sum of weight times value; values that are missing aren't made up for by the other weights, and none at all give 0."""
    return F.coalesce(F.sum(weight * F.col(x)).over(w or day()), F.lit(0.0))


def winsorize(df: DataFrame, x: str, out: str, mean: Column | None = None, threshold: float = 3.0) -> DataFrame:
    """Clip at ``threshold`` equal-weight sample deviations about the mean given, or the plain mean."""
    df = df.withColumns({"__m": F.avg(x).over(day()) if mean is None else mean, "__s": F.stddev_samp(x).over(day())})
    return df.withColumn(out, clip(F.col(x), F.col("__m") - threshold * F.col("__s"), F.col("__m") + threshold * F.col("__s"))).drop("__m", "__s")


def with_days(df: DataFrame, made: dict[str, Column]) -> DataFrame:
    """The frame with aggregates of each row's date (null is one, too), which are written once."""
    days = staged(df.groupBy(F.col("trade_date").alias("__day")).agg(*[c.alias(k) for k, c in made.items()]), "days")
    return df.join(F.broadcast(days), F.col("trade_date").eqNullSafe(F.col("__day")), "left").drop("__day")


def standardize(df: DataFrame, columns: list[str], cap: str = "float_cap", threshold: float = 3.0) -> DataFrame:
    """Winsorised about the cap-weighted mean, less that mean, over the sample deviation after clipping.

    All columns share the same two aggregations.  One value or none on a date, or equal ones, give null.
    """
    # SQL text: some hundred columns are parsed faster than they are put together call by call.
    means = {f"__m_{c}": F.expr(f"coalesce(try_divide(sum(`{cap}` * `{c}`), sum(`{cap}`)), 0D)") for c in columns}
    df = with_days(df, means | {f"__s_{c}": F.expr(f"stddev_samp(`{c}`)") for c in columns})
    low, high = (lambda c, sign=sign: f"`__m_{c}` {sign} {float(threshold)}D * `__s_{c}`" for sign in "-+")
    df = df.withColumns({c: F.expr(f"if(`{c}` is null or `__s_{c}` is null, null, greatest({low(c)}, least({high(c)}, `{c}`)))") for c in columns})
    df = with_days(df, {f"__d_{c}": F.expr(f"stddev_samp(`{c}`)") for c in columns})
    made = {c: F.expr(f"try_divide(`{c}` - `__m_{c}`, `__d_{c}`)") for c in columns}
    return df.withColumns(made).drop(*[f"__{k}_{c}" for k in "msd" for c in columns])


def residuals(df: DataFrame, wanted: dict[str, tuple[str, list[str]]], cap: str) -> DataFrame:
    """New columns ``{out: (y, references)}``: residuals of the date's weighted regressions (root of cap) of y on one or two references with intercept.

    Rows with all of them count; fewer than 3 + number of references leave the date null.  All regressions share the same two aggregations.
    """
    if any(len(refs) not in (1, 2) for _, refs in wanted.values()):
        raise ValueError("one or two references")
    root, names, sums = {}, {}, {}
    for k, (y, refs) in enumerate(wanted.values()):
        ok = F.col(cap).isNotNull() & (F.col(cap) >= 0)
        names[k] = {"y": y} | {f"x{i}": r for i, r in enumerate(refs)}
        for c in names[k].values():
            ok = ok & F.col(c).isNotNull()
        root[f"__u{k}"] = F.when(ok, F.sqrt(F.when(F.col(cap) >= 0, F.col(cap))))
        u = F.col(f"__u{k}")
        sums |= {f"__{k}{x}": ratio(F.sum(u * F.col(c)), F.sum(u)) for x, c in names[k].items()} | {f"__n{k}": F.count(u)}
    df = with_days(df.withColumns(root), sums)
    centred = {(k, x): F.col(c) - F.col(f"__{k}{x}") for k, own in names.items() for x, c in own.items()}
    two = [("x1", "x1"), ("x0", "x1"), ("x1", "y")]
    pairs = {(k, a, b): f"__{k}{a}{b}" for k, own in names.items() for a, b in [("x0", "x0"), ("x0", "y"), *(two if "x1" in own else [])]}
    df = with_days(df, {name: F.sum(F.col(f"__u{k}") * centred[k, a] * centred[k, b]) for (k, a, b), name in pairs.items()})
    made = {}
    for k, (out, (_, refs)) in enumerate(wanted.items()):
        s = lambda a, b, k=k: F.col(pairs[k, a, b])
        if len(refs) == 1:
            fit = ratio(s("x0", "y"), s("x0", "x0")) * centred[k, "x0"]
        else:
            det = s("x0", "x0") * s("x1", "x1") - s("x0", "x1") * s("x0", "x1")
            fit = ratio(s("x0", "y") * s("x1", "x1") - s("x1", "y") * s("x0", "x1"), det) * centred[k, "x0"]
            fit = fit + ratio(s("x1", "y") * s("x0", "x0") - s("x0", "y") * s("x0", "x1"), det) * centred[k, "x1"]
        made[out] = F.when(F.col(f"__u{k}").isNotNull() & (F.col(f"__n{k}") >= 3 + len(refs)), centred[k, "y"] - fit)
    return df.withColumns(made).drop(*root, *sums, *pairs.values())


def residual(df: DataFrame, y: str, refs: list[str], cap: str, out: str) -> DataFrame:
    """One of ``residuals``."""
    return residuals(df, {out: (y, refs)}, cap)


def orthogonalize(df: DataFrame, style: str, refs: list[str], cap: str = "float_cap") -> DataFrame:
    """The style's residual on the references, standardised again."""
    return orthogonalized(df, {style: refs}, cap)


def orthogonalized(df: DataFrame, wanted: dict[str, list[str]], cap: str = "float_cap") -> DataFrame:
    """``orthogonalize`` for styles in this order; those that don't refer to one another share their aggregations."""
    left = dict(wanted)
    while left:
        some: dict[str, list[str]] = {}
        for style, refs in left.items():
            if any(r in some for r in refs) or any(style in own for own in some.values()):
                break
            some[style] = refs
        df = standardize(residuals(df, {s: (s, refs) for s, refs in some.items()}, cap), list(some), cap)
        left = {s: refs for s, refs in left.items() if s not in some}
    return df


def unit_scaled(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns whose values' median size over the whole panel exceeds 1 are percentages and are divided by 100.

    Counts on either side of 1 decide; where they are equal, so do the two values next to it.
    """

    def over(c: str):
        size = F.abs(F.col(c))
        large, small = F.count(F.when(size > 1, 1)), F.count(F.when(size <= 1, 1))
        middle = F.max(F.when(size <= 1, size)) + F.min(F.when(size > 1, size)) > 2
        return ((large > small) | ((large == small) & F.coalesce(middle, F.lit(False)))).alias(f"__u_{c}")

    df = df.crossJoin(F.broadcast(df.agg(*[over(c) for c in columns])))
    return df.withColumns({c: F.when(F.col(f"__u_{c}"), F.col(c) / 100).otherwise(F.col(c)) for c in columns}).drop(*[f"__u_{c}" for c in columns])
