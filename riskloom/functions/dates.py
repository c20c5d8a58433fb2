"""Calendar functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def calendar_parts(dates: DataFrame, date_col: str = "trade_date") -> DataFrame:
    """Year, quarter, month and ISO week of each date."""
    d = F.col(date_col)
    return dates.withColumns({"year": F.year(d), "quarter": F.quarter(d), "month": F.month(d), "week": F.weekofyear(d)})


def report_effective_date(d: Column) -> Column:
    """Key of the annual report in force: 30 April of this year from May on, else 30 April of the year before."""
    return F.make_date(F.when(F.month(d) <= 4, F.year(d) - 1).otherwise(F.year(d)), F.lit(4), F.lit(30))


def report_key(year: Column) -> Column:
    """Date under which the report of a year is filed: 30 April of the next."""
    return F.make_date(year + 1, F.lit(4), F.lit(30))


def is_friday(d: Column) -> Column:
    return F.weekday(d) == 4


def quarter_year(quarter: Column) -> Column:
    """Year of a ``YYYYqN`` label."""
    return F.substring(quarter, 1, 4).cast("int")
