"""Security and account codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Exchange suffixes of the two code dialects.
VENDOR_OF = {".SH": ".XSHG", ".SZ": ".XSHE", ".BJ": ".XBJG"}
# First digits of a bare code and the exchange suffix they imply; others stay bare.
SUFFIX_OF_DIGIT = {"6": ".XSHG", "0": ".XSHE", "3": ".XSHE", "4": ".XBJG", "8": ".XBJG"}
# Fixed value: account codes of primary stock positions.
STOCK_ACCOUNT = r"^1102[0-9A-Z]{2}01\d{6}$"
# Fixed value: the captioned date in a cell of a valuation sheet.
CAPTIONED_DATE = r"估值日期[:：]\s*(\d{4}-\d{2}-\d{2})"


def _translate(code: Column, pairs: dict[str, str]) -> Column:
    out = code
    for a, b in pairs.items():
        out = F.when(F.endswith(code, F.lit(a)), F.concat(F.expr("''"), F.substring(code, F.lit(1), F.length(code) - len(a)), F.lit(b))).otherwise(out)
    return out


def to_vendor(code: Column) -> Column:
    """Exchange suffix of the vendor's dialect; codes without a known suffix pass through."""
    return _translate(code, VENDOR_OF)


def to_terminal(code: Column) -> Column:
    """The reverse of :func:`to_vendor`."""
    return _translate(code, {b: a for a, b in VENDOR_OF.items()})


def with_suffix(code: Column) -> Column:
    """A bare code with the exchange suffix that its first digit implies."""
    out = code
    for digit, suffix in SUFFIX_OF_DIGIT.items():
        out = F.when(F.startswith(code, F.lit(digit)), F.concat(code, F.lit(suffix))).otherwise(out)
    return out


def is_stock_account(account: Column) -> Column:
    return F.coalesce(account.rlike(STOCK_ACCOUNT), F.lit(False))


def account_digits(account: Column) -> Column:
    """The security code in an account code: its last six digits if it is a primary position, else the first six-digit run, else null."""
    return F.when(is_stock_account(account), F.substring(account, -6, 6)).otherwise(F.nullif(F.regexp_extract(account, r"(\d{6})", 1), F.lit("")))


def captioned_date(cell: Column) -> Column:
    """The valuation date that a text cell names as such, else null."""
    return F.nullif(F.regexp_extract(cell, CAPTIONED_DATE, 1), F.lit("")).try_cast("date")


def file_date(name: Column) -> Column:
    """The date of the first eight digits in a file's name, else null."""
    return F.try_to_date(F.nullif(F.regexp_extract(F.element_at(F.split(name, "/"), -1), r"(\d{8})", 1), F.lit("")), "yyyyMMdd")
