"""Money, ratios and number parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.schemas import AMOUNT


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(value: Column, digits: int = 2) -> Column:
    """Round a double with two plain IEEE operations, so any engine reproduces it bit for bit."""
    scale = float(10**digits)
    return F.floor(value * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def money(value: Column) -> Column:
    """Exact amount with two decimals; 18 digits keep it in one machine word."""
    return value.cast(AMOUNT)


def total_money(value: Column) -> Column:
    """Sum of exact amounts, wide enough for any number of rows."""
    return value.cast("decimal(38,2)")


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; NULL (never an error) where the denominator is zero or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """Quotient with 0 in place of an undefined result."""
    return F.coalesce(safe_ratio(numerator, denominator), F.lit(0.0))


def percent(numerator: Column, denominator: Column) -> Column:
    """Share in percent, rounded to two decimals."""
    return round_half_up(safe_ratio(numerator, denominator) * F.lit(100.0))


def mean_amount(value: Column) -> Column:
    """Aggregate: mean of an exact amount, rounded to two decimals (exact sum, one division)."""
    return round_half_up(safe_ratio(F.sum(value), F.count(value)))


def parse_number(text: Column) -> Column:
    """Text to double, NULL for anything that is not a plain number.

    A trailing letter covers what the cast would still accept: type suffixes such as ``1.0d`` and
    the words ``NaN`` and ``inf``.
    """
    text = text.cast("string")
    return F.when(~text.rlike(r"[A-Za-z]\s*$"), text.try_cast("double"))


def finite(value: Column) -> Column:
    """NULL in place of an infinite value (a text such as ``1e999``)."""
    return F.when(F.abs(value) <= F.lit(1.7976931348623157e308), value)
