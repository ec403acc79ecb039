"""Ratios and number labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division as double; NULL when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent_of(part: Column, total: Column) -> Column:
    """Percentage of two counts with two decimals, rounded half up in whole-number arithmetic."""
    hundredths = F.floor((part * 20000 + total) / (total * 2))
    return F.when(total != 0, hundredths.cast("double") / 100)


def whole_average(c: Column) -> Column:
    """Average of whole numbers, cut to a whole number."""
    return F.avg(c).cast("int")


def fixed(c: Column, digits: int, grouped: bool = False) -> Column:
    """Text with a set number of decimals, rounded half away from zero."""
    pattern = ("#,##0" if grouped else "0") + ("." + "0" * digits if digits else "")
    return F.call_function("format_number", F.round(c, digits), F.lit(pattern))


def percent_text(c: Column) -> Column:
    """0.123 as ``12.3%``."""
    return F.concat(fixed(c * 100, 1), F.lit("%"))


def compact_text(c: Column, prefix: str = "", small_digits: int = 0) -> Column:
    """Millions as ``1.2M``, thousands as ``3.4K``, anything smaller in full."""
    body = (
        F.when(c >= 1_000_000, F.concat(fixed(c / 1_000_000, 1), F.lit("M")))
        .when(c >= 1_000, F.concat(fixed(c / 1_000, 1), F.lit("K")))
        .otherwise(fixed(c, small_digits, grouped=True))
    )
    return F.concat(F.lit(prefix), body)
