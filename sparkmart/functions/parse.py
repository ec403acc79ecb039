"""Parsers that return NULL instead of failing. Empty text is NULL for every type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_STAMP = r"\A\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"


def to_timestamp(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` as a zone-free timestamp."""
    text = F.trim(c)
    return F.when(text.rlike(_STAMP), text.try_cast("timestamp_ntz"))


def to_any_timestamp(c: Column) -> Column:
    """Any ISO date or date-time, rounded to the second."""
    half_up = F.trim(c).try_cast("timestamp_ntz") + F.expr("INTERVAL '0.5' SECOND")
    return F.substring(half_up.cast("string"), 1, 19).cast("timestamp_ntz")


def to_decimal(c: Column, precision: int = 10, scale: int = 2) -> Column:
    """Plain decimal notation only; 1e3 is not a number here."""
    text = F.trim(c)
    return F.when(~F.lower(text).contains("e"), text.try_cast(f"decimal({precision},{scale})"))


def to_int(c: Column) -> Column:
    return F.trim(c).try_cast("int")


def to_tinyint(c: Column) -> Column:
    """0 to 255, held in a short."""
    number = to_int(c)
    return F.when(number.between(0, 255), number.cast("short"))


def to_double(c: Column) -> Column:
    return F.trim(c).try_cast("double")


def positive_or_null(c: Column) -> Column:
    return F.when(c > 0, c)
