"""Date keys, calendar labels and boundary-counting differences.

Everything works on zone-free timestamps, so results do not depend on the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English labels, whatever the locale.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def days_between(start: Column, end: Column) -> Column:
    """Midnights crossed from start to end."""
    return F.datediff(end.cast("date"), start.cast("date"))


def hours_between(start: Column, end: Column) -> Column:
    """Full-hour marks crossed, so 10:59 to 11:01 counts one."""
    return days_between(start, end) * 24 + F.hour(end) - F.hour(start)


def millis_between(start: Column, end: Column) -> Column:
    return F.unix_millis(end) - F.unix_millis(start)


def date_key(c: Column) -> Column:
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def month_key(c: Column) -> Column:
    return F.year(c) * 100 + F.month(c)


def year_month(c: Column) -> Column:
    """``yyyy-MM`` text."""
    return F.substring(c.cast("date").cast("string"), 1, 7)


def month_name(c: Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month(c))


def weekday_name(c: Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), F.dayofweek(c))


def iso_year(c: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), c)
