"""Month arithmetic on plain dates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_of(day: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(day, "MM")


def days_between(earlier: Column, later: Column) -> Column:
    return F.datediff(later, earlier)


def in_months(month: Column, start: date, end: date) -> Column:
    """Both ends inclusive; ``month`` holds first-of-month dates."""
    return month.between(F.lit(start), F.lit(end))


def closes_in_months(day: Column, start: date, end: date) -> Column:
    """``month_of(day)`` lies in [start, end], written as a range on the raw date.

    The bare column reaches the Parquet reader, so files and row groups outside the
    range are skipped. A start inside a month leaves that month out, because the
    first of the month lies before it.
    """
    first = start if start.day == 1 else months_after(start, 1)
    return (day >= F.lit(first)) & (day < F.lit(months_after(end, 1)))


def months_after(day: date, n: int) -> date:
    """First day of the n-th month after the day's month; n may be negative."""
    years, month = divmod(day.month - 1 + n, 12)
    return date(day.year + years, month + 1, 1)
