"""Exact ratios and percentages.

Sums stay decimal until the last step. A quotient is rounded half-up by whole-number
division of its decimal operands, so a tie such as 0.125 depends neither on the order in
which partial sums were merged nor on a quotient's last digits; only the rounded figure
becomes a double.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amount times probability has four decimals; 24 digits before the point hold any sum, and
# leave room for the factors under Spark's 38-digit limit.
_OPERAND = "decimal(30,6)"
# A quotient of more has no decimals as a double, and would not fit a long when counted in them.
_LARGE = 1e13


def ratio(num: Column, den: Column, digits: int = 2, factor: int = 1) -> Column:
    """``round(factor * num / den, digits)`` as double; null when ``den`` is 0 or null."""
    top = num.cast(_OPERAND)
    bottom = F.nullif(den.cast(_OPERAND), F.lit(Decimal(0)))
    near = F.lit(float(factor)) * top.cast("double") / bottom.cast("double")
    doubled = F.abs(top) * F.lit(Decimal(2 * factor * 10**digits)) + F.abs(bottom)
    units = F.call_function("div", doubled, F.abs(bottom) * F.lit(Decimal(2))).cast("double")
    sign = F.signum(top.cast("double")) * F.signum(bottom.cast("double"))
    # Zero is added so that a rounded-off negative is no negative zero.
    exact = sign * units / F.lit(float(10**digits)) + F.lit(0.0)
    return F.when(F.abs(near) < F.lit(_LARGE), exact).otherwise(near)


def percent(num: Column, den: Column) -> Column:
    return ratio(num, den, digits=2, factor=100)


def zero_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def count_if(condition: Column) -> Column:
    """Rows for which the condition is true (null counts as false)."""
    return F.count(F.when(condition, F.lit(1)))
