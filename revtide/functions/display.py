"""Figures as display text.

``format_number`` rounds the binary value half-even, which is what the metric texts
need; no rounding step comes before it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts and scales of displayed figures.
MISSING = "—"
BILLION, MILLION, THOUSAND = 1e9, 1e6, 1e3
RETENTION_MISSING = "Not available"
RETENTION_NOT_LOADED = "Data not loaded for selected period"
COVERAGE_UNKNOWN = "unknown"
COVERAGE_LOW = "low"
COVERAGE_HEALTHY = "healthy"
COVERAGE_STRONG = "strong"
COVERAGE_VERY_HIGH = "very high (validate denominator)"
COVERAGE_STRONG_BELOW = 10.0


def plain_2dp(value: Column) -> Column:
    """Two decimals without thousands separators."""
    return F.call_function("format_number", value.cast("double"), F.lit("0.00"))


def _scaled(value: Column, size: Column) -> Column:
    return (
        F.when(size >= BILLION, F.concat(F.format_number(value / BILLION, 2), F.lit("B")))
        .when(size >= MILLION, F.concat(F.format_number(value / MILLION, 2), F.lit("M")))
        .when(size >= THOUSAND, F.format_number(value, 0))
        .otherwise(F.format_number(value, 2))
    )


def _or_missing(value: Column, text: Column) -> Column:
    return F.when(value.isNull() | F.isnan(value), MISSING).otherwise(text)


def fmt_currency(col: Column) -> Column:
    value = col.cast("double")
    size = F.abs(value)
    sign = F.when(value < 0, "-").otherwise("")
    return _or_missing(value, F.concat(sign, F.lit("$"), _scaled(size, size)))


def fmt_number(col: Column) -> Column:
    value = col.cast("double")
    return _or_missing(value, _scaled(value, F.abs(value)))


def fmt_pct(col: Column) -> Column:
    value = col.cast("double")
    return _or_missing(value, F.concat(plain_2dp(value), F.lit("%")))


def fmt_x(col: Column) -> Column:
    value = col.cast("double")
    return _or_missing(value, F.concat(plain_2dp(value), F.lit("x")))


def coverage_assessment(ratio: Column, target: float = 3.0) -> Column:
    """Class of a pipeline coverage multiple against its target."""
    value = ratio.cast("double")
    return (
        F.when(value.isNull() | F.isnan(value), COVERAGE_UNKNOWN)
        .when(value < target, COVERAGE_LOW)
        .when(value < target * 2, COVERAGE_HEALTHY)
        .when(value < COVERAGE_STRONG_BELOW, COVERAGE_STRONG)
        .otherwise(COVERAGE_VERY_HIGH)
    )


def retention_display(value: Column, start_mrr: Column) -> Column:
    """A retention percentage, or why it should not be shown."""
    return (
        F.when(value.isNull(), RETENTION_MISSING)
        .when((start_mrr > 0) & (value == 0), RETENTION_NOT_LOADED)
        .otherwise(fmt_pct(value))
    )
