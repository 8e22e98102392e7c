"""Classes of month-on-month revenue movement."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The class names.
NEW, CHURN, EXPANSION, CONTRACTION, FLAT = "New", "Churn", "Expansion", "Contraction", "Flat"


def movement_class(current: Column, previous: Column, rule: str = "mart") -> Column:
    """Name the movement from ``previous`` (null when there is none) to ``current``.

    ``mart``: revenue coming back from zero is New, and a fall counts as Contraction
    only while revenue stays positive. ``app``: only a row without predecessor is New,
    and any other fall is Contraction.
    """
    stopped = (previous > 0) & (current == 0)
    if rule == "mart":
        before = F.coalesce(previous, F.lit(0))
        started = (before == 0) & (current > 0)
        shrank = (current < previous) & (current > 0)
    elif rule == "app":
        started = previous.isNull() & (current > 0)
        shrank = current < previous
    else:
        raise ValueError(f"unknown movement rule: {rule!r}")
    return (
        F.when(started, NEW)
        .when(stopped, CHURN)
        .when(current > previous, EXPANSION)
        .when(shrank, CONTRACTION)
        .otherwise(FLAT)
    )
