"""Bounds and counts that show whether tables are loaded."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtide.operators.filters import Context


def quality_checks(ctx: Context) -> DataFrame:
    """(check, min, max, rows), with one aggregation per table.

    A bounds check leaves ``rows`` null and a count leaves the bounds null. Optional
    tables are checked when present.
    """
    checks = [
        _checks(ctx.mrr, "FCT_MRR", ("MRR date bounds", "month")),
        _checks(ctx.pipeline, "FCT_PIPELINE", ("Pipeline close bounds", "close_date")),
        _checks(ctx.accounts, "Accounts"),
    ]
    if ctx.history is not None:
        checks.append(_checks(ctx.history, "Stage History"))
    if ctx.tickets is not None:
        checks.append(_checks(ctx.tickets, "Support Tickets"))
    return reduce(DataFrame.unionAll, checks)


def _checks(df: DataFrame, label: str, bounds: tuple[str, str] | None = None) -> DataFrame:
    no_date = F.lit(None).cast("date")
    count = _row(f"Row count — {label}", no_date, no_date, F.col("n"))
    if bounds is None:
        return df.agg(F.count("*").alias("n")).select(F.inline(F.array(count)))
    name, column = bounds
    totals = df.agg(
        F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")
    )
    edge = _row(name, F.col("lo"), F.col("hi"), F.lit(None).cast("bigint"))
    return totals.select(F.inline(F.array(edge, count)))


def _row(check: str, lowest: Column, highest: Column, rows: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        lowest.alias("min"),
        highest.alias("max"),
        rows.alias("rows"),
    )
