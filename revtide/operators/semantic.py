"""The governed monthly view over the revenue and sales marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.functions.numbers import percent
from revtide.operators.deals import pipeline_coverage, pipeline_monthly
from revtide.operators.retention import monthly_revenue


def _with_sales(revenue: DataFrame, monthly: DataFrame, coverage: DataFrame) -> DataFrame:
    """Add closed revenue by month, and the one coverage figure to every row.

    Without a coverage row the view is empty.
    """
    sales = monthly.select(
        F.col("close_month").alias("month"), "total_closed_revenue", "win_rate_pct"
    )
    only_row = coverage.select(F.struct("pipeline_coverage_ratio")).scalar()
    return (
        revenue.join(sales, "month", "left")
        .withColumn("coverage", only_row)
        .where(F.col("coverage").isNotNull())
        .select(
            "month",
            "total_arr",
            "nrr_pct",
            "grr_pct",
            "total_closed_revenue",
            "win_rate_pct",
            F.col("coverage.pipeline_coverage_ratio").alias("pipeline_coverage_ratio"),
        )
        .orderBy("month")
    )


def gtm_metrics(
    arr: DataFrame, nrr: DataFrame, grr: DataFrame, monthly: DataFrame, coverage: DataFrame
) -> DataFrame:
    """The view over stored marts, each of which has one row per month."""
    revenue = (
        arr.select("month", "total_arr")
        .join(nrr.select("month", "nrr_pct"), "month", "left")
        .join(grr.select("month", "grr_pct"), "month", "left")
    )
    return _with_sales(revenue, monthly, coverage)


def gtm_metrics_from_facts(complete: DataFrame, pipe: DataFrame) -> DataFrame:
    """The same view straight from the facts, with one pass over the revenue fact."""
    months = monthly_revenue(complete).where(F.col("month") <= F.col("last_month"))
    start = F.when(F.col("cohort_rows") > 0, F.col("start_mrr"))
    revenue = months.select(
        "month",
        (F.col("total_mrr") * 12).alias("total_arr"),
        percent(F.col("end_mrr"), start).alias("nrr_pct"),
        percent(F.col("retained_mrr"), start).alias("grr_pct"),
    )
    monthly = pipeline_monthly(pipe)
    return _with_sales(revenue, monthly, pipeline_coverage(pipe, monthly))
