"""Sales pipeline: opportunities, closed revenue, win rate, coverage."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtide.functions.numbers import count_if, percent, ratio
from revtide.functions.periods import closes_in_months, days_between, month_of
from revtide.operators.filters import EVERYTHING, Context, DimFilter, scoped_sums

COVERAGE_MONTHS = 3


def _closed() -> Column:
    return F.col("is_closed")


def _won() -> Column:
    return F.col("is_won")


def _amount() -> Column:
    return F.col("amount")


def _one_if(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def _amount_if(condition: Column, amount: Column | None = None) -> Column:
    return F.when(condition, _amount() if amount is None else amount).otherwise(F.lit(0))


def fct_pipeline(opps: DataFrame, as_of: date) -> DataFrame:
    """One row per opportunity, with expected value, sales cycle and age on ``as_of``."""
    created = F.col("created_date")
    return opps.select(
        "opp_id",
        "account_id",
        "product_id",
        "rep_id",
        "created_date",
        "close_date",
        "current_stage",
        "probability",
        "amount",
        (_amount() * F.col("probability")).alias("weighted_pipeline"),
        "is_closed",
        "is_won",
        F.when(_closed(), days_between(created, F.col("close_date"))).alias("sales_cycle_days"),
        F.when(~_closed(), days_between(created, F.lit(as_of))).alias("deal_age_days"),
    )


def pipeline_summary(pipe: DataFrame) -> DataFrame:
    """One row: open value, expected value, win rate and mean sales cycle."""
    cycle = F.when(_closed(), F.col("sales_cycle_days"))
    totals = pipe.agg(
        F.sum(_amount_if(~_closed())).alias("total_open_pipeline"),
        F.sum(_amount_if(~_closed(), F.col("weighted_pipeline"))).alias("total_weighted_pipeline"),
        count_if(_won()).alias("won"),
        count_if(_closed()).alias("closed"),
        F.sum(cycle).alias("cycle_days"),
        F.count(cycle).alias("cycles"),
    )
    return totals.select(
        "total_open_pipeline",
        "total_weighted_pipeline",
        percent(F.col("won"), F.col("closed")).alias("win_rate_pct"),
        ratio(F.col("cycle_days"), F.col("cycles")).alias("avg_sales_cycle_days"),
    )


def pipeline_monthly(pipe: DataFrame) -> DataFrame:
    """Closed deals by close month; deals without a close date form their own row."""
    cycle = F.col("sales_cycle_days")
    by_month = (
        pipe.where(_closed())
        .groupBy(month_of(F.col("close_date")).alias("close_month"))
        .agg(
            F.sum(_amount()).alias("total_closed_revenue"),
            F.sum(_amount_if(_won())).alias("total_won_revenue"),
            count_if(_won()).alias("won"),
            F.count("*").alias("closed"),
            F.sum(cycle).alias("cycle_days"),
            F.count(cycle).alias("cycles"),
        )
    )
    return by_month.select("close_month", *_closed_figures())


def _closed_figures() -> list[Column]:
    return [
        F.col("total_closed_revenue"),
        F.col("total_won_revenue"),
        percent(F.col("won"), F.col("closed")).alias("win_rate_pct"),
        ratio(F.col("cycle_days"), F.col("cycles")).alias("avg_sales_cycle_days"),
    ]


def pipeline_created_monthly(opps: DataFrame) -> DataFrame:
    """Opportunities created by month: number, value, mean size."""
    by_month = opps.groupBy(month_of(F.col("created_date")).alias("created_month")).agg(
        F.count("*").alias("opportunities_created"),
        F.sum(_amount()).alias("total_created_pipeline_value"),
        F.count(_amount()).alias("valued"),
    )
    mean = ratio(F.col("total_created_pipeline_value"), F.col("valued"))
    return by_month.select(
        "created_month",
        "opportunities_created",
        "total_created_pipeline_value",
        mean.alias("avg_created_deal_size"),
    )


def pipeline_coverage(pipe: DataFrame, monthly: DataFrame) -> DataFrame:
    """Open pipeline over the closed revenue of the newest close month.

    No row when no deal has a close month.
    """
    newest = (
        monthly.where(F.col("close_month").isNotNull())
        .orderBy(F.col("close_month").desc())
        .limit(1)
    )
    open_value = pipe.where(~_closed()).agg(F.sum(_amount())).scalar()
    row = newest.select(open_value.alias("total_open_pipeline"), "total_closed_revenue")
    return row.select(
        "*",
        ratio(F.col("total_open_pipeline"), F.col("total_closed_revenue")).alias(
            "pipeline_coverage_ratio"
        ),
    )


def closed_revenue_monthly(
    ctx: Context, start: date, end: date, filt: DimFilter = EVERYTHING
) -> DataFrame:
    """Closed deals of the selected accounts and reps by close month."""
    close = F.col("close_date")
    deals = ctx.pipeline.where(_closed() & closes_in_months(close, start, end)).withColumn(
        "close_month", month_of(close)
    )
    cycle = days_between(F.col("created_date"), close)
    sums = scoped_sums(
        deals,
        ctx,
        filt,
        ["close_month"],
        {
            "total_closed_revenue": _amount(),
            "total_won_revenue": _amount_if(_won()),
            "won": _one_if(_won()),
            "closed": F.lit(1),
            "cycle_days": cycle,
            "cycles": _one_if(cycle.isNotNull()),
        },
    )
    return sums.select("close_month", *_closed_figures()).orderBy("close_month")


def coverage_3m(ctx: Context, start: date, end: date, filt: DimFilter = EVERYTHING) -> DataFrame:
    """Open pipeline over the mean closed revenue of the last three close months.

    The range limits the closed months only. One pass sums both sides per close month,
    open deals under a null month; the three newest months are then picked among
    those few rows.
    """
    close = F.col("close_date")
    closed_in_range = _closed() & closes_in_months(close, start, end)
    deals = ctx.pipeline.where(~_closed() | closed_in_range).withColumn(
        "close_month", F.when(_closed(), month_of(close))
    )
    by_month = scoped_sums(deals, ctx, filt, ["is_closed", "close_month"], {"total": _amount()})
    newest_first = Window.partitionBy("is_closed").orderBy(F.col("close_month").desc())
    ranked = by_month.select(
        "is_closed", F.round("total", 2).alias("total"), F.row_number().over(newest_first).alias("at")
    )
    recent = F.when(_closed() & (F.col("at") <= COVERAGE_MONTHS), F.col("total"))
    totals = ranked.agg(
        F.max(F.when(~_closed(), F.col("total"))).alias("total_open_pipeline"),
        F.sum(recent).alias("recent"),
        F.count(recent).alias("months"),
    )
    open_value, recent_sum, months = (
        F.col(c) for c in ("total_open_pipeline", "recent", "months")
    )
    return totals.select(
        open_value,
        (recent_sum.cast("double") / F.nullif(months, F.lit(0))).alias("avg_3m_closed_revenue"),
        ratio(open_value * months, recent_sum).alias("pipeline_coverage_ratio"),
    )


def open_pipeline_by_stage(ctx: Context, filt: DimFilter = EVERYTHING) -> DataFrame:
    """Value, expected value and number of open deals by stage, largest first."""
    sums = scoped_sums(
        ctx.pipeline.where(~_closed()),
        ctx,
        filt,
        ["current_stage"],
        {
            "open_pipeline": _amount(),
            "weighted_pipeline": _amount() * F.col("probability"),
            "opp_count": F.lit(1),
        },
    )
    return sums.select(
        "current_stage",
        F.round("open_pipeline", 2).alias("open_pipeline"),
        F.round("weighted_pipeline", 2).alias("weighted_pipeline"),
        "opp_count",
    ).orderBy(F.col("open_pipeline").desc_nulls_first(), "current_stage")
