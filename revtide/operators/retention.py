"""Net and gross revenue retention (NRR, GRR) and when they may be read."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtide.functions.numbers import count_if, percent, zero_if_null
from revtide.operators.filters import EVERYTHING, Context, DimFilter, scoped_mrr
from revtide.operators.mrr import MONTHS_PER_YEAR

# Threshold and notes of the quality gate.
COVERAGE_THRESHOLD_PCT = 90.0
NOTE_NO_COHORT = "Retention cohort month not available for selected filters."
NOTE_INTERPRETABLE = "Retention is interpretable (next-month MRR coverage is high)."
NOTE_NOT_INTERPRETABLE = (
    "Retention is NOT interpretable: next-month MRR appears incomplete/not loaded "
    "for the selected period."
)


def monthly_revenue(complete: DataFrame) -> DataFrame:
    """Everything the monthly marts need, in one pass over the dense fact.

    ``last_month`` is the last month with any revenue. It is found among the monthly
    rows, of which there are no more than calendar months, so the fact is not scanned
    a second time for it.
    """
    mrr, before = F.col("total_mrr"), F.col("previous_mrr")
    had_revenue = before > 0
    by_month = complete.groupBy("month").agg(
        F.sum(mrr).alias("total_mrr"),
        F.sum(F.when(had_revenue, before)).alias("start_mrr"),
        F.sum(F.when(had_revenue, mrr)).alias("end_mrr"),
        F.sum(F.when(had_revenue, F.least(mrr, before))).alias("retained_mrr"),
        count_if(had_revenue).alias("cohort_rows"),
        F.max(F.when(mrr > 0, F.col("month"))).alias("revenue_month"),
    )
    return by_month.withColumn(
        "last_month", F.max("revenue_month").over(Window.partitionBy())
    ).drop("revenue_month")


def _loaded(monthly: DataFrame) -> DataFrame:
    return monthly.where(F.col("month") <= F.col("last_month"))


def _with_cohort(monthly: DataFrame) -> DataFrame:
    return _loaded(monthly).where(F.col("cohort_rows") > 0)


def nrr_from(monthly: DataFrame) -> DataFrame:
    return _with_cohort(monthly).select(
        "month",
        "start_mrr",
        "end_mrr",
        percent(F.col("end_mrr"), F.col("start_mrr")).alias("nrr_pct"),
    )


def grr_from(monthly: DataFrame) -> DataFrame:
    return _with_cohort(monthly).select(
        "month",
        "start_mrr",
        "retained_mrr",
        percent(F.col("retained_mrr"), F.col("start_mrr")).alias("grr_pct"),
    )


def arr_from(monthly: DataFrame) -> DataFrame:
    return _loaded(monthly).select(
        "month", (F.col("total_mrr") * MONTHS_PER_YEAR).alias("total_arr")
    )


def nrr_monthly(complete: DataFrame) -> DataFrame:
    """Revenue now of the accounts that had revenue a month before, per month."""
    return nrr_from(monthly_revenue(complete))


def grr_monthly(complete: DataFrame) -> DataFrame:
    """As NRR, with each account counted up to its earlier revenue."""
    return grr_from(monthly_revenue(complete))


def arr_monthly(complete: DataFrame) -> DataFrame:
    """Annualised revenue of the company up to the last month with revenue."""
    return arr_from(monthly_revenue(complete))


def retention_trend(ctx: Context, start: date, end: date, filt: DimFilter = EVERYTHING) -> DataFrame:
    """Cohort of month T followed to month T+1, labelled by T.

    The following month is the account's next row if that row is one month later,
    else zero. The newest month of the range has no following month and is left out;
    it is found among the monthly rows.
    """
    timeline = Window.partitionBy("account_id").orderBy("month")
    mrr = F.col("total_mrr")
    followed = scoped_mrr(ctx, start, end, filt, by_account=True).select(
        "month",
        "total_mrr",
        F.when(
            F.lead("month").over(timeline) == F.add_months("month", 1),
            F.lead("total_mrr").over(timeline),
        ).alias("next_mrr"),
    )
    after = zero_if_null(F.col("next_mrr"))
    in_cohort = mrr > 0
    by_month = (
        followed.groupBy("month")
        .agg(
            count_if(in_cohort).alias("cohort_rows"),
            F.sum(F.when(in_cohort, mrr)).alias("start_mrr"),
            F.sum(F.when(in_cohort, after)).alias("end_mrr"),
            F.sum(F.when(in_cohort, F.least(after, mrr))).alias("retained_mrr"),
        )
        .withColumn("newest", F.max("month").over(Window.partitionBy()))
    )
    return (
        by_month.where((F.col("month") < F.col("newest")) & (F.col("cohort_rows") > 0))
        .select(
            "month",
            *(F.round(c, 2).alias(c) for c in ("start_mrr", "end_mrr", "retained_mrr")),
            percent(F.col("end_mrr"), F.col("start_mrr")).alias("nrr_pct"),
            percent(F.col("retained_mrr"), F.col("start_mrr")).alias("grr_pct"),
        )
        .orderBy("month")
    )


def retention_quality(
    ctx: Context,
    start: date,
    end: date,
    filt: DimFilter,
    cohort_month: date | Column | None,
    threshold: float = COVERAGE_THRESHOLD_PCT,
    strict: bool = False,
) -> DataFrame:
    """One row telling whether retention of ``cohort_month`` should be read.

    By default every account with any row in the next month counts as covered. With
    ``strict`` only cohort accounts with revenue in the next month do. A cohort month
    may be a column, such as a scalar subquery; null means there is none.
    """
    if isinstance(cohort_month, Column):
        cohort = cohort_month
    else:
        cohort = F.lit(cohort_month).cast("date")
    following = F.add_months(cohort, 1)
    month, mrr = F.col("month"), F.col("total_mrr")
    per_account = (
        scoped_mrr(ctx, start, end, filt)
        .where((month == cohort) | (month == following))
        .groupBy("account_id")
        .agg(
            F.max((month == cohort) & (mrr > 0)).alias("in_cohort"),
            F.max(month == following).alias("has_next"),
            F.max((month == following) & (mrr > 0)).alias("has_next_revenue"),
        )
    )
    covered = F.col("in_cohort") & F.col("has_next_revenue") if strict else F.col("has_next")
    counts = per_account.agg(
        count_if(F.col("in_cohort")).alias("cohort"), count_if(covered).alias("following")
    )
    return counts.select(
        F.inline(F.array(quality_of(cohort, F.col("cohort"), F.col("following"), threshold)))
    )


def quality_of(
    cohort_month: Column,
    cohort_accounts: Column,
    next_month_accounts: Column,
    threshold: float = COVERAGE_THRESHOLD_PCT,
) -> Column:
    """The gate's record from its counts; null counts where there is no cohort month."""
    known = cohort_month.isNotNull()
    coverage = F.when(known, percent(next_month_accounts, cohort_accounts))
    readable = F.coalesce(coverage >= threshold, F.lit(False))
    return F.struct(
        F.when(known, cohort_accounts).alias("cohort_accounts"),
        F.when(known, next_month_accounts).alias("next_month_accounts"),
        coverage.alias("next_month_coverage_pct"),
        readable.alias("retention_interpretable"),
        F.lit(float(threshold)).alias("coverage_threshold_pct"),
        F.when(~known, NOTE_NO_COHORT)
        .when(readable, NOTE_INTERPRETABLE)
        .otherwise(NOTE_NOT_INTERPRETABLE)
        .alias("retention_note"),
    )
