"""Account health: the stored snapshot, the computed one, and lists drawn from them."""

from __future__ import annotations

import logging
from datetime import date

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtide.functions.numbers import ratio, zero_if_null
from revtide.functions.periods import in_months
from revtide.operators.filters import (
    EVERYTHING,
    Context,
    DimFilter,
    indexed_months,
    newest_month,
    newest_rows,
    scoped_mrr,
)
from revtide.operators.mrr import fct_mrr

_log = logging.getLogger(__name__)

# Fixed values of the stored health model.
HIGH_VALUE_ABOVE = 100000
# Fixed values of the computed health model.
BASE_SCORE, LOWEST_SCORE, HIGHEST_SCORE = 70, 0, 100
TREND_POINTS, CHURN_POINTS = 15, -50
MANY_TICKETS, MANY_TICKETS_POINTS = 8, -20
SOME_TICKETS, SOME_TICKETS_POINTS = 4, -10
TICKET_DAYS = 90


def _recent_months(complete: DataFrame) -> Column:
    """Scalar struct of the last month with revenue and the two calendar months before.

    The calendar is read off the fact itself; it has one entry per month. Accounts
    without an id have no revenue and are skipped, as the join with accounts does, so
    that both readers of a fact that is still a plan share its shuffle.
    """
    seen = complete.where(F.col("account_id").isNotNull()).agg(
        F.max(F.when(F.col("total_mrr") > 0, F.col("month"))).alias("latest"),
        F.array_sort(F.collect_set("month")).alias("calendar"),
    )
    at = F.array_position("calendar", F.col("latest")).cast("int")
    return seen.select(
        F.struct(
            F.col("latest").alias("m0"),
            F.get("calendar", at - 2).alias("m1"),
            F.get("calendar", at - 3).alias("m2"),
        ).alias("recent")
    ).scalar()


def _planned_months(accounts: DataFrame, sub_mrr: DataFrame, dim_date: DataFrame) -> Column:
    """What ``_recent_months`` gives for the dense fact, from the rows it is made of.

    A month with revenue but no negative row has an account above zero, so the last of
    these bounds the answer from below, and only rows from it on are summed by account.
    """
    calendar = dim_date.agg(F.array_sort(F.collect_set("month_start"))).scalar()
    known = sub_mrr.where(F.array_contains(calendar, F.col("month"))).join(
        accounts.select("account_id"), "account_id", "left_semi"
    )
    by_month = known.groupBy("month").agg(F.min("mrr").alias("least"), F.max("mrr").alias("most"))
    bound = by_month.where("least >= 0 and most > 0").agg(F.max("month")).scalar()
    late = known.where(F.col("month") >= F.coalesce(bound, F.get(calendar, F.lit(0))))
    paid = fct_mrr(late).where("total_mrr > 0").agg(F.max("month").alias("latest"))
    at = F.array_position(calendar, F.col("latest")).cast("int")
    return paid.select(
        F.struct(
            F.col("latest").alias("m0"),
            F.get(calendar, at - 2).alias("m1"),
            F.get(calendar, at - 3).alias("m2"),
        ).alias("recent")
    ).scalar()


def account_health(
    accounts: DataFrame,
    complete: DataFrame,
    pipe: DataFrame,
    months: DataFrame | None = None,
    rows_of: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """One row per account for the last month with revenue.

    ``complete`` is the dense fact, where the previous row is the previous calendar
    month, so three months of it are enough: they are picked out and summed up per
    account instead of ordering every account's whole history. ``months``, the fact's
    month index, tells which three without reading the fact. Of a fact that is still a
    plan, ``rows_of`` has the subscription rows and calendar it is made of: then three
    months of these are summed, and the fact is not computed.
    """
    if rows_of is not None:
        recent = _planned_months(accounts, *rows_of)
        newest = [recent[name] for name in ("m0", "m1", "m2")]
        complete = fct_mrr(rows_of[0]).where(F.col("account_id").isNotNull())
    elif months is None:
        recent = _recent_months(complete)
        newest = [recent[name] for name in ("m0", "m1", "m2")]
    else:
        loaded = months.where("has_revenue").agg(F.max("month")).scalar()
        known = indexed_months(months.where(F.col("month") <= loaded), 3)
        newest = [known[name] for name in ("m0", "m1", "m2")]
    recent = dict(zip(("m0", "m1", "m2"), newest))
    month, mrr = F.col("month"), F.col("total_mrr")
    picked = {name: month == recent[name] for name in ("m0", "m1", "m2")}
    revenue = (
        complete.where(picked["m0"] | picked["m1"] | picked["m2"])
        .groupBy("account_id")
        .agg(*(F.max(F.when(is_month, mrr)).alias(name) for name, is_month in picked.items()))
    )
    open_value = (
        pipe.where(~F.col("is_closed"))
        .groupBy("account_id")
        .agg(F.sum("amount").alias("open_value"))
    )
    joined = (
        accounts.select("account_id")
        .join(revenue, "account_id", "left")
        .join(open_value, "account_id", "left")
    )
    if rows_of is not None:
        # The dense fact has a zero for each of its accounts and months.
        kind = revenue.schema["m0"].dataType
        in_fact = {name: F.col("account_id").isNotNull() & month.isNotNull() for name, month in recent.items()}
        zeros = {name: F.when(known, F.lit(0).cast(kind)) for name, known in in_fact.items()}
        joined = joined.withColumns({name: F.coalesce(name, zero) for name, zero in zeros.items()})
    now, one_ago, two_ago = F.col("m0"), F.col("m1"), F.col("m2")
    has_open = F.coalesce(F.col("open_value") > 0, F.lit(False))
    no_open = zero_if_null(F.col("open_value")) == 0
    fell, rose = now < one_ago, now > one_ago
    revenue_points = F.when(now == 0, -3).when(fell, -1).when(rose, 1).otherwise(0)
    return joined.select(
        "account_id",
        zero_if_null(now).alias("latest_mrr"),
        zero_if_null(one_ago).alias("mrr_1m_ago"),
        zero_if_null(two_ago).alias("mrr_2m_ago"),
        zero_if_null(F.col("open_value")).alias("open_pipeline_value"),
        F.when(rose & (one_ago > two_ago), "Growing")
        .when(fell & (one_ago < two_ago), "Declining")
        .otherwise("Stable")
        .alias("mrr_trend_3m"),
        F.when(now > HIGH_VALUE_ABOVE, 1).otherwise(0).alias("high_value_flag"),
        (revenue_points + has_open.cast("int")).alias("health_score"),
        F.when(now == 0, "Lost")
        .when(fell & no_open, "High Risk")
        .when(fell, "At Risk")
        .when(rose, "Growing")
        .otherwise("Stable")
        .alias("health_status"),
    )


def latest_snapshot(df: DataFrame, start: date, end: date) -> DataFrame:
    """Rows of the newest month inside the range."""
    scoped = df.where(in_months(F.col("month"), start, end))
    return scoped.where(F.col("month") == scoped.agg(F.max("month")).scalar())


def _last_three(ctx: Context, start: date, end: date, filt: DimFilter) -> tuple[DataFrame, Column]:
    """Each account's three newest rows with their place ``back``, and the newest month.

    With a month index these are the rows of the three newest months, as the fact is dense.
    """
    scoped = scoped_mrr(ctx, start, end, filt)
    if ctx.months is None:
        rows = newest_rows(scoped, 3)
        return rows, newest_month(rows)
    newest = indexed_months(ctx.months.where(in_months(F.col("month"), start, end)), 3)
    month = F.col("month")
    back = F.when(month == newest["m0"], 1).when(month == newest["m1"], 2).when(month == newest["m2"], 3)
    rows = scoped.where((month == newest["m0"]) | (month == newest["m1"]) | (month == newest["m2"]))
    return rows.withColumn("back", back), newest["m0"]


def computed_health(
    ctx: Context,
    start: date,
    end: date,
    filt: DimFilter = EVERYTHING,
    tickets: DataFrame | None = None,
) -> DataFrame:
    """Health of the accounts with a row in the newest month of the range.

    Previous revenue and the moving mean go by the account's rows in the range.
    ``tickets`` defaults to the context's; without any, every count is zero.
    """
    tickets = ctx.tickets if tickets is None else tickets
    last_three, newest = _last_three(ctx, start, end, filt)
    mrr, back = F.col("total_mrr"), F.col("back")
    snapshot = (
        last_three.groupBy("account_id")
        .agg(
            F.max("month").alias("month"),
            F.max(F.when(back == 1, mrr)).alias("total_mrr"),
            zero_if_null(F.max(F.when(back == 2, mrr))).alias("before"),
            F.sum(mrr).alias("sum_3m"),
            F.count(mrr).alias("rows_3m"),
        )
        .where(F.col("month") == newest)
    )

    attributes = ctx.accounts.select("account_id", "account_name", "segment", "region", "industry")
    mrr, before = F.col("total_mrr"), F.col("before")
    figures = snapshot.join(attributes, "account_id").select(
        *attributes.columns,
        F.round(mrr, 2).alias("total_mrr"),
        F.round(before, 2).alias("prev_mrr"),
        ratio(mrr - before, before, digits=4).alias("mom_mrr_pct"),
        ratio(F.col("sum_3m"), F.col("rows_3m")).alias("mrr_avg_3m"),
    )
    if tickets is None:
        counted = figures.withColumn("ticket_cnt_90d", F.lit(0).cast("bigint"))
    else:
        recent = (
            tickets.where(F.col("created_date") >= F.date_sub(newest, TICKET_DAYS))
            .groupBy("account_id")
            .agg(F.count("*").alias("tickets"))
        )
        counted = (
            figures.join(recent, "account_id", "left")
            .withColumn("ticket_cnt_90d", zero_if_null(F.col("tickets")))
            .drop("tickets")
        )
    return counted.select("*", _score().alias("health_score"), _status().alias("health_status"))


def _score() -> Column:
    now, before, tickets = F.col("total_mrr"), F.col("prev_mrr"), F.col("ticket_cnt_90d")
    points = (
        F.lit(BASE_SCORE)
        + F.when(now > before, TREND_POINTS).when(now < before, -TREND_POINTS).otherwise(0)
        + F.when((before > 0) & (now == 0), CHURN_POINTS).otherwise(0)
        + F.when(tickets >= MANY_TICKETS, MANY_TICKETS_POINTS)
        .when(tickets >= SOME_TICKETS, SOME_TICKETS_POINTS)
        .otherwise(0)
    )
    return F.greatest(F.lit(LOWEST_SCORE), F.least(F.lit(HIGHEST_SCORE), points))


def _status() -> Column:
    now, before, tickets = F.col("total_mrr"), F.col("prev_mrr"), F.col("ticket_cnt_90d")
    return (
        F.when((before > 0) & (now == 0), "Lost")
        .when((now == 0) & (before == 0), "Stable")
        .when(tickets >= MANY_TICKETS, "High Risk")
        .when(now < before, "At Risk")
        .when(now > before, "Growing")
        .otherwise("Stable")
    )


def health_distribution(health: DataFrame) -> DataFrame:
    return health.groupBy("health_status").agg(F.count("*").alias("count"))


def at_risk(health: DataFrame, n: int | None = None) -> DataFrame:
    """Accounts from the lowest score on, or by status without a score; all or ``n`` of them.

    Equal scores are ordered by account_id, as is a frame with neither column.
    """
    order = [c for c in ("health_score", "health_status") if c in health.columns][:1]
    ordered = health.orderBy(*(F.col(c).asc_nulls_last() for c in order), "account_id")
    return ordered if n is None else ordered.limit(n)


#: What a stored health table must hold to stand in for the computed one.
SNAPSHOT_COLUMNS = ("account_id", "month", "health_score", "health_status")


def _stored_snapshot(ctx: Context, start: date, end: date, filt: DimFilter) -> DataFrame | None:
    """Rows of the stored table's newest month in the range; None if it cannot serve.

    A table without the columns, one that cannot be read and one without rows there
    all lead to the computed model.
    """
    if ctx.health is None:
        return None
    try:
        if not set(SNAPSHOT_COLUMNS) <= set(ctx.health.columns):
            return None
        kept = filt.apply(latest_snapshot(ctx.health, start, end), ctx.accounts, ctx.reps, "owner_rep_id")
        kept = kept.select("account_id", F.col("health_score").cast("int").alias("health_score"), "health_status")
        return kept if kept.head(1) else None
    except (PySparkException, Py4JError) as e:
        _log.warning("the stored health table cannot be read, so health is computed: %s", str(e).splitlines()[0])
        return None


def health_snapshot(
    ctx: Context,
    start: date,
    end: date,
    filt: DimFilter = EVERYTHING,
) -> DataFrame:
    """The stored snapshot's newest month in the range if it has rows there, else the computed one.

    Columns are account_id, health_score and health_status, which both have. One row of
    the stored table is read to decide, so the plan holds the chosen branch alone.
    """
    kept = _stored_snapshot(ctx, start, end, filt)
    if kept is not None:
        return kept
    return computed_health(ctx, start, end, filt).select("account_id", "health_score", "health_status")
