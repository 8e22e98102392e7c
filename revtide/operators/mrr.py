"""Monthly recurring revenue (MRR): facts, movements, annualised revenue, movers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtide.functions.movement import movement_class
from revtide.functions.numbers import zero_if_null
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

MONTHS_PER_YEAR = 12


def fct_mrr(sub_mrr: DataFrame) -> DataFrame:
    """Revenue by account and month.

    Rows are summed on the map side first, so an account with a large share of all
    subscriptions sends only one row per month and map task.
    """
    return sub_mrr.groupBy("account_id", "month").agg(F.sum("mrr").alias("total_mrr"))


def _by_month() -> Window:
    """An account's rows in time order; there is at most one per month."""
    return Window.partitionBy("account_id").orderBy(F.col("month").asc_nulls_last())


def _with_movement(df: DataFrame, previous: Column, rule: str = "mart") -> DataFrame:
    before = zero_if_null(previous)
    return df.select(
        "account_id",
        "month",
        "total_mrr",
        before.alias("previous_mrr"),
        (F.col("total_mrr") - before).alias("mrr_change"),
        movement_class(F.col("total_mrr"), previous, rule).alias("movement_type"),
    )


def mrr_movement(mrr: DataFrame, rule: str = "mart") -> DataFrame:
    """Each row against the account's previous row; months without a row are skipped."""
    paired = mrr.select(
        "account_id", "month", "total_mrr", F.lag("total_mrr").over(_by_month()).alias("before")
    )
    return _with_movement(paired, F.col("before"), rule)


def fct_mrr_complete(mrr: DataFrame, accounts: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Every account in every calendar month, with zero where there is no revenue.

    Only rows with revenue, plus one anchor per account, are shuffled and sorted. Each
    then unfolds into its own month and the empty months up to the next row, so the
    dense grid appears after the last exchange and never crosses the network. Revenue
    of unknown accounts or of months outside the calendar is dropped.
    """
    calendar = dim_date.agg(F.array_sort(F.collect_set("month_start")).alias("months")).scalar()
    # One row per calendar month; ``at`` is its position from 1.
    months = mrr.sparkSession.range(1).select(F.posexplode(calendar).alias("at", "month"))
    revenue = (
        mrr.where(F.col("account_id").isNotNull())
        .join(months, "month")
        .select("account_id", (F.col("at") + 1).alias("at"), "total_mrr")
    )
    anchors = (
        accounts.select("account_id")
        .distinct()
        .select("account_id", F.lit(0).alias("at"), F.lit(None).cast("int").alias("total_mrr"))
    )
    rows = revenue.unionByName(anchors)

    timeline = Window.partitionBy("account_id").orderBy("at")
    spans = rows.select(
        "account_id",
        "at",
        zero_if_null(F.col("total_mrr")).alias("total_mrr"),
        F.first("at").over(timeline).alias("first_at"),
        F.lag("at").over(timeline).alias("before_at"),
        zero_if_null(F.lag("total_mrr").over(timeline)).alias("before_mrr"),
        F.lead("at").over(timeline).alias("next_at"),
    ).where(F.col("first_at") == 0)

    begin = F.greatest(F.col("at"), F.lit(1))
    stop = F.coalesce("next_at", F.size(calendar) + 1)
    unfolded = spans.select("*", F.posexplode(F.slice(calendar, begin, stop - begin)).alias("k", "month"))

    own_month = (F.col("at") > 0) & (F.col("k") == 0)
    month_after = (F.col("at") > 0) & (F.col("k") == 1)
    adjacent = F.col("before_at") == F.col("at") - 1
    zero = F.lit(0).cast(mrr.schema["total_mrr"].dataType)
    previous = (
        F.when(own_month & adjacent, F.col("before_mrr"))
        .when(month_after, F.col("total_mrr"))
        .otherwise(zero)
    )
    grid = unfolded.select(
        "account_id",
        "month",
        F.when(own_month, F.col("total_mrr")).otherwise(zero).alias("total_mrr"),
        previous.alias("before"),
    )
    return _with_movement(grid, F.col("before"))


def fct_arr(complete: DataFrame) -> DataFrame:
    """Annualised revenue by account and month."""
    return complete.select(
        "account_id", "month", "total_mrr", (F.col("total_mrr") * MONTHS_PER_YEAR).alias("arr")
    )


def arr_trend(ctx: Context, start: date, end: date, filt: DimFilter = EVERYTHING) -> DataFrame:
    """Annualised revenue of the selected accounts by month."""
    by_month = scoped_mrr(ctx, start, end, filt).groupBy("month").agg(F.sum("total_mrr").alias("mrr"))
    arr = F.round(F.col("mrr") * MONTHS_PER_YEAR, 2)
    return by_month.select("month", arr.alias("total_arr")).orderBy("month")


def movement_summary(ctx: Context, start: date, end: date, filt: DimFilter = EVERYTHING) -> DataFrame:
    """Rows and net change by movement class, seen from inside the month range."""
    moves = mrr_movement(scoped_mrr(ctx, start, end, filt, by_account=True), rule="app")
    return (
        moves.groupBy("movement_type")
        .agg(
            F.count("*").alias("rows_count"),
            F.round(F.sum("mrr_change"), 2).alias("net_mrr_change"),
        )
        .orderBy("movement_type")
    )


#: The two lists of movers.
EXPANSION, CONTRACTION = "expansion", "contraction"
#: Rows of a list up to which the winners are surely small enough to broadcast.
BROADCAST_ROWS = 100_000


def movers(
    ctx: Context,
    start: date,
    end: date,
    filt: DimFilter = EVERYTHING,
    n: int = 10,
) -> DataFrame:
    """The ``n`` largest rises and falls into the newest month of the range, as one frame.

    ``direction`` tells the list and ``place`` the rank in it from 1; equal changes are
    ordered by account_id. Both lists come from one pass over the two newest months, and
    account attributes are looked up for the winners only. With a month index just the two
    months' folders are read.
    """
    rows, newest = _two_newest(ctx, start, end, filt)
    month, mrr = F.col("month"), F.col("total_mrr")
    pair = (
        rows.where(month >= F.add_months(newest, -1))
        .groupBy("account_id")
        .agg(
            zero_if_null(F.max(F.when(month == newest, mrr))).alias("current"),
            zero_if_null(F.max(F.when(month == F.add_months(newest, -1), mrr))).alias("before"),
        )
    )
    scored = pair.select(
        "account_id",
        F.round("current", 2).alias("mrr_curr"),
        F.round("before", 2).alias("mrr_prev"),
        F.round(F.col("current") - F.col("before"), 2).alias("mrr_delta"),
    )
    # One row an account and list; falls are ranked by the change turned round.
    signed = F.inline(
        F.array(
            F.struct(F.lit(EXPANSION).alias("direction"), F.col("mrr_delta").alias("gain")),
            F.struct(F.lit(CONTRACTION).alias("direction"), (-F.col("mrr_delta")).alias("gain")),
        )
    )
    ranked = Window.partitionBy("direction").orderBy(F.col("gain").desc_nulls_last(), "account_id")
    # Tasks keep their own first rows of each list before anything moves.
    top = (
        scored.select("*", signed)
        .withColumn("place", F.row_number().over(ranked))
        .where(F.col("place") <= n)
        .drop("gain")
    )
    attributes = ctx.accounts.select("account_id", "account_name", "segment", "region", "industry")
    winners = F.broadcast(top) if n <= BROADCAST_ROWS else top
    return winners.join(attributes, "account_id")


def _two_newest(ctx: Context, start: date, end: date, filt: DimFilter) -> tuple[DataFrame, Column]:
    """Rows that hold those of the newest month of the selected accounts and of the month
    before, and that newest month."""
    scoped = scoped_mrr(ctx, start, end, filt)
    if ctx.months is None:
        # They are among each account's two newest rows.
        rows = newest_rows(scoped, 2)
        return rows, newest_month(rows)
    newest = indexed_months(ctx.months.where(in_months(F.col("month"), start, end)), 1)["m0"]
    month = F.col("month")
    return scoped.where((month == newest) | (month == F.add_months(newest, -1))), newest


def top_movers(
    ctx: Context,
    start: date,
    end: date,
    filt: DimFilter = EVERYTHING,
    n: int = 10,
) -> tuple[DataFrame, DataFrame]:
    """The lists of ``movers`` apart: (expansions, contractions)."""
    both = movers(ctx, start, end, filt, n)
    shown = [c for c in both.columns if c not in ("direction", "place")]
    return tuple(
        both.where(F.col("direction") == name).orderBy("place").select(*shown)
        for name in (EXPANSION, CONTRACTION)
    )
