"""Stage funnel: how long deals stay in a stage and where they go next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtide.functions.numbers import percent, ratio
from revtide.functions.periods import days_between
from revtide.operators.filters import EVERYTHING, Context, DimFilter


def _days() -> Column:
    return days_between(F.col("stage_start_date"), F.col("stage_end_date"))


def stage_velocity(hist: DataFrame) -> DataFrame:
    """Deals and mean days by stage, over stages that have ended."""
    return (
        hist.where(F.col("stage_end_date").isNotNull())
        .groupBy("stage")
        .agg(
            F.count_distinct("opp_id").alias("deals_reached_stage"),
            F.avg(_days()).alias("avg_stage_duration_days"),
        )
    )


def stage_steps(hist: DataFrame) -> DataFrame:
    """(opp_id, from_stage, to_stage, steps): moves from one stage row to the next.

    Rows follow each other by start date, then end date (open last), then stage. Rows
    without an opp_id belong to no deal and are left out.

    Equal rows are counted before anything is ordered, on the map side too; n equal rows
    are n-1 moves within the stage and one move on. A deal's rows are ordered start date by
    start date, and the first rows of its dates are ordered apart, so a deal with a large
    share of all rows spans as many tasks as it has dates, and no task holds more of it
    than one date's rows or one row a date.
    """
    return _steps_and_ends(hist).where(F.col("steps") > 0)


def _steps_and_ends(hist: DataFrame) -> DataFrame:
    """``stage_steps``, and of each deal's last row 0 steps to null."""
    day = ["opp_id", "stage_start_date"]
    runs = (
        hist.where(F.col("opp_id").isNotNull())
        .groupBy(*day, "stage_end_date", "stage")
        .agg(F.count("*").alias("copies"))
    )
    in_day = Window.partitionBy(*day).orderBy(
        F.col("stage_end_date").asc_nulls_last(), F.col("stage").asc_nulls_last()
    )
    ordered = runs.select(
        *day,
        "stage",
        "copies",
        F.row_number().over(in_day).alias("place"),
        F.lead(F.struct("stage")).over(in_day).alias("in_day"),
    )
    dates = Window.partitionBy("opp_id").orderBy(F.col("stage_start_date").asc_nulls_last())
    # Reads the same columns as the other side, so that both share one shuffle.
    next_day = (
        ordered.where(F.col("place") == 1)
        .select(*day, F.lead(F.struct("stage", "copies")).over(dates).alias("next_day"))
    )
    on, after = ordered.alias("on"), next_day.alias("after")
    same = (F.col("on.opp_id") == F.col("after.opp_id")) & F.col("on.stage_start_date").eqNullSafe(
        F.col("after.stage_start_date")
    )
    paired = on.join(after, same).select(
        F.col("on.opp_id").alias("opp_id"),
        "stage",
        "copies",
        F.coalesce("in_day", F.when(F.col("next_day").isNotNull(), F.struct("next_day.stage"))).alias("following"),
    )
    within = F.struct(F.col("stage").alias("to_stage"), (F.col("copies") - 1).alias("steps"))
    onward = F.struct(
        F.col("following.stage").alias("to_stage"),
        F.when(F.col("following").isNotNull(), 1).otherwise(0).cast("bigint").alias("steps"),
    )
    repeats = F.when(F.col("copies") > 1, F.array(within, onward)).otherwise(F.array(onward))
    return paired.select("opp_id", F.col("stage").alias("from_stage"), F.inline(repeats))


def _funnel(hist: DataFrame, progressed: Column) -> DataFrame:
    """Moves between stages and the deals of each stage, from one pass over the steps.

    Grouping sets sum up both; there are as many rows as pairs of stages when the two meet.
    """
    moves = _steps_and_ends(hist).withColumn("moved", F.col("steps") > 0)
    pair = ["from_stage", "to_stage", "moved"]
    sums = moves.groupingSets([pair, ["from_stage"]], *pair).agg(
        F.count_distinct("opp_id").alias("deals"),
        F.sum("steps").alias("steps"),
        F.grouping_id().alias("level"),
    )
    of_stage = F.max(F.when(F.col("level") > 0, F.col("deals"))).over(Window.partitionBy("from_stage"))
    met = sums.withColumn("deals_in_stage", of_stage).where(
        (F.col("level") == 0) & F.col("moved") & F.col("from_stage").isNotNull()
    )
    rate = percent(F.col("deals_progressed"), F.col("deals_in_stage"))
    return met.withColumn("deals_progressed", progressed).select(
        "from_stage",
        "to_stage",
        "deals_progressed",
        "deals_in_stage",
        rate.alias("conversion_rate_pct"),
    )


def stage_conversion(hist: DataFrame) -> DataFrame:
    """Share of the deals in a stage that moved on to each next stage."""
    return _funnel(hist, F.col("deals"))


def _scoped_history(ctx: Context, filt: DimFilter) -> DataFrame:
    if ctx.history is None:
        raise ValueError("stage metrics need the stage history")
    return filt.apply(ctx.history, ctx.accounts, ctx.reps, "owner_rep_id")


def stage_duration(ctx: Context, filt: DimFilter = EVERYTHING) -> DataFrame:
    """Deals and mean days by ended stage, for the selected accounts."""
    by_stage = (
        _scoped_history(ctx, filt)
        .where(F.col("stage_end_date").isNotNull())
        .groupBy("stage")
        .agg(
            F.count_distinct("opp_id").alias("deals_reached_stage"),
            F.sum(_days()).alias("days"),
            F.count(_days()).alias("stays"),
        )
    )
    return by_stage.select(
        "stage",
        "deals_reached_stage",
        ratio(F.col("days"), F.col("stays")).alias("avg_stage_duration_days"),
    ).orderBy(F.col("deals_reached_stage").desc(), "stage")


def stage_transitions(ctx: Context, filt: DimFilter = EVERYTHING) -> DataFrame:
    """Moves between stages over the deals in the first stage; repeats count again."""
    moves = _funnel(_scoped_history(ctx, filt), F.col("steps")).where(F.col("to_stage").isNotNull())
    return moves.orderBy(F.col("conversion_rate_pct").desc_nulls_first(), "from_stage", "to_stage")
