"""Headline figures, alerts and chart shapes over monthly series.

A series has one row per month, so its newest rows are found with a top-n and reduced
to one row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtide.functions.display import plain_2dp


@dataclass(frozen=True)
class Thresholds:
    """When to raise an alert."""

    nrr_below: float = 90.0
    grr_below: float = 90.0
    coverage_below: float = 3.0
    arr_months: int = 3


def latest_delta(
    series: DataFrame, time_col: str, values: Mapping[str, str], guard_col: str
) -> DataFrame:
    """Newest and previous value, and their difference, over rows with a positive guard.

    ``values`` maps a column to the prefix of its three outputs. The previous row is the
    previous row that passes the guard, not the previous calendar month. Always one
    row, with nulls where there is no value.
    """
    newest_two = (
        series.where(F.col(guard_col) > 0)
        .select(time_col, *{*values, guard_col} - {time_col})
        .orderBy(F.col(time_col).desc_nulls_last())
        .limit(2)
    )
    time = F.col(time_col)
    picks = [
        F.max(time).alias("latest_month"),
        F.max_by(guard_col, time).cast("double").alias("latest_guard"),
        F.count("*").alias("n"),
    ]
    for column in values:
        value = F.col(column).cast("double")
        picks += [
            F.max_by(value, time).alias(f"{column}_now"),
            F.min_by(value, time).alias(f"{column}_before"),
        ]
    row = newest_two.agg(*picks)
    outputs = [F.col("latest_month"), F.col("latest_guard")]
    for column, prefix in values.items():
        now = F.col(f"{column}_now")
        before = F.when(F.col("n") > 1, F.col(f"{column}_before"))
        outputs += [
            now.alias(f"{prefix}_latest"),
            before.alias(f"{prefix}_previous"),
            (now - before).alias(f"{prefix}_delta"),
        ]
    return row.select(*outputs)


def kpi_arr(arr_series: DataFrame) -> DataFrame:
    return latest_delta(arr_series, "month", {"total_arr": "arr"}, "total_arr").drop("latest_guard")


def kpi_retention(retention_series: DataFrame) -> DataFrame:
    kpis = latest_delta(
        retention_series, "month", {"nrr_pct": "nrr", "grr_pct": "grr"}, "start_mrr"
    )
    return kpis.withColumnRenamed("latest_guard", "start_mrr_latest")


def kpi_win_rate(closed_series: DataFrame) -> DataFrame:
    return latest_delta(
        closed_series, "close_month", {"win_rate_pct": "win_rate"}, "total_closed_revenue"
    ).drop("latest_guard")


def alerts(
    retention_kpis: DataFrame,
    coverage: DataFrame,
    arr_series: DataFrame,
    thresholds: Thresholds = Thresholds(),
) -> DataFrame:
    """(rule, value, threshold, message), one row per rule that fires.

    Nulls never fire. Annualised revenue is falling when the newest of its last rows is
    below the oldest of them; zero months count and fewer rows do not fire.
    """
    # Message texts.
    retention = [
        _candidate(
            "nrr", F.col("nrr_latest"), thresholds.nrr_below,
            f"Net Revenue Retention below {thresholds.nrr_below:.0f}% (NRR=", "%).",
        ),
        _candidate(
            "grr", F.col("grr_latest"), thresholds.grr_below,
            f"Gross Revenue Retention below {thresholds.grr_below:.0f}% (GRR=", "%).",
        ),
    ]
    cover = _candidate(
        "coverage", F.col("pipeline_coverage_ratio"), thresholds.coverage_below,
        f"Pipeline coverage below {thresholds.coverage_below:.1f}x (Coverage=", "x).",
    )
    # The candidates of one row are unfolded together, so each input is computed once.
    fired = [
        row.select(F.inline(F.array(*rules))).where(F.col("value") < F.col("threshold"))
        for row, rules in ((retention_kpis, retention), (coverage, [cover]))
    ]
    newest = arr_series.orderBy(F.col("month").desc()).limit(thresholds.arr_months)
    ends = newest.agg(
        F.max_by("total_arr", "month").cast("double").alias("value"),
        F.min_by("total_arr", "month").cast("double").alias("threshold"),
        F.count("*").alias("n"),
    ).where((F.col("n") >= max(3, thresholds.arr_months)) & (F.col("value") < F.col("threshold")))
    fired.append(
        ends.select(
            F.lit("arr_trend").alias("rule"),
            "value",
            "threshold",
            F.lit("ARR trending down over recent months.").alias("message"),
        )
    )
    return reduce(DataFrame.unionAll, fired)


def _candidate(rule: str, value: Column, limit: float, before: str, after: str) -> Column:
    number = value.cast("double")
    return F.struct(
        F.lit(rule).alias("rule"),
        number.alias("value"),
        F.lit(limit).alias("threshold"),
        F.concat(F.lit(before), plain_2dp(number), F.lit(after)).alias("message"),
    )


def melt_series(df: DataFrame, id_col: str, cols: Sequence[str]) -> DataFrame:
    """One row per point: (id, series, value)."""
    doubles = df.select(id_col, *(F.col(c).cast("double").alias(c) for c in cols))
    return doubles.unpivot([id_col], list(cols), "series", "value")
