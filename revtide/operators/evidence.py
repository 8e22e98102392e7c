"""One JSON document that gathers the metrics of a month range."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtide.functions.display import coverage_assessment
from revtide.functions.movement import movement_class
from revtide.functions.numbers import count_if, percent, zero_if_null
from revtide.operators.deals import closed_revenue_monthly, coverage_3m, open_pipeline_by_stage
from revtide.operators.filters import EVERYTHING, Context, DimFilter, scoped_mrr
from revtide.operators.mrr import CONTRACTION, EXPANSION, MONTHS_PER_YEAR, movers
from revtide.operators.retention import quality_of

# How many rows of each kind the document holds.
SERIES_ROWS = 12
STAGE_ROWS = 8
MOVER_ROWS = 5
#: Fields of the movers' records.
MOVER_COLUMNS = (
    "account_id",
    "mrr_curr",
    "mrr_prev",
    "mrr_delta",
    "account_name",
    "segment",
    "region",
    "industry",
)

# Rules stated for the readers of the document.
GROUNDING_RULE = "Use ONLY fields in this JSON. If missing/null, say data not available."
RETENTION_RULE = (
    "If data_quality.retention_interpretable is false, DO NOT interpret NRR/GRR as churn. "
    "Say retention is not fully loaded/complete for the selected period."
)
PIPELINE_RULE = (
    "Pipeline coverage is an X multiple. Compare vs benchmarks.pipeline_coverage_target_x. "
    "If assessment is 'very high', advise validating denominator/baseline."
)


def _field(df: DataFrame, name: str) -> Column:
    """A record field: upper-case name, dates as ISO text."""
    col = F.col(name)
    if df.schema[name].dataType.typeName() == "date":
        col = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSS")
    return col.alias(name.upper())


def _records(df: DataFrame, order: Column, cols: Sequence[str]) -> DataFrame:
    """One row, one array of records in the given order. Callers bound the rows."""
    entry = F.struct(order.alias("order"), F.struct(*(_field(df, c) for c in cols)).alias("record"))
    return df.agg(F.array_sort(F.collect_list(entry)).alias("entries")).select(
        F.transform("entries", lambda e: e["record"]).alias("records")
    )


def tail_records(df: DataFrame, n: int, sort_col: str, cols: Sequence[str]) -> DataFrame:
    """The last ``n`` rows by ``sort_col`` as an array of records, oldest first."""
    newest = df.orderBy(F.col(sort_col).desc_nulls_last()).limit(n)
    return _records(newest, F.col(sort_col), cols)


def _row(df: DataFrame) -> Column:
    """A one-row frame as a struct, null when the frame is empty."""
    return df.select(F.struct(*df.columns)).scalar()


def _newest_first(df: DataFrame, time_col: str) -> Column:
    """A monthly series as one array, which has as many places as the calendar months."""
    entry = F.struct(time_col, *(c for c in df.columns if c != time_col))
    return df.agg(F.sort_array(F.collect_list(entry), asc=False)).scalar()


def _tail(series: Column, df_fields: Sequence[str]) -> Column:
    """The records of the newest months of such an array, oldest first."""
    time = F.date_format
    record = lambda e: F.struct(
        time(e[df_fields[0]], "yyyy-MM-dd'T'HH:mm:ss.SSS").alias(df_fields[0].upper()),
        *(e[c].alias(c.upper()) for c in df_fields[1:]),
    )
    return F.reverse(F.transform(F.slice(series, 1, SERIES_ROWS), record))


def _latest(series: Column, value: str, guard: str) -> tuple[Column, Column]:
    """Newest value, and its difference to the one before, among months with a positive guard."""
    passing = F.filter(series, lambda e: e[guard] > 0)
    now, before = (F.get(passing, F.lit(k))[value].cast("double") for k in (0, 1))
    return now, now - before


def _monthly(ctx: Context, start: date, end: date, filt: DimFilter) -> Column:
    """All that the document says by month, as one array from one pass over the revenue rows.

    Of each month: revenue, rows, what became of its cohort one month later, and its
    movements by class.
    """
    timeline = Window.partitionBy("account_id").orderBy("month")
    mrr = F.col("total_mrr")
    follows = F.lead("month").over(timeline) == F.add_months("month", 1)
    paired = scoped_mrr(ctx, start, end, filt, by_account=True).select(
        "month",
        "total_mrr",
        F.lag("total_mrr").over(timeline).alias("before"),
        F.when(follows, F.lead("total_mrr").over(timeline)).alias("after"),
    )
    in_cohort, after = mrr > 0, zero_if_null(F.col("after"))
    by_class = paired.groupBy(
        "month", movement_class(mrr, F.col("before"), "app").alias("movement_type")
    ).agg(
        F.count("*").alias("rows_count"),
        F.sum(mrr - zero_if_null(F.col("before"))).alias("change"),
        F.sum(mrr).alias("mrr"),
        count_if(in_cohort).alias("cohort"),
        F.sum(F.when(in_cohort, mrr)).alias("start"),
        F.sum(F.when(in_cohort, after)).alias("end"),
        F.sum(F.when(in_cohort, F.least(after, mrr))).alias("retained"),
    )
    by_month = by_class.groupBy("month").agg(
        *(F.sum(c).alias(c) for c in ("rows_count", "mrr", "cohort", "start", "end", "retained")),
        F.collect_list(F.struct("movement_type", "rows_count", "change")).alias("moves"),
    )
    return _newest_first(by_month, "month")


def _arr_series(months: Column) -> Column:
    """As ``arr_trend``."""
    return F.transform(
        months, lambda e: F.struct(e["month"].alias("month"), F.round(e["mrr"] * MONTHS_PER_YEAR, 2).alias("total_arr"))
    )


def _retention_series(months: Column) -> Column:
    """As ``retention_trend``: without the newest month, which nothing follows."""
    followed = F.filter(F.slice(months, 2, F.greatest(F.size(months) - 1, F.lit(0))), lambda e: e["cohort"] > 0)
    return F.transform(
        followed,
        lambda e: F.struct(
            e["month"].alias("month"),
            *(F.round(e[c], 2).alias(f"{c}_mrr") for c in ("start", "end")),
            percent(e["end"], e["start"]).alias("nrr_pct"),
            percent(e["retained"], e["start"]).alias("grr_pct"),
        ),
    )


def _movement_rows(months: Column) -> Column:
    """As ``movement_summary``: one record a class, in order."""
    moves = F.flatten(F.transform(months, lambda e: e["moves"]))
    classes = F.array_sort(F.array_distinct(F.transform(moves, lambda m: m["movement_type"])))

    def total(kind: Column, name: str, zero: Column) -> Column:
        return F.aggregate(F.filter(moves, lambda m: m["movement_type"] == kind), zero, lambda a, m: (a + m[name]).cast(_SUM if name == "change" else "bigint"))

    return F.transform(
        classes,
        lambda kind: F.struct(
            kind.alias("MOVEMENT_TYPE"),
            total(kind, "rows_count", F.lit(0).cast("bigint")).alias("ROWS_COUNT"),
            F.round(total(kind, "change", F.lit(0).cast(_SUM)), 2).alias("NET_MRR_CHANGE"),
        ),
    )


#: Sums of money over all rows.
_SUM = "decimal(38,2)"


def _list_of(movers_: Column, direction: str) -> Column:
    return F.transform(
        F.filter(movers_, lambda e: e["direction"] == direction),
        lambda e: F.struct(*(e[c].alias(c.upper()) for c in MOVER_COLUMNS)),
    )


def evidence_pack(
    ctx: Context,
    start: date,
    end: date,
    filt: DimFilter = EVERYTHING,
    cohort_month: date | None = None,
    target_x: float = 3.0,
) -> DataFrame:
    """One row ``pack_json``; nothing runs before it is asked for.

    Each source is summed up once, to one array of at most a place a month, and the
    document is put together from these arrays: revenue by month and class, closed deals by month,
    open deals by stage, coverage, and the movers of both lists. Without a cohort month the newest
    retention month with revenue is used.
    """
    stages = open_pipeline_by_stage(ctx, filt)
    value = F.col("open_pipeline")
    largest = stages.orderBy(value.desc_nulls_last(), "current_stage").limit(STAGE_ROWS)
    winners = movers(ctx, start, end, filt, n=MOVER_ROWS)
    listed = F.array_sort(F.collect_list(F.struct("direction", "place", *MOVER_COLUMNS)))
    sources = {
        "months": _monthly(ctx, start, end, filt),
        "closed": _newest_first(closed_revenue_monthly(ctx, start, end, filt), "close_month"),
        "coverage": _row(coverage_3m(ctx, start, end, filt)),
        "stages": _records(largest, F.struct(value.isNull(), -value, "current_stage"), stages.columns).scalar(),
        "movers": winners.agg(listed).scalar(),
    }
    row = ctx.mrr.sparkSession.range(1).select(*(c.alias(n) for n, c in sources.items()))
    row = row.withColumns({"arr": _arr_series(F.col("months")), "retention": _retention_series(F.col("months"))})
    if cohort_month is None:
        cohort = F.get(F.filter("retention", lambda e: e["start_mrr"] > 0), F.lit(0))["month"]
    else:
        cohort = F.lit(cohort_month).cast("date")
    row = row.withColumn("cohort_month", cohort)
    row = row.withColumns(
        {
            "at_cohort": F.get(F.filter("months", lambda e: e["month"] == F.col("cohort_month")), F.lit(0)),
            "following": F.get(F.filter("months", lambda e: e["month"] == F.add_months("cohort_month", 1)), F.lit(0)),
        }
    )
    # The fact has one row an account and month, so rows are accounts.
    counted = row.withColumns(
        {
            "cohort_accounts": F.coalesce(F.col("at_cohort.cohort"), F.lit(0).cast("bigint")),
            "next_accounts": F.coalesce(F.col("following.rows_count"), F.lit(0).cast("bigint")),
        }
    )
    return counted.select(
        F.to_json(_document(start, end, target_x), {"ignoreNullFields": "false"}).alias("pack_json")
    )


def _document(start: date, end: date, target_x: float) -> Column:
    ratio = F.col("coverage.pipeline_coverage_ratio")
    arr, retention, closed = (F.col(c) for c in ("arr", "retention", "closed"))
    arr_now, arr_delta = _latest(arr, "total_arr", "total_arr")
    win_now, win_delta = _latest(closed, "win_rate_pct", "total_closed_revenue")
    return _object(
        time_window=F.lit(f"{start} to {end}"),
        filters=_object(
            start_date=F.lit(str(start)),
            end_date=F.lit(str(end)),
            retention_cohort_month=F.col("cohort_month").cast("string"),
        ),
        benchmarks=_object(pipeline_coverage_target_x=F.lit(float(target_x))),
        metrics=_object(
            arr_latest=arr_now,
            arr_delta_mom=arr_delta,
            nrr_pct=_latest(retention, "nrr_pct", "start_mrr")[0],
            grr_pct=_latest(retention, "grr_pct", "start_mrr")[0],
            win_rate_pct=win_now,
            win_rate_delta_mom=win_delta,
            pipeline_coverage_ratio_x=ratio,
            pipeline_coverage_assessment=coverage_assessment(ratio, target_x),
            total_open_pipeline=F.col("coverage.total_open_pipeline").cast("double"),
            avg_3m_closed_revenue=F.col("coverage.avg_3m_closed_revenue"),
        ),
        data_quality=quality_of(F.col("cohort_month"), F.col("cohort_accounts"), F.col("next_accounts")),
        series=_object(
            arr_trend_last_12=_tail(arr, ["month", "total_arr"]),
            retention_last_12=_tail(retention, ["month", "start_mrr", "end_mrr", "nrr_pct", "grr_pct"]),
            closed_rev_last_12=_tail(
                closed, ["close_month", "total_closed_revenue", "win_rate_pct", "avg_sales_cycle_days"]
            ),
        ),
        pipeline=_object(
            coverage_row=_coverage_rows(), open_by_stage_top_8=F.col("stages")
        ),
        mrr_movement=_object(
            movement_summary=_movement_rows(F.col("months")),
            top_expansions=_list_of(F.col("movers"), EXPANSION),
            top_contractions=_list_of(F.col("movers"), CONTRACTION),
        ),
        rules=_object(
            grounding_rule=F.lit(GROUNDING_RULE),
            retention_rule=F.lit(RETENTION_RULE),
            pipeline_rule=F.lit(PIPELINE_RULE),
        ),
    )


def _coverage_rows() -> Column:
    """The coverage row as a list of one record, empty where there is none."""
    names = ("total_open_pipeline", "avg_3m_closed_revenue", "pipeline_coverage_ratio")
    record = F.struct(*(F.col(f"coverage.{c}").alias(c.upper()) for c in names))
    return F.filter(F.array(record), lambda e: F.col("coverage").isNotNull())


def _object(**fields: Column) -> Column:
    return F.struct(*(col.alias(name) for name, col in fields.items()))
