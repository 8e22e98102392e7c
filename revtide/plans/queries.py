"""The registered queries: every operator over a folder of star-schema tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revtide.functions import display
from revtide.functions.periods import months_after
from revtide.operators import (
    deals,
    evidence,
    filters,
    health,
    kpi,
    mrr,
    quality,
    responses,
    retention,
    stages,
)
from revtide.operators.filters import Context, DimFilter, MonthRange, loaded_range
from revtide.plans.marts import Marts
from revtide.schemas import LOADED_TABLES
from revtide.session import stored
from revtide.sources.csv_files import row_counts
from revtide.sources.star_schema import RawTables, order_months

#: Stands for today: ages of open deals are counted up to it.
AS_OF = date(2001, 9, 1)
ACCOUNT_ID = "7"
TARGET_X = 3.0
# Rows of the lists that show a few only.
ACCOUNT_ROWS, AT_RISK_ROWS = 200, 50
OWNER_FILTER = DimFilter(
    segments=("BUILDING", "MACHINERY", "AUTOMOBILE"),
    regions=("ASIA", "EUROPE", "AMERICA"),
    rep_regions=("AFRICA", "AMERICA", "ASIA"),
)
INDUSTRIES = tuple(f"NATION_{k}" for k in range(16))
TEAMS = tuple(f"NATION_{k}" for k in range(5, 20))
#: Industry and team, which the other filters leave open.
TEAM_FILTER = DimFilter(industries=INDUSTRIES, rep_teams=TEAMS)
#: Limits that every rule of the alerts crosses on the given tables.
TIGHT = kpi.Thresholds(nrr_below=1000.0, grr_below=1000.0, coverage_below=1e9)
REP_FILTER = DimFilter(
    segments=("BUILDING", "HOUSEHOLD"),
    rep_regions=("AMERICA", "ASIA", "MIDDLE EAST"),
)

Query = Callable[[SparkSession, str], DataFrame]


def _marts(spark: SparkSession, folder: str) -> Marts:
    return Marts(RawTables(spark, folder), AS_OF)


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparison with engines that return no decimals."""
    return df.select(
        *(
            F.col(f.name).cast("double").alias(f.name)
            if f.dataType.typeName() == "decimal"
            else F.col(f.name)
            for f in df.schema.fields
        )
    )


def _on_marts(build: Callable[[Marts], DataFrame]) -> Query:
    return lambda spark, folder: _plain(build(_marts(spark, folder)))


def _on_context(build: Callable[[Context], DataFrame]) -> Query:
    return lambda spark, folder: _plain(build(_marts(spark, folder).context()))


def _in_months(build: Callable[[Context, MonthRange], DataFrame]) -> Query:
    """A metric over all loaded months, which are read before its plan is made."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        marts = _marts(spark, folder)
        return _plain(build(marts.context(), _loaded(marts)))

    return query


def _loaded(marts: Marts) -> MonthRange:
    return loaded_range(order_months(marts.raw.source), AS_OF)


def _alerts(ctx: Context, m: MonthRange, thresholds: kpi.Thresholds = kpi.Thresholds()) -> DataFrame:
    kpis = kpi.kpi_retention(retention.retention_trend(ctx, m.start, m.end))
    coverage = deals.coverage_3m(ctx, m.start, m.end)
    return kpi.alerts(kpis, coverage, mrr.arr_trend(ctx, m.start, m.boundary), thresholds)


def _coverage_classes(ctx: Context) -> DataFrame:
    """Open value of each stage as a multiple of its expected value, classified."""
    by_stage = deals.open_pipeline_by_stage(ctx)
    multiple = F.round(
        F.col("open_pipeline").cast("double") / F.col("weighted_pipeline").cast("double") * 2, 4
    )
    return by_stage.select(
        "current_stage",
        multiple.alias("ratio"),
        display.coverage_assessment(multiple, TARGET_X).alias("assessment"),
    )


def _retention_texts(ctx: Context, m: MonthRange) -> DataFrame:
    series = retention.retention_trend(ctx, m.start, m.boundary)
    shown = {
        name: display.retention_display(F.col(f"{name}_pct"), F.col("start_mrr"))
        for name in ("nrr", "grr")
    }
    return series.select("month", *(text.alias(f"{name}_text") for name, text in shown.items()))


def _formats(marts: Marts) -> DataFrame:
    """Display texts of every opportunity's amounts, scaled to reach every suffix."""
    size = F.col("amount").cast("double")
    scale = F.element_at(
        F.array(*map(F.lit, (1e-4, 1e-2, -1.0, 1.0, 1e2, -1e5))),
        (F.col("opp_id").cast("int") % 6 + 1),
    )
    value = size * scale
    return marts.fct_pipeline.select(
        "opp_id",
        display.fmt_currency(value).alias("currency"),
        display.fmt_number(value).alias("number"),
        display.fmt_pct(F.col("probability") * 100).alias("pct"),
        display.fmt_x(F.col("sales_cycle_days") / F.lit(8)).alias("multiple"),
    )


def _replies(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns dressed as stored replies with headings and lists."""
    turns = RawTables(spark, folder).source("conversations")
    text = F.col("text")
    full = F.concat(
        F.lit('"### Headline:\\n'),
        text,
        F.lit("\n executive summary :\n"),
        text,
        F.lit("\n\nKey Risks:\n1. "),
        text,
        F.lit("\n  2.second risk\nno number\\n3.   third risk \nRecommended Actions:\n10. "),
        text,
        F.lit('"'),
    )
    partial = F.concat(F.lit("intro\nKey Risks:\n1. first\nkey risks:\n## 1. "), text)
    reply = (
        F.when(F.col("turn") % 4 == 0, text)
        .when(F.col("turn") % 4 == 1, full)
        .when(F.col("turn") % 4 == 2, partial)
        .otherwise(F.concat(F.lit("'"), text, F.lit("'")))
    )
    return turns.select("conv_id", "turn", reply.alias("reply"))


def _response_sections(spark: SparkSession, folder: str) -> DataFrame:
    return responses.response_sections(_replies(spark, folder), ["conv_id", "turn"], "reply")


def _load_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    raw = RawTables(spark, folder)
    return row_counts({name: raw[name] for name in LOADED_TABLES})


def _filtered_open_pipeline(ctx: Context) -> DataFrame:
    open_deals = ctx.pipeline.where(~F.col("is_closed"))
    return REP_FILTER.apply(open_deals, ctx.accounts, ctx.reps, "rep_id").select(
        "opp_id", "account_id", "rep_id", "current_stage", "amount", "weighted_pipeline"
    )


def _evidence_pack(spark: SparkSession, folder: str) -> DataFrame:
    marts = _marts(spark, folder)
    m = _loaded(marts)
    return evidence.evidence_pack(marts.context(), m.start, m.end, target_x=TARGET_X)


def _tail_records(ctx: Context, m: MonthRange) -> DataFrame:
    """The last twelve months of revenue as records, one row each."""
    series = mrr.arr_trend(ctx, m.start, m.end)
    records = evidence.tail_records(series, evidence.SERIES_ROWS, "month", ["month", "total_arr"])
    return records.select(F.posexplode("records").alias("place", "r")).select(
        "place", F.col("r.MONTH").alias("month"), F.col("r.TOTAL_ARR").alias("total_arr")
    )


def _health_snapshot(marts: Marts) -> DataFrame:
    """The health mart, stored as the snapshot of the last month; it has rows, so it is shown."""
    ctx, m = marts.context(), _loaded(marts)
    snapshot = marts.fct_account_health.withColumn("month", F.lit(m.end))
    stored_health = stored(snapshot.select(*health.SNAPSHOT_COLUMNS))
    kept = Context(ctx.mrr, ctx.pipeline, ctx.accounts, ctx.reps, tickets=ctx.tickets, health=stored_health)
    return health.health_snapshot(kept, m.start, m.end)


def _latest_snapshot(marts: Marts) -> DataFrame:
    m = _loaded(marts)
    return health.latest_snapshot(marts.fct_mrr, m.start, m.end)


# The evidence document's fields, numbers and texts; [*] stands for 12, 8
# or 5 places of a list.
EVIDENCE_NUMBERS = (
    "benchmarks.pipeline_coverage_target_x",
    "metrics.arr_latest",
    "metrics.arr_delta_mom",
    "metrics.nrr_pct",
    "metrics.grr_pct",
    "metrics.win_rate_pct",
    "metrics.win_rate_delta_mom",
    "metrics.pipeline_coverage_ratio_x",
    "metrics.total_open_pipeline",
    "metrics.avg_3m_closed_revenue",
    "data_quality.cohort_accounts",
    "data_quality.next_month_accounts",
    "data_quality.next_month_coverage_pct",
    "data_quality.coverage_threshold_pct",
)
EVIDENCE_TEXTS = (
    "time_window",
    "filters.start_date",
    "filters.end_date",
    "filters.retention_cohort_month",
    "metrics.pipeline_coverage_assessment",
    "data_quality.retention_interpretable",
    "data_quality.retention_note",
    "rules.grounding_rule",
    "rules.retention_rule",
    "rules.pipeline_rule",
)
EVIDENCE_LISTS = {
    "series.arr_trend_last_12": (12, ("TOTAL_ARR",), "MONTH"),
    "series.retention_last_12": (12, ("START_MRR", "END_MRR", "NRR_PCT", "GRR_PCT"), "MONTH"),
    "series.closed_rev_last_12": (
        12,
        ("TOTAL_CLOSED_REVENUE", "WIN_RATE_PCT", "AVG_SALES_CYCLE_DAYS"),
        "CLOSE_MONTH",
    ),
    "pipeline.coverage_row": (
        1,
        ("TOTAL_OPEN_PIPELINE", "AVG_3M_CLOSED_REVENUE", "PIPELINE_COVERAGE_RATIO"),
        None,
    ),
    "pipeline.open_by_stage_top_8": (8, ("OPEN_PIPELINE",), "CURRENT_STAGE"),
    "mrr_movement.movement_summary": (5, ("ROWS_COUNT", "NET_MRR_CHANGE"), "MOVEMENT_TYPE"),
    "mrr_movement.top_expansions": (5, ("MRR_CURR", "MRR_PREV", "MRR_DELTA"), "ACCOUNT_ID"),
    "mrr_movement.top_contractions": (5, ("MRR_CURR", "MRR_PREV", "MRR_DELTA"), "ACCOUNT_ID"),
}


def _evidence_fields(spark: SparkSession, folder: str) -> DataFrame:
    """(field, value, text): the evidence document read back leaf by leaf, without nulls."""
    numbers, texts = list(EVIDENCE_NUMBERS), list(EVIDENCE_TEXTS)
    for path, (n, figures, name) in EVIDENCE_LISTS.items():
        for k in range(n):
            numbers += [f"{path}[{k}].{x}" for x in figures]
            texts += [f"{path}[{k}].{name}"] if name else []
    leaf = F.expr("get_json_object(pack_json, concat('$.', field))")
    number = F.col("is_number")
    fields = F.array(
        *(F.struct(F.lit(x).alias("field"), F.lit(True).alias("is_number")) for x in numbers),
        *(F.struct(F.lit(x).alias("field"), F.lit(False).alias("is_number")) for x in texts),
    )
    return (
        _evidence_pack(spark, folder)
        .select("pack_json", F.inline(fields))
        .select("field", F.when(number, leaf.cast("double")).alias("value"), F.when(~number, leaf).alias("text"))
        .where("value is not null or text is not null")
    )


QUERIES: dict[str, Query] = {
    # Sources.
    "load_row_counts": _load_row_counts,
    # Filters and lookups.
    "filtered_arr_trend": _in_months(lambda c, m: mrr.arr_trend(c, m.start, m.end, OWNER_FILTER)),
    "filtered_by_industry_and_team": _in_months(lambda c, m: mrr.arr_trend(c, m.start, m.end, TEAM_FILTER)),
    "filtered_open_pipeline": _on_context(_filtered_open_pipeline),
    "filter_domains": _on_context(lambda c: filters.filter_domains(c.accounts, c.reps)),
    "mrr_month_bounds": _on_context(lambda c: filters.month_bounds(c.mrr, AS_OF)),
    "account_directory": _on_context(lambda c: filters.account_directory(c.accounts)),
    "account_mrr_series": _in_months(lambda c, m: filters.account_mrr(c, m.start, m.end)),
    "account_mrr_one_account": _in_months(
        lambda c, m: filters.account_mrr(c, m.start, m.end, account_id=ACCOUNT_ID)
    ),
    "account_opportunities": _on_context(
        lambda c: filters.account_opportunities(c.pipeline, ACCOUNT_ID, n=ACCOUNT_ROWS)
    ),
    "account_tickets": _on_context(
        lambda c: filters.account_tickets(c.tickets, ACCOUNT_ID, n=ACCOUNT_ROWS)
    ),
    # Revenue marts.
    "fct_mrr": _on_marts(lambda m: m.fct_mrr),
    "fct_mrr_enriched": _on_marts(lambda m: m.fct_mrr_enriched),
    "fct_mrr_complete": _on_marts(lambda m: m.fct_mrr_complete),
    "metrics_nrr_monthly": _on_marts(lambda m: m.metrics_nrr_monthly),
    "fct_arr": _on_marts(lambda m: m.fct_arr),
    "metrics_arr_monthly": _on_marts(lambda m: m.metrics_arr_monthly),
    "metrics_grr_monthly": _on_marts(lambda m: m.metrics_grr_monthly),
    # Pipeline and stage marts.
    "fct_pipeline": _on_marts(lambda m: m.fct_pipeline),
    "metrics_pipeline_summary": _on_marts(lambda m: m.metrics_pipeline_summary),
    "metrics_pipeline_monthly": _on_marts(lambda m: m.metrics_pipeline_monthly),
    "metrics_pipeline_created_monthly": _on_marts(lambda m: m.metrics_pipeline_created_monthly),
    "metrics_pipeline_coverage": _on_marts(lambda m: m.metrics_pipeline_coverage),
    "fct_stage_velocity": _on_marts(lambda m: m.fct_stage_velocity),
    "metrics_stage_conversion": _on_marts(lambda m: m.metrics_stage_conversion),
    # Health and semantic marts.
    "fct_account_health": _on_marts(lambda m: m.fct_account_health),
    "v_gtm_metrics": _on_marts(lambda m: m.v_gtm_metrics),
    # Filterable metrics.
    "app_arr_trend": _in_months(lambda c, m: mrr.arr_trend(c, m.start, m.end)),
    "app_retention_trend": _in_months(lambda c, m: retention.retention_trend(c, m.start, m.end)),
    "app_retention_trend_boundary": _in_months(
        lambda c, m: retention.retention_trend(c, m.start, m.boundary)
    ),
    "app_retention_trend_filtered": _in_months(
        lambda c, m: retention.retention_trend(c, m.start, m.end, OWNER_FILTER)
    ),
    "app_closed_revenue_monthly": _in_months(
        lambda c, m: deals.closed_revenue_monthly(c, m.start, m.end)
    ),
    "app_closed_revenue_monthly_filtered": _in_months(
        lambda c, m: deals.closed_revenue_monthly(c, date(1996, 3, 15), m.end, REP_FILTER)
    ),
    "app_pipeline_coverage": _in_months(lambda c, m: deals.coverage_3m(c, m.start, m.end)),
    "app_pipeline_coverage_filtered": _in_months(
        lambda c, m: deals.coverage_3m(c, m.start, m.end, REP_FILTER)
    ),
    "app_open_pipeline_by_stage": _on_context(lambda c: deals.open_pipeline_by_stage(c)),
    "app_open_pipeline_by_stage_filtered": _on_context(
        lambda c: deals.open_pipeline_by_stage(c, REP_FILTER)
    ),
    "app_mrr_movement_summary": _in_months(lambda c, m: mrr.movement_summary(c, m.start, m.end)),
    "app_mrr_movement_summary_filtered": _in_months(
        lambda c, m: mrr.movement_summary(c, date(1999, 1, 1), m.end, OWNER_FILTER)
    ),
    "app_top_expansions": _in_months(lambda c, m: mrr.top_movers(c, m.start, m.end)[0]),
    "app_top_contractions": _in_months(lambda c, m: mrr.top_movers(c, m.start, m.end)[1]),
    "latest_snapshot": _on_marts(_latest_snapshot),
    "app_computed_health": _in_months(lambda c, m: health.computed_health(c, m.start, m.end)),
    "app_computed_health_boundary": _in_months(
        lambda c, m: health.computed_health(c, m.start, m.boundary)
    ),
    "app_stage_duration": _on_context(lambda c: stages.stage_duration(c)),
    "app_stage_duration_filtered": _on_context(lambda c: stages.stage_duration(c, OWNER_FILTER)),
    "app_stage_transitions": _on_context(lambda c: stages.stage_transitions(c)),
    "app_stage_transitions_filtered": _on_context(
        lambda c: stages.stage_transitions(c, OWNER_FILTER)
    ),
    # Headline figures, gates and evidence.
    "kpi_arr": _in_months(lambda c, m: kpi.kpi_arr(mrr.arr_trend(c, m.start, m.boundary))),
    "kpi_retention": _in_months(
        lambda c, m: kpi.kpi_retention(retention.retention_trend(c, m.start, m.end))
    ),
    "kpi_win_rate": _in_months(
        lambda c, m: kpi.kpi_win_rate(deals.closed_revenue_monthly(c, m.start, m.end))
    ),
    "kpi_alerts": _in_months(_alerts),
    "kpi_alerts_tight": _in_months(lambda c, m: _alerts(c, m, TIGHT)),
    "tail_records": _in_months(_tail_records),
    "coverage_assessment": _on_context(_coverage_classes),
    "retention_display": _in_months(_retention_texts),
    "health_distribution": _in_months(
        lambda c, m: health.health_distribution(health.computed_health(c, m.start, m.end))
    ),
    "health_snapshot": _on_marts(_health_snapshot),
    "at_risk_accounts": _in_months(
        lambda c, m: health.at_risk(health.computed_health(c, m.start, m.end), n=AT_RISK_ROWS)
    ),
    "retention_quality": _in_months(
        lambda c, m: retention.retention_quality(c, m.start, m.end, filters.EVERYTHING, months_after(m.end, -1))
    ),
    "retention_quality_strict": _in_months(
        lambda c, m: retention.retention_quality(
            c, m.start, m.boundary, filters.EVERYTHING, m.end, strict=True
        )
    ),
    "quality_checks": _on_context(quality.quality_checks),
    "display_formats": _on_marts(_formats),
    "evidence_pack": _evidence_fields,
    "retention_series_long": _in_months(
        lambda c, m: kpi.melt_series(
            retention.retention_trend(c, m.start, m.end), "month", ["nrr_pct", "grr_pct"]
        )
    ),
    "response_sections": _response_sections,
}
