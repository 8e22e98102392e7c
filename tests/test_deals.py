from datetime import date
from decimal import Decimal

import pytest

from revtide.operators import deals as d
from revtide.operators import semantic
from revtide.operators.filters import (
    Context,
    DimFilter,
    account_directory,
    account_opportunities,
    account_tickets,
    month_bounds,
)
from revtide.functions.periods import closes_in_months, month_of

OPPS = (
    "opp_id string, account_id string, product_id string, rep_id string, created_date date,"
    " close_date date, current_stage string, probability decimal(5,2), amount decimal(18,2),"
    " is_closed boolean, is_won boolean"
)
ACCOUNTS = (
    "account_id string, account_name string, segment string, region string, industry string,"
    " owner_rep_id string, website string"
)


def opp(i, account="a", rep="1", created=date(2024, 1, 10), close=None, stage="S",
        p="0.50", amount="100.00", closed=False, won=False):
    money = None if amount is None else Decimal(amount)
    return (str(i), account, "p", rep, created, close, stage, Decimal(p), money, closed, won)


ROWS = [
    opp(1),
    opp(2, amount=None, stage="T"),
    opp(3, "b", "2", stage="T", amount="40.00", p="0.25"),
    opp(4, close=date(2024, 1, 10), closed=True, won=True),
    opp(5, close=date(2024, 1, 31), closed=True, won=False, amount="50.00"),
    opp(6, close=date(2024, 2, 29), closed=True, won=None, amount="10.00"),
    opp(7, close=None, closed=True, won=True, amount="7.00"),
    opp(8, "b", "2", close=date(2024, 3, 1), closed=True, won=True, amount="30.00"),
    opp(9, "zz", "1", close=date(2024, 3, 1), closed=True, won=True, amount="1.00"),
]


@pytest.fixture
def pipe(frame):
    return lambda rows=ROWS: d.fct_pipeline(frame(OPPS, rows), date(2024, 2, 1))


@pytest.fixture
def ctx(frame, pipe):
    accounts = frame(
        ACCOUNTS,
        [("a", "A", "S1", "R1", "I", "1", "w"), ("b", None, None, "R1", "I", None, "w")],
    )
    reps = frame("rep_id string, team string, region string", [("1", "T1", "R1"), ("2", "T2", "R2")])
    mrr = frame("account_id string, month date, total_mrr decimal(28,2)", [])
    return Context(mrr, pipe(), accounts, reps)


def test_fct_pipeline(pipe):
    rows = {r.opp_id: r for r in pipe().collect()}
    assert rows["1"].weighted_pipeline == Decimal("50.0000")
    assert rows["1"].deal_age_days == 22 and rows["1"].sales_cycle_days is None
    assert rows["4"].sales_cycle_days == 0 and rows["4"].deal_age_days is None
    assert rows["7"].sales_cycle_days is None


def test_summary(pipe):
    row = d.pipeline_summary(pipe()).first()
    assert row.total_open_pipeline == Decimal("140.00")
    assert row.total_weighted_pipeline == Decimal("60.0000")
    assert row.win_rate_pct == 66.67  # 4 of 6, null is not won
    assert row.avg_sales_cycle_days == 34.6  # (0 + 21 + 50 + 51 + 51) / 5


def test_summary_without_closed_deals(pipe):
    row = d.pipeline_summary(pipe(ROWS[:2])).first()
    assert row.win_rate_pct is None and row.avg_sales_cycle_days is None


def test_monthly_keeps_deals_without_close_date(pipe):
    rows = {r.close_month: r for r in d.pipeline_monthly(pipe()).collect()}
    assert set(rows) == {date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1), None}
    assert rows[None].total_closed_revenue == Decimal("7.00")
    assert rows[None].avg_sales_cycle_days is None
    january = rows[date(2024, 1, 1)]
    assert (january.total_closed_revenue, january.total_won_revenue) == (150, 100)
    assert (january.win_rate_pct, january.avg_sales_cycle_days) == (50.0, 10.5)
    assert rows[date(2024, 2, 1)].total_won_revenue == 0


def test_created_monthly(frame):
    row = d.pipeline_created_monthly(frame(OPPS, ROWS[:3])).first()
    assert tuple(row) == (date(2024, 1, 1), 3, Decimal("140.00"), 70.0)


def test_coverage_of_the_newest_month(pipe):
    p = pipe()
    row = d.pipeline_coverage(p, d.pipeline_monthly(p)).first()
    assert tuple(row) == (Decimal("140.00"), Decimal("31.00"), 4.52)


def test_coverage_without_closed_month_has_no_row(pipe):
    p = pipe(ROWS[:3] + [ROWS[6]])
    assert d.pipeline_coverage(p, d.pipeline_monthly(p)).count() == 0


def test_coverage_with_zero_revenue(pipe):
    p = pipe([ROWS[0], opp(2, close=date(2024, 1, 31), closed=True, amount="0.00")])
    assert d.pipeline_coverage(p, d.pipeline_monthly(p)).first().pipeline_coverage_ratio is None


def test_closed_revenue_drops_unknown_accounts_and_null_dates(ctx):
    rows = {r.close_month.month: r
            for r in d.closed_revenue_monthly(ctx, date(2024, 1, 1), date(2024, 12, 1)).collect()}
    assert set(rows) == {1, 2, 3}
    assert rows[3].total_closed_revenue == Decimal("30.00")
    assert rows[1].avg_sales_cycle_days == 10.5


def test_closed_revenue_by_the_deals_own_rep(ctx):
    got = d.closed_revenue_monthly(
        ctx, date(2024, 1, 1), date(2024, 12, 1), DimFilter(rep_teams=("T2",))
    )
    assert [r.close_month.month for r in got.collect()] == [3]


def test_coverage_3m(ctx):
    row = d.coverage_3m(ctx, date(2024, 1, 1), date(2024, 12, 1)).first()
    assert row.total_open_pipeline == Decimal("140.00")
    assert row.avg_3m_closed_revenue == pytest.approx(190 / 3)
    assert row.pipeline_coverage_ratio == 2.21


def test_coverage_3m_uses_three_months_only(frame, ctx):
    rows = [opp(1)] + [
        opp(10 + m, close=date(2024, m, 5), closed=True, amount=f"{m}.00") for m in range(1, 6)
    ]
    more = Context(ctx.mrr, d.fct_pipeline(frame(OPPS, rows), date(2024, 6, 1)), ctx.accounts)
    row = d.coverage_3m(more, date(2024, 1, 1), date(2024, 12, 1)).first()
    assert (row.avg_3m_closed_revenue, row.pipeline_coverage_ratio) == (4.0, 25.0)


def test_coverage_3m_without_closed_month(ctx):
    row = d.coverage_3m(ctx, date(2030, 1, 1), date(2030, 12, 1)).first()
    assert row.total_open_pipeline == Decimal("140.00")
    assert row.avg_3m_closed_revenue is None and row.pipeline_coverage_ratio is None


def test_open_by_stage(ctx):
    rows = [tuple(r) for r in d.open_pipeline_by_stage(ctx).collect()]
    assert rows == [
        ("S", Decimal("100.00"), Decimal("50.00"), 1),
        ("T", Decimal("40.00"), Decimal("10.00"), 2),
    ]


def test_null_dimension_passes_only_without_selection(ctx):
    deals = ctx.pipeline.where("not is_closed")
    kept = DimFilter(segments=("S1",)).apply(deals, ctx.accounts, ctx.reps, "rep_id")
    assert {r.opp_id for r in kept.collect()} == {"1", "2"}
    everything = DimFilter().apply(deals, ctx.accounts, ctx.reps, "rep_id")
    assert everything.count() == 3 and everything.columns == deals.columns
    with pytest.raises(ValueError):
        DimFilter().apply(deals, ctx.accounts, ctx.reps, "someone")


def test_owner_and_own_rep_differ(ctx):
    deals = ctx.pipeline.where("not is_closed")
    team = DimFilter(rep_teams=("T2",))
    assert team.apply(deals, ctx.accounts, ctx.reps, "rep_id").count() == 1
    assert team.apply(deals, ctx.accounts, ctx.reps, "owner_rep_id").count() == 0


@pytest.mark.parametrize("start", [date(2024, 1, 1), date(2024, 1, 15), date(2023, 12, 31)])
@pytest.mark.parametrize("end", [date(2024, 2, 1), date(2024, 2, 20), date(2024, 12, 31)])
def test_raw_date_range_equals_month_range(spark, frame, start, end):
    from pyspark.sql import functions as F

    days = spark.range(600).select(F.date_add(F.lit(date(2023, 10, 1)), F.col("id").cast("int")).alias("x"))
    month = month_of(F.col("x"))
    by_month = days.where((month >= F.lit(start)) & (month <= F.lit(end)))
    by_day = days.where(closes_in_months(F.col("x"), start, end))
    assert by_day.exceptAll(by_month).count() == by_month.exceptAll(by_day).count() == 0


def test_account_lists(frame, ctx):
    opps = account_opportunities(ctx.pipeline, "a", n=2).collect()
    assert [r.opp_id for r in opps] == ["1", "2"]
    tickets = frame(
        "ticket_id string, account_id string, created_date date, status string, priority string,"
        " category string, subject string",
        [(str(i), "a", date(2024, 1, i), "o", "p", "c", "s") for i in range(1, 6)]
        + [("9", "a", None, "o", "p", "c", "s"), ("x", "b", date(2025, 1, 1), "o", "p", "c", "s")],
    )
    assert [r.ticket_id for r in account_tickets(tickets, "a", 3).collect()] == ["9", "5", "4"]
    labels = {r.label for r in account_directory(ctx.accounts).collect()}
    assert labels == {"A (a)", " (b)"}


def test_month_bounds_fall_back(ctx):
    row = month_bounds(ctx.mrr, date(2024, 6, 1)).first()
    assert tuple(row) == (date(2023, 1, 1), date(2024, 6, 1))


def test_governed_view(frame, pipe):
    arr = frame("month date, total_arr int", [(date(2024, k, 1), k) for k in (1, 2)])
    nrr = frame("month date, nrr_pct double", [(date(2024, 2, 1), 90.0)])
    grr = frame("month date, grr_pct double", [(date(2024, 2, 1), 80.0)])
    p = pipe()
    monthly = d.pipeline_monthly(p)
    view = semantic.gtm_metrics(arr, nrr, grr, monthly, d.pipeline_coverage(p, monthly)).collect()
    assert [r.month.month for r in view] == [1, 2]  # March has sales but no revenue month
    assert (view[0].nrr_pct, view[1].nrr_pct) == (None, 90.0)
    assert {r.pipeline_coverage_ratio for r in view} == {4.52}
    none = d.pipeline_coverage(p, monthly.where("false"))
    assert semantic.gtm_metrics(arr, nrr, grr, monthly, none).count() == 0


def test_view_from_facts_equals_view_from_marts(spark, small):
    from revtide.plans import queries as q

    marts = q._marts(spark, small)
    from_marts = semantic.gtm_metrics(
        marts.metrics_arr_monthly,
        marts.metrics_nrr_monthly,
        marts.metrics_grr_monthly,
        marts.metrics_pipeline_monthly,
        marts.metrics_pipeline_coverage,
    )
    assert from_marts.collect() == marts.v_gtm_metrics.collect()


def test_account_lists_are_whole_by_default(spark):
    from revtide.operators.filters import account_opportunities, account_tickets

    deals = spark.range(201).selectExpr(
        "cast(id as string) as opp_id", "'a' as account_id", "date'2024-01-01' as created_date", "null as close_date",
        "'s' as current_stage", "0.5 as probability", "1 as amount", "false as is_closed", "false as is_won",
    )
    assert account_opportunities(deals, "a").count() == 201
    assert account_opportunities(deals, "a", n=200).count() == 200
    tickets = spark.range(201).selectExpr(
        "cast(id as string) as ticket_id", "'a' as account_id", "date'2024-01-01' as created_date", "'o' as status",
        "'p' as priority", "'c' as category", "'s' as subject",
    )
    assert account_tickets(tickets, "a").count() == 201
