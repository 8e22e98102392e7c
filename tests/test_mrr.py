import random
from datetime import date
from decimal import Decimal

import pytest

from revtide.operators import mrr as m
from revtide.operators import retention as ret
from revtide.operators.filters import Context, DimFilter

MRR = "account_id string, month date, total_mrr decimal(28,2)"
CALENDAR = [date(2024, k, 1) for k in range(1, 9)]


def month(k):
    return date(2024, k, 1)


def money(x):
    return None if x is None else Decimal(x).quantize(Decimal("0.01"))


@pytest.fixture
def calendar(frame):
    def build(months=CALENDAR):
        return frame("date date, month_start date", [(d, d) for d in months for _ in range(2)])

    return build


@pytest.fixture
def known(frame):
    return lambda ids: frame("account_id string", [(i,) for i in ids])


def expected_class(now, before):
    if before == 0 and now > 0:
        return "New"
    if before > 0 and now == 0:
        return "Churn"
    if now > before:
        return "Expansion"
    if now < before and now > 0:
        return "Contraction"
    return "Flat"


def brute_dense(revenue, accounts, months):
    out = {}
    for account in set(accounts):
        before = Decimal(0)
        for d in sorted(months):
            now = revenue.get((account, d)) or Decimal(0)
            out[account, d] = (now, before, now - before, expected_class(now, before))
            before = now
    return out


@pytest.mark.parametrize("seed", range(4))
def test_dense_grid_against_brute_force(frame, calendar, known, seed):
    rng = random.Random(seed)
    months = CALENDAR if seed % 2 else [d for d in CALENDAR if d.month not in (3, 6)]
    ids = [f"a{i}" for i in range(12)]
    revenue = {}
    for account in ids[:10] + ["unknown"]:
        for d in CALENDAR + [date(2025, 1, 1)]:
            if rng.random() < 0.6:
                revenue[account, d] = rng.choice([None, money(0), money(-5), money(10), money(12)])
    mrr = frame(MRR, [(a, d, v) for (a, d), v in revenue.items()])
    got = m.fct_mrr_complete(mrr, known(ids + ids[:3]), calendar(months))
    rows = {(r.account_id, r.month): tuple(r)[2:] for r in got.collect()}
    assert rows == brute_dense(revenue, ids, months)
    assert got.count() == len(ids) * len(months)
    assert got.schema["total_mrr"].dataType.simpleString() == "decimal(28,2)"


def test_fct_mrr_sums_and_keeps_null(frame):
    sub = frame(
        "subscription_id string, account_id string, month date, mrr decimal(18,2)",
        [("1", "a", month(1), money(1)), ("2", "a", month(1), money(2)), ("3", "b", month(1), None)],
    )
    assert {tuple(r) for r in m.fct_mrr(sub).collect()} == {
        ("a", month(1), money(3)),
        ("b", month(1), None),
    }


def test_movement_over_existing_rows(frame):
    rows = [
        ("a", month(1), money(5)),
        ("a", month(3), money(5)),
        ("a", month(4), money(9)),
        ("a", month(5), money(2)),
        ("a", month(6), money(0)),
        ("a", month(7), money(4)),
        ("a", month(8), money(-1)),
        ("b", month(1), None),
        ("b", month(2), money(3)),
    ]
    mrr = frame(MRR, rows)
    mart = {(r.account_id, r.month.month): r.movement_type for r in m.mrr_movement(mrr).collect()}
    assert [mart["a", k] for k in (1, 3, 4, 5, 6, 7, 8)] == [
        "New", "Flat", "Expansion", "Contraction", "Churn", "New", "Flat",
    ]
    assert mart["b", 1] == "Flat" and mart["b", 2] == "New"
    app = {(r.account_id, r.month.month): r.movement_type for r in m.mrr_movement(mrr, "app").collect()}
    assert [app["a", k] for k in (1, 3, 7, 8)] == ["New", "Flat", "Expansion", "Contraction"]
    assert app["b", 2] == "New"
    with pytest.raises(ValueError):
        m.mrr_movement(mrr, "other")


@pytest.fixture
def ctx(frame, calendar):
    """x grows, y churns, z joins late, n has no segment, u is unknown."""
    mrr = frame(
        MRR,
        [
            ("x", month(1), money(10)), ("x", month(2), money(15)), ("x", month(3), money(20)),
            ("y", month(1), money(30)), ("y", month(2), money(0)), ("y", month(3), money(0)),
            ("z", month(2), money(5)), ("z", month(3), money(4)),
            ("n", month(1), money(7)), ("n", month(3), money(7)),
            ("u", month(1), money(99)),
        ],
    )
    accounts = frame(
        "account_id string, account_name string, segment string, region string, industry string,"
        " owner_rep_id string",
        [
            ("x", "X", "S1", "R1", "I1", "1"),
            ("y", "Y", "S2", "R1", "I1", "2"),
            ("z", None, "S1", "R2", "I2", None),
            ("n", "N", None, "R1", "I1", "9"),
        ],
    )
    reps = frame("rep_id string, team string, region string", [("1", "T1", "R1"), ("2", "T2", "R1")])
    pipe = frame("opp_id string, account_id string", [])
    return Context(mrr, pipe, accounts, reps)


def test_arr_trend_and_filters(ctx):
    def arr(filt):
        return {r.month.month: r.total_arr for r in m.arr_trend(ctx, month(1), month(3), filt).collect()}

    assert arr(DimFilter()) == {1: money(47 * 12), 2: money(20 * 12), 3: money(31 * 12)}
    everything_named = DimFilter(segments=("S1", "S2"))
    assert arr(everything_named) == {1: money(40 * 12), 2: money(20 * 12), 3: money(24 * 12)}
    assert arr(DimFilter(rep_teams=("T1", "T2"))) == {
        1: money(40 * 12), 2: money(15 * 12), 3: money(20 * 12),
    }
    assert arr(DimFilter(segments=("S1",), rep_regions=("R1",), rep_teams=("T2",))) == {}
    assert arr(DimFilter(segments=("it's",))) == {}


def test_without_reps_the_rep_selection_has_no_effect(ctx):
    bare = Context(ctx.mrr, ctx.pipeline, ctx.accounts)
    got = m.arr_trend(bare, month(1), month(1), DimFilter(rep_teams=("T1",))).first()
    assert got.total_arr == money(47 * 12)


def test_retention_trend(ctx):
    rows = {r.month.month: r for r in ret.retention_trend(ctx, month(1), month(3)).collect()}
    assert set(rows) == {1, 2}
    first = rows[1]
    # x 10->15, y 30->0, n 7-> no row in month 2.
    assert (first.start_mrr, first.end_mrr, first.retained_mrr) == (money(47), money(15), money(10))
    assert (first.nrr_pct, first.grr_pct) == (31.91, 21.28)
    assert rows[2].nrr_pct == 120.0 and rows[2].grr_pct == 95.0


def test_retention_of_an_empty_range(ctx):
    assert ret.retention_trend(ctx, date(2030, 1, 1), date(2030, 2, 1)).count() == 0


def test_movement_summary(ctx):
    got = {r.movement_type: (r.rows_count, r.net_mrr_change)
           for r in m.movement_summary(ctx, month(1), month(3)).collect()}
    assert got == {
        "New": (4, money(52)),
        "Expansion": (2, money(10)),
        "Churn": (1, money(-30)),
        "Contraction": (1, money(-1)),
        "Flat": (2, money(0)),
    }


def test_top_movers(ctx):
    up, down = m.top_movers(ctx, month(1), month(3), n=2)
    assert [(r.account_id, r.mrr_delta) for r in up.collect()] == [("n", money(7)), ("x", money(5))]
    assert [(r.account_id, r.mrr_delta) for r in down.collect()] == [("z", money(-1)), ("y", money(0))]
    assert up.first().account_name == "N"


def test_monthly_marts_and_identities(frame, calendar, known):
    mrr = frame(
        MRR,
        [
            ("x", month(1), money(10)), ("x", month(2), money(15)), ("x", month(3), money(20)),
            ("y", month(1), money(30)), ("z", month(4), money(5)),
        ],
    )
    dense = m.fct_mrr_complete(mrr, known(["x", "y", "z"]), calendar())
    nrr = {r.month.month: r for r in ret.nrr_monthly(dense).collect()}
    grr = {r.month.month: r for r in ret.grr_monthly(dense).collect()}
    arr = {r.month.month: r.total_arr for r in ret.arr_monthly(dense).collect()}
    assert set(nrr) == {2, 3, 4} and set(arr) == {1, 2, 3, 4}
    assert nrr[2].nrr_pct == 37.5 and grr[2].grr_pct == 25.0
    assert nrr[4].nrr_pct == 0.0
    assert arr == {1: money(480), 2: money(180), 3: money(240), 4: money(60)}
    assert all(grr[k].grr_pct <= min(100, nrr[k].nrr_pct) for k in nrr)
    changes = dense.groupBy("account_id").sum("mrr_change").collect()
    assert all(r[1] == 0 for r in changes)
    assert m.fct_arr(dense).where("arr <> 12 * total_mrr").count() == 0


def test_no_revenue_at_all(frame, calendar, known):
    dense = m.fct_mrr_complete(frame(MRR, []), known(["x"]), calendar())
    assert dense.count() == len(CALENDAR)
    assert ret.nrr_monthly(dense).count() == 0 and ret.arr_monthly(dense).count() == 0


def test_mart_and_app_retention_agree_one_month_apart(frame, calendar, known):
    rng = random.Random(7)
    ids = [f"a{i}" for i in range(30)]
    mrr = frame(MRR, [(a, d, money(rng.randint(0, 9))) for a in ids for d in CALENDAR])
    accounts = frame(
        "account_id string, segment string, region string, industry string, owner_rep_id string",
        [(a, "s", "r", "i", "1") for a in ids],
    )
    dense = m.fct_mrr_complete(mrr, accounts, calendar())
    mart = {r.month.month: r.nrr_pct for r in ret.nrr_monthly(dense).collect()}
    app = ret.retention_trend(Context(dense, dense, accounts), CALENDAR[0], CALENDAR[-1])
    assert {r.month.month + 1: r.nrr_pct for r in app.collect()} == mart


def quality(ctx, cohort, **kw):
    return ret.retention_quality(ctx, month(1), month(3), DimFilter(), cohort, **kw).first()


def test_retention_quality(ctx):
    row = quality(ctx, month(1))
    assert (row.cohort_accounts, row.next_month_accounts) == (3, 3)
    assert row.next_month_coverage_pct == 100.0 and row.retention_interpretable
    strict = quality(ctx, month(1), strict=True)
    assert (strict.next_month_accounts, strict.next_month_coverage_pct) == (1, 33.33)
    assert not strict.retention_interpretable
    assert strict.retention_note.startswith("Retention is NOT interpretable")
    assert quality(ctx, month(1), threshold=100.01).retention_interpretable is False


def test_retention_quality_without_cohort(ctx):
    row = quality(ctx, None)
    assert row.cohort_accounts is None and row.next_month_coverage_pct is None
    assert row.retention_interpretable is False and row.coverage_threshold_pct == 90.0
    assert row.retention_note.startswith("Retention cohort month not available")
    empty = quality(ctx, date(2023, 1, 1))
    assert (empty.cohort_accounts, empty.next_month_coverage_pct) == (0, None)
    assert empty.retention_interpretable is False


def test_calendar_follows_the_orders(spark, small, tmp_path):
    """An order after all others keeps its revenue, and every month up to it is there."""
    from datetime import date

    from pyspark.sql import functions as F

    from revtide.plans.marts import Marts
    from revtide.sources.star_schema import RawTables

    for name in ("customer", "nation", "region"):
        spark.read.parquet(f"{small}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    orders = spark.read.parquet(f"{small}/orders.parquet")
    kind = orders.schema["o_orderdate"].dataType
    late = orders.limit(1).withColumn("o_orderdate", F.lit("2003-05-17").cast("date").cast(kind))
    orders.unionByName(late).write.parquet(f"{tmp_path}/orders.parquet")
    dense = Marts(RawTables(spark, str(tmp_path)), date(2003, 6, 1)).fct_mrr_complete
    months = {r.month: r.total for r in dense.groupBy("month").agg(F.sum("total_mrr").alias("total")).collect()}
    assert max(months) == date(2003, 7, 1) and months[date(2003, 5, 1)] > 0
    assert len(months) == (2003 - min(months).year) * 12 + 7
