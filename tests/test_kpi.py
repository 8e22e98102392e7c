import json
from datetime import date
from decimal import Decimal

import months
import pytest
from pyspark.sql import functions as F

from revtide.functions import display
from revtide.operators import kpi
from revtide.operators.quality import quality_checks
from revtide.operators.filters import Context, filter_domains


def month(k):
    return date(2024, k, 1)


@pytest.fixture
def arr(frame):
    return lambda values: frame(
        "month date, total_arr decimal(20,2)", [(month(k + 1), Decimal(v)) for k, v in enumerate(values)]
    )


@pytest.mark.parametrize(
    "values, expected",
    [
        ([10, 12, 0], (month(2), 12.0, 10.0, 2.0)),
        ([10, 0, 7], (month(3), 7.0, 10.0, -3.0)),
        ([5], (month(1), 5.0, None, None)),
        ([0, 0], (None, None, None, None)),
        ([], (None, None, None, None)),
    ],
)
def test_latest_and_previous_positive_month(arr, values, expected):
    assert tuple(kpi.kpi_arr(arr(values)).first()) == expected


def test_retention_kpis_keep_the_guard(frame):
    series = frame(
        "month date, start_mrr decimal(20,2), nrr_pct double, grr_pct double",
        [(month(1), Decimal(5), 100.0, 90.0), (month(2), Decimal(8), 95.0, 94.0),
         (month(3), Decimal(0), None, None)],
    )
    row = kpi.kpi_retention(series).first().asDict()
    assert row == {
        "latest_month": month(2), "start_mrr_latest": 8.0,
        "nrr_latest": 95.0, "nrr_previous": 100.0, "nrr_delta": -5.0,
        "grr_latest": 94.0, "grr_previous": 90.0, "grr_delta": 4.0,
    }


@pytest.fixture
def fired(frame, arr):
    def run(nrr, grr, coverage, arr_values):
        kpis = frame("nrr_latest double, grr_latest double", [(nrr, grr)])
        cover = frame("pipeline_coverage_ratio double", [(coverage,)])
        return {r.rule: r for r in kpi.alerts(kpis, cover, arr(arr_values)).collect()}
    return run


def test_alerts_fire_below_only(fired):
    assert fired(90.0, 90.0, 3.0, [1, 2, 3]) == {}
    assert fired(None, None, None, [3, 2]) == {}
    got = fired(89.5, 12.0, 2.99, [9, 3, 5, 2])
    assert set(got) == {"nrr", "grr", "coverage", "arr_trend"}
    assert got["nrr"].message == "Net Revenue Retention below 90% (NRR=89.50%)."
    assert got["grr"].message == "Gross Revenue Retention below 90% (GRR=12.00%)."
    assert got["coverage"].message == "Pipeline coverage below 3.0x (Coverage=2.99x)."
    assert got["arr_trend"].message == "ARR trending down over recent months."
    assert (got["arr_trend"].value, got["arr_trend"].threshold) == (2.0, 3.0)
    assert set(fired(95.0, 95.0, 5.0, [1, 9, 5, 9])) == set()
    assert set(fired(95.0, 95.0, 5.0, [9, 5, 0])) == {"arr_trend"}


def texts(spark, fmt, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    return [r.t for r in df.orderBy("i").select(fmt(F.col("v")).alias("t")).collect()]


VALUES = [0.0, 0.125, 0.375, 1.005, 999.994, 999.999, 1000.0, 1000.5, 1001.5, 999999.4, 1e6,
          1234567.0, 1e9, 9876543210.0, -0.5, -2500.0, -3.2e6, -7.5e9]


def test_formats_equal_python_formatting(spark):
    def scaled(v, size):
        if size >= 1e9:
            return f"{v / 1e9:,.2f}B"
        if size >= 1e6:
            return f"{v / 1e6:,.2f}M"
        return f"{v:,.0f}" if size >= 1e3 else f"{v:,.2f}"

    assert texts(spark, display.fmt_number, VALUES) == [scaled(v, abs(v)) for v in VALUES]
    assert texts(spark, display.fmt_currency, VALUES) == [
        ("-" if v < 0 else "") + "$" + scaled(abs(v), abs(v)) for v in VALUES
    ]
    assert texts(spark, display.fmt_pct, VALUES) == [f"{v:.2f}%" for v in VALUES]
    assert texts(spark, display.fmt_x, VALUES) == [f"{v:.2f}x" for v in VALUES]
    for fmt in (display.fmt_number, display.fmt_currency, display.fmt_pct, display.fmt_x):
        assert texts(spark, fmt, [None, float("nan")]) == ["—", "—"]


def test_coverage_classes(spark):
    got = texts(spark, display.coverage_assessment, [None, 2.99, 3.0, 5.99, 6.0, 9.99, 10.0])
    assert got == ["unknown", "low", "healthy", "healthy", "strong", "strong",
                   "very high (validate denominator)"]


def test_retention_display(frame):
    df = frame("v double, s double", [(None, 5.0), (0.0, 5.0), (0.0, 0.0), (0.0, None), (91.5, 5.0)])
    got = [r[0] for r in df.select(display.retention_display(F.col("v"), F.col("s"))).collect()]
    assert got == ["Not available", "Data not loaded for selected period", "0.00%", "0.00%", "91.50%"]


def test_melt(frame):
    df = frame("month date, a int, b decimal(5,2)", [(month(1), 1, Decimal("2.50"))])
    got = {tuple(r) for r in kpi.melt_series(df, "month", ["a", "b"]).collect()}
    assert got == {(month(1), "a", 1.0), (month(1), "b", 2.5)}


def test_quality_checks(frame):
    mrr = frame("account_id string, month date, total_mrr int", [("a", month(1), 1), ("b", month(3), 1)])
    pipe = frame("close_date date", [(None,)])
    accounts = frame("account_id string", [])
    got = {r["check"]: (r["min"], r["max"], r["rows"])
           for r in quality_checks(Context(mrr, pipe, accounts, tickets=pipe)).collect()}
    assert got == {
        "MRR date bounds": (month(1), month(3), None),
        "Row count — FCT_MRR": (None, None, 2),
        "Pipeline close bounds": (None, None, None),
        "Row count — FCT_PIPELINE": (None, None, 1),
        "Row count — Accounts": (None, None, 0),
        "Row count — Support Tickets": (None, None, 1),
    }


def test_filter_domains(frame):
    accounts = frame("segment string, region string, industry string",
                     [("s2", "r", None), ("s1", "r", None), (None, "r", None)])
    reps = frame("team string, region string", [("t", "x"), ("t", None)])
    got = [tuple(r) for r in filter_domains(accounts, reps).collect()]
    assert got == [("region", "r"), ("rep_region", "x"), ("rep_team", "t"),
                   ("segment", "s1"), ("segment", "s2")]
    assert filter_domains(accounts).count() == 3


def test_evidence_pack(spark, small):
    from revtide.plans import queries as q
    from revtide.operators import deals, mrr, retention

    row = q._evidence_pack(spark, small)
    assert row.columns == ["pack_json"]
    pack = json.loads(row.first().pack_json)
    assert list(pack) == ["time_window", "filters", "benchmarks", "metrics", "data_quality",
                          "series", "pipeline", "mrr_movement", "rules"]
    assert pack["time_window"] == "1995-01-01 to 2001-08-01"
    assert pack["filters"] == {"start_date": "1995-01-01", "end_date": "2001-08-01",
                               "retention_cohort_month": "2001-07-01"}

    ctx = q._marts(spark, small).context()
    arr = mrr.arr_trend(ctx, months.START, months.END).collect()
    assert [r["TOTAL_ARR"] for r in pack["series"]["arr_trend_last_12"]] == [
        float(r.total_arr) for r in arr[-12:]
    ]
    assert pack["series"]["arr_trend_last_12"][-1]["MONTH"] == "2001-08-01T00:00:00.000"
    assert pack["metrics"]["arr_latest"] == float(arr[-1].total_arr)
    last = retention.retention_trend(ctx, months.START, months.END).collect()[-1]
    assert pack["metrics"]["nrr_pct"] == last.nrr_pct
    assert pack["series"]["retention_last_12"][-1]["GRR_PCT"] == last.grr_pct
    cover = deals.coverage_3m(ctx, months.START, months.END).first()
    assert pack["metrics"]["total_open_pipeline"] == float(cover.total_open_pipeline)
    assert pack["pipeline"]["coverage_row"][0]["PIPELINE_COVERAGE_RATIO"] == cover.pipeline_coverage_ratio
    stages = [r["OPEN_PIPELINE"] for r in pack["pipeline"]["open_by_stage_top_8"]]
    assert stages == sorted(stages, reverse=True) and len(stages) == 4
    rises = [r["MRR_DELTA"] for r in pack["mrr_movement"]["top_expansions"]]
    falls = [r["MRR_DELTA"] for r in pack["mrr_movement"]["top_contractions"]]
    assert rises == sorted(rises, reverse=True) and falls == sorted(falls)
    assert len(rises) == len(falls) == 5
    assert pack["data_quality"]["retention_interpretable"] is True
    assert set(pack["rules"]) == {"grounding_rule", "retention_rule", "pipeline_rule"}


def test_evidence_pack_of_nothing(frame):
    from revtide.operators.evidence import evidence_pack

    ctx = Context(
        frame("account_id string, month date, total_mrr decimal(28,2)", []),
        frame("opp_id string, account_id string, rep_id string, created_date date, close_date date,"
              " current_stage string, probability decimal(5,2), amount decimal(18,2),"
              " is_closed boolean, is_won boolean", []),
        frame("account_id string, account_name string, segment string, region string,"
              " industry string, owner_rep_id string", []),
    )
    pack = json.loads(evidence_pack(ctx, month(1), month(6)).first().pack_json)
    assert pack["filters"]["retention_cohort_month"] is None
    assert pack["metrics"]["arr_latest"] is None
    assert pack["metrics"]["pipeline_coverage_assessment"] == "unknown"
    assert pack["data_quality"]["retention_note"].startswith("Retention cohort month not available")
    assert pack["series"]["arr_trend_last_12"] == []
    assert pack["mrr_movement"]["movement_summary"] == []
