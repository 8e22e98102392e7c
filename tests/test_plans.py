"""Properties of the physical plans that decide how queries scale."""

import re
from datetime import date

import months
import pytest

from revtide.operators import health, mrr, retention
from revtide.operators.filters import EVERYTHING, Context
from revtide.plans import queries as q
from revtide.plans.marts import MART_NAMES, build_marts
from revtide.sources.catalog import CURRENT, write_mart
from revtide.sources.star_schema import RawTables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(q.QUERIES))
def test_no_python_and_no_nested_loops(name, spark, small):
    text = plan(q.QUERIES[name](spark, small))
    assert "Python" not in text and "InPandas" not in text
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_evidence_runs_nothing_before_it_is_asked_for(spark, small):
    from revtide.operators import evidence

    jobs, ctx = spark.sparkContext.statusTracker(), q._marts(spark, small).context()
    # Reading a file's schema is a job of its own.
    assert None not in [ctx.mrr.columns, ctx.pipeline.columns, ctx.accounts.columns, ctx.reps.columns]
    spark.sparkContext.setJobGroup("evidence", "declared")
    try:
        df = evidence.evidence_pack(ctx, months.START, months.END)
        assert df.columns == ["pack_json"]
        assert list(jobs.getJobIdsForGroup("evidence")) == []
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_dense_fact_is_unfolded_after_its_last_exchange(spark, small):
    text = plan(q._marts(spark, small).fct_mrr_complete)
    unfolding = next(i for i, line in enumerate(text.splitlines()) if "Generate posexplode(slice" in line)
    above = text.splitlines()[:unfolding]
    assert not any("Exchange" in line for line in above)
    # Revenue sums, distinct accounts, and one exchange for the timeline.
    shuffles = re.findall(r"Exchange hashpartitioning\((\w+)", text)
    assert shuffles.count("account_id") == 3


def test_revenue_is_summed_before_it_is_shuffled(spark, small):
    text = plan(q._marts(spark, small).fct_mrr)
    assert text.index("functions=[sum(mrr") < text.index("Exchange") < text.index("partial_sum(mrr")


def test_close_month_range_reaches_the_reader(spark, frame, tmp_path, small):
    from revtide.operators import deals
    from revtide.operators.filters import Context
    from revtide.sources.catalog import write_mart

    marts = q._marts(spark, small)
    pipe = write_mart(marts.fct_pipeline, str(tmp_path / "pipe"))
    ctx = Context(marts.fct_mrr_complete, pipe, marts.raw["accounts"])
    text = plan(deals.closed_revenue_monthly(ctx, months.START, months.END))
    scan = next(line for line in text.splitlines() if "/pipe]" in line)
    assert "GreaterThanOrEqual(close_date,1995-01-01)" in scan
    assert "LessThan(close_date,2001-09-01)" in scan
    assert "product_id" not in scan.split("ReadSchema")[1]


def test_batch_build_stores_every_mart(spark, small, tmp_path):
    stored = build_marts(RawTables(spark, small), q.AS_OF, lambda name: str(tmp_path / name))
    # Folders keep no buckets, so there is no layout by account.
    assert set(stored) == {*MART_NAMES, "monthly_revenue", "fct_mrr_complete_months"}
    lazy = q._marts(spark, small)
    for name in ("metrics_nrr_monthly", "metrics_pipeline_coverage", "fct_account_health"):
        ours = getattr(lazy, name)
        assert stored[name].columns == ours.columns
        assert sorted(map(str, stored[name].collect())) == sorted(map(str, ours.collect()))
    month = stored["fct_mrr_complete"].where("month = date '2000-01-01'")
    scan = next(l for l in plan(month).splitlines() if "FileScan" in l)
    assert "PartitionFilters: [isnotnull(month" in scan
    assert month.count() == lazy.raw["accounts"].count()


def test_a_hot_account_is_summed_exactly(spark, frame):
    """One account owns a third of all subscription rows."""
    from pyspark.sql import functions as F

    from revtide.operators.mrr import fct_mrr

    n = 30000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("account_id"),
        F.lit("2024-01-01").cast("date").alias("month"),
        F.lit("0.01").cast("decimal(18,2)").alias("mrr"),
    )
    got = fct_mrr(rows)
    assert got.count() == n - n // 3 + 1
    assert float(got.where("account_id = 'hot'").first().total_mrr) == 100.0


def test_a_hot_account_is_split_when_rows_meet_their_account(spark, frame):
    """Stage rows are joined row by row; the adaptive planner cuts the hot account up."""
    from pyspark.sql import functions as F

    from revtide.operators.filters import Context
    from revtide.operators.stages import stage_duration

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    n = 60000
    day = F.lit("2024-01-01").cast("date")
    hist = spark.range(0, n, 1, 8).select(
        F.col("id").cast("string").alias("opp_id"),
        F.when(F.col("id") % 3 == 0, "0").otherwise((F.col("id") % 997).cast("string")).alias("account_id"),
        F.lit("P").alias("stage"),
        day.alias("stage_start_date"),
        F.date_add(day, (F.col("id") % 5).cast("int")).alias("stage_end_date"),
    )
    accounts = spark.range(0, 1000).select(F.col("id").cast("string").alias("account_id"))
    for name in ("segment", "region", "industry", "owner_rep_id"):
        accounts = accounts.withColumn(name, F.lit("x"))
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        df = stage_duration(Context(hist, hist, accounts, history=hist))
        assert [tuple(r) for r in df.collect()] == [("P", n, 2.0)]
        assert "SortMergeJoin(skew=true)" in plan(df)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def months_read(df, folder):
    """Month folders that each scan of the stored fact read, in subqueries too, after running ``df``."""
    df.collect()
    read = []

    def walk(node):
        if node.nodeName().startswith("Scan parquet") and re.search(rf"{re.escape(folder)}(/|\]|,)", node.toString()):
            read.append(node.metrics().apply("numPartitions").value())
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        if "QueryStage" in node.nodeName():
            walk(node.plan())
        for i in range(node.children().size()):
            walk(node.children().apply(i))
        for i in range(node.subqueries().size()):
            walk(node.subqueries().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return read


@pytest.fixture(scope="module")
def built(spark, small):
    """Stored marts as tables, and the context over them."""
    spark.sql("create database if not exists plan_marts")
    raw = RawTables(spark, small)
    marts = build_marts(raw, q.AS_OF, lambda name: f"plan_marts.{name}")
    ctx = Context(
        mrr=marts["fct_mrr_complete"],
        pipeline=marts["fct_pipeline"],
        accounts=raw["accounts"],
        reps=raw["sales_reps"],
        tickets=raw["support_tickets"],
        months=marts["fct_mrr_complete_months"],
        by_account=marts["fct_mrr_complete_by_account"],
    )
    return marts, ctx, spark.sql("show tblproperties plan_marts.fct_mrr_complete").collect()


def dense_folder(built):
    return next(r.value for r in built[2] if r.key == CURRENT).split(".")[1]


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_newest_months_come_from_the_index(built, spark, small):
    marts, ctx, _ = built
    folder, lazy = dense_folder(built), q._marts(spark, small).context()
    health_ = health.account_health(ctx.accounts, ctx.mrr, ctx.pipeline, ctx.months)
    assert months_read(health_, folder) == [3]
    assert rows_of(health_) == rows_of(health.account_health(ctx.accounts, ctx.mrr, ctx.pipeline))
    for filt in (EVERYTHING, q.OWNER_FILTER):
        for end in (months.END, months.BOUNDARY_END):
            both = mrr.movers(ctx, months.START, end, filt, n=20)
            assert months_read(both, folder) == [2]
            assert rows_of(both) == rows_of(mrr.movers(lazy, months.START, end, filt, n=20))
            scored = health.computed_health(ctx, months.START, end, filt)
            assert months_read(scored, folder) == [3]
            assert rows_of(scored) == rows_of(health.computed_health(lazy, months.START, end, filt))


def test_index_of_a_range_without_months(built):
    _, ctx, _ = built
    early = date(1900, 1, 1), date(1900, 5, 1)
    assert mrr.movers(ctx, *early).collect() == []
    assert health.computed_health(ctx, *early).collect() == []


def test_windows_by_account_need_no_shuffle_on_stored_marts(built, spark, small):
    marts, ctx, _ = built
    lazy = q._marts(spark, small)

    def moves_the_fact(df):
        """Whether an exchange stands between the window and the scan of the fact."""
        lines = plan(df).splitlines()
        at = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
        depth = re.search(r"\w", lines[at]).start()
        for line in reversed(lines[:at]):
            here = re.search(r"\w", line).start()
            if here < depth:
                depth = here
                if "Exchange" in line:
                    return True
                if " Window " in line:
                    return False
        raise AssertionError("no window above the scan")

    enriched = mrr.mrr_movement(marts["fct_mrr_by_account"])
    assert not moves_the_fact(enriched)
    assert rows_of(enriched) == rows_of(marts["fct_mrr_enriched"]) == rows_of(lazy.fct_mrr_enriched)
    for filt in (EVERYTHING, q.OWNER_FILTER):
        for metric in (mrr.movement_summary, retention.retention_trend):
            found = metric(ctx, months.START, months.END, filt)
            assert not moves_the_fact(found)
            assert rows_of(found) == rows_of(metric(lazy.context(), months.START, months.END, filt))
    # Month ranges still prune the layout by month.
    assert months_read(mrr.arr_trend(ctx, months.COHORT, months.END), dense_folder(built)) == [2]


def test_without_an_index_the_stored_fact_is_read_once(spark, small, tmp_path):
    marts = q._marts(spark, small)
    folder = str(tmp_path / "dense")
    fact = write_mart(marts.fct_mrr_complete, folder, ["month"])
    ctx = Context(fact, marts.fct_pipeline, marts.raw["accounts"])
    assert 1 in months_read(health.latest_snapshot(fact, months.START, months.END), folder)
    # The newest rows of each account and the newest month come from one scan of all months.
    assert months_read(mrr.top_movers(ctx, months.START, months.END)[0], folder) == [80]
    assert months_read(mrr.arr_trend(ctx, months.COHORT, months.END), folder) == [2]
    scored = health.account_health(ctx.accounts, fact, ctx.pipeline)
    # Its bound reads every month.
    assert sorted(months_read(scored, folder)) == [3, 82]
