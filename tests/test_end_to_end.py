"""From CSV files over stored tables to metrics, as a user would run it."""

import months

from revtide.operators import health, mrr
from revtide.plans import queries as q
from revtide.plans.marts import build_marts, context_of, governed_view
from revtide.schemas import LOADED_TABLES
from revtide.sources.catalog import ensure_layers, register_view, resolve_layouts, resolve_tables, write_mart
from revtide.sources.csv_files import export_csv, load_into, row_counts
from revtide.sources.star_schema import RawTables


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_files_to_metrics(spark, small, tmp_path):
    source = RawTables(spark, small)
    for table in LOADED_TABLES:
        export_csv(source[table], f"{tmp_path}/{table}.csv")
    ensure_layers(spark)
    raw = load_into(spark, str(tmp_path))
    assert same(row_counts(raw), q.QUERIES["load_row_counts"](spark, small))
    assert same(raw["opportunities"], source["opportunities"])

    marts = build_marts(raw, q.AS_OF, lambda name: f"marts.{name}")
    register_view(governed_view(marts), "v_metrics")
    assert same(spark.table("v_metrics"), q._marts(spark, small).v_gtm_metrics)

    resolved = resolve_tables(spark)
    assert resolved["fct_mrr"] == "marts.fct_mrr_complete"
    assert resolved["health_snapshot"] == "marts.fct_account_health"
    layouts = resolve_layouts(spark, resolved)
    assert set(layouts) == {"mrr_months", "mrr_by_account"}
    tables = {name: spark.table(table) for name, table in {**resolved, **layouts}.items() if table}
    ctx = context_of(tables)
    assert ctx.tickets is None
    lazy = q._marts(spark, small).context()
    assert same(mrr.arr_trend(ctx, months.START, months.END), mrr.arr_trend(lazy, months.START, months.END))
    assert same(mrr.movers(ctx, months.START, months.END), mrr.movers(lazy, months.START, months.END))
    # The stored health mart holds no months, so health is computed.
    snapshot = health.health_snapshot(ctx, months.START, months.END)
    assert same(snapshot, health.computed_health(ctx, months.START, months.END).select(snapshot.columns)) and snapshot.count() == 150
    scored = health.computed_health(ctx, months.START, months.END)
    assert scored.where("ticket_cnt_90d <> 0").count() == 0 and scored.count() == 150


def test_bucketed_fact_needs_no_shuffle_for_its_window(spark, small):
    ensure_layers(spark)
    fact = write_mart(q._marts(spark, small).fct_mrr, "marts.fct_mrr_bucketed", buckets=4)
    moves = mrr.mrr_movement(fact)
    plan = moves._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Exchange" not in plan
    assert same(moves, q._marts(spark, small).fct_mrr_enriched)
