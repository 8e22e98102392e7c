"""Time the headline queries; print one JSON line.

Environment: BENCH_SF_DIR (folder of Parquet tables), BENCH_CPUS (local cores),
BENCH_RUNS (timed runs per query after one warm-up, the median counts),
BENCH_QUERIES (comma-separated names, or "all"; default the headline queries).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from revtide.plans.queries import QUERIES
from revtide.session import local_session

HEADLINE = (
    "fct_mrr",
    "fct_mrr_enriched",
    "fct_mrr_complete",
    "metrics_nrr_monthly",
    "metrics_grr_monthly",
    "metrics_arr_monthly",
    "fct_pipeline",
    "metrics_pipeline_summary",
    "metrics_pipeline_monthly",
    "metrics_pipeline_coverage",
    "fct_stage_velocity",
    "metrics_stage_conversion",
    "fct_account_health",
    "v_gtm_metrics",
    "app_arr_trend",
    "app_retention_trend",
    "app_closed_revenue_monthly",
    "app_pipeline_coverage",
    "app_mrr_movement_summary",
    "app_top_expansions",
    "app_computed_health",
    "app_stage_transitions",
    "evidence_pack",
    "response_sections",
)


def chosen() -> list[str]:
    wanted = os.environ.get("BENCH_QUERIES", "")
    if wanted == "all":
        return list(QUERIES)
    return [n for n in wanted.split(",") if n] or list(HEADLINE)


def seconds(query, spark, folder: str) -> float:
    """Build, plan and run; the rows are produced in full and thrown away."""
    begin = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session(cores, shuffle_partitions=cores)
    times: dict[str, float] = {}
    for name in chosen():
        seconds(QUERIES[name], spark, folder)
        timed = [seconds(QUERIES[name], spark, folder) for _ in range(runs)]
        times[name] = round(statistics.median(timed), 3)
    spark.stop()
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
