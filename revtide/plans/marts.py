"""Which mart is built from which table, lazily or into storage."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame

from revtide.operators import deals, health, mrr, retention, semantic, stages
from revtide.operators.filters import Context, month_index
from revtide.sources.catalog import write_mart


class Marts:
    """The marts over raw tables, each declared on first use.

    ``keep`` decides what happens to a mart that others read. By default it stays a
    plan, so one query over a mart is optimised down to the raw scans. A batch build
    passes a function that writes the mart and returns it as stored, and every later
    mart then starts from storage. Such a build also stores the dense fact's month index,
    and with ``lay_out`` copies of the revenue facts laid out by account, which metrics
    that order an account's rows read.
    """

    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        as_of: date,
        keep: Callable[[str, DataFrame], DataFrame] | None = None,
        lay_out: Callable[[str, DataFrame], DataFrame] | None = None,
    ):
        self.raw = raw
        self.as_of = as_of
        self.stored = keep is not None
        self.keep = keep or (lambda name, df: df)
        self.lay_out = lay_out

    @cached_property
    def fct_mrr(self) -> DataFrame:
        return self.keep("fct_mrr", mrr.fct_mrr(self.raw["subscription_monthly_mrr"]))

    @cached_property
    def fct_mrr_complete(self) -> DataFrame:
        dense = mrr.fct_mrr_complete(self.fct_mrr, self.raw["accounts"], self.raw["dim_date"])
        return self.keep("fct_mrr_complete", dense)

    @cached_property
    def fct_mrr_complete_months(self) -> DataFrame | None:
        """The dense fact's month index; none beside a fact that is still a plan."""
        return self.keep("fct_mrr_complete_months", month_index(self.fct_mrr_complete)) if self.stored else None

    @cached_property
    def fct_mrr_by_account(self) -> DataFrame | None:
        return self.lay_out("fct_mrr_by_account", self.fct_mrr) if self.lay_out else None

    @cached_property
    def fct_mrr_complete_by_account(self) -> DataFrame | None:
        return self.lay_out("fct_mrr_complete_by_account", self.fct_mrr_complete) if self.lay_out else None

    @cached_property
    def fct_pipeline(self) -> DataFrame:
        return self.keep("fct_pipeline", deals.fct_pipeline(self.raw["opportunities"], self.as_of))

    @cached_property
    def metrics_pipeline_monthly(self) -> DataFrame:
        return self.keep("metrics_pipeline_monthly", deals.pipeline_monthly(self.fct_pipeline))

    @cached_property
    def monthly_revenue(self) -> DataFrame:
        """Shared by three marts; one row per month."""
        return self.keep("monthly_revenue", retention.monthly_revenue(self.fct_mrr_complete))

    @property
    def fct_mrr_enriched(self) -> DataFrame:
        by_account = self.fct_mrr_by_account
        return mrr.mrr_movement(self.fct_mrr if by_account is None else by_account)

    @property
    def metrics_nrr_monthly(self) -> DataFrame:
        return retention.nrr_from(self.monthly_revenue)

    @property
    def metrics_grr_monthly(self) -> DataFrame:
        return retention.grr_from(self.monthly_revenue)

    @property
    def metrics_arr_monthly(self) -> DataFrame:
        return retention.arr_from(self.monthly_revenue)

    @property
    def fct_arr(self) -> DataFrame:
        return mrr.fct_arr(self.fct_mrr_complete)

    @property
    def metrics_pipeline_summary(self) -> DataFrame:
        return deals.pipeline_summary(self.fct_pipeline)

    @property
    def metrics_pipeline_created_monthly(self) -> DataFrame:
        return deals.pipeline_created_monthly(self.raw["opportunities"])

    @property
    def metrics_pipeline_coverage(self) -> DataFrame:
        return deals.pipeline_coverage(self.fct_pipeline, self.metrics_pipeline_monthly)

    @property
    def fct_stage_velocity(self) -> DataFrame:
        return stages.stage_velocity(self.raw["opportunity_stage_history"])

    @property
    def metrics_stage_conversion(self) -> DataFrame:
        return stages.stage_conversion(self.raw["opportunity_stage_history"])

    @property
    def fct_account_health(self) -> DataFrame:
        rows_of = None if self.stored else (self.raw["subscription_monthly_mrr"], self.raw["dim_date"])
        return health.account_health(
            self.raw["accounts"], self.fct_mrr_complete, self.fct_pipeline, self.fct_mrr_complete_months, rows_of
        )

    @property
    def v_gtm_metrics(self) -> DataFrame:
        return semantic.gtm_metrics_from_facts(self.fct_mrr_complete, self.fct_pipeline)

    def context(self) -> MartContext:
        return MartContext(self)


class MartContext:
    """What the filterable metrics read: a ``Context`` whose frames are declared on use."""

    def __init__(self, marts: Marts):
        self._marts = marts

    @property
    def mrr(self) -> DataFrame:
        return self._marts.fct_mrr_complete

    @property
    def pipeline(self) -> DataFrame:
        return self._marts.fct_pipeline

    @property
    def accounts(self) -> DataFrame:
        return self._marts.raw["accounts"]

    @property
    def reps(self) -> DataFrame:
        return self._marts.raw["sales_reps"]

    @property
    def history(self) -> DataFrame:
        return self._marts.raw["opportunity_stage_history"]

    @property
    def tickets(self) -> DataFrame:
        return self._marts.raw["support_tickets"]

    @property
    def health(self) -> None:
        """Marts store no monthly snapshot of health."""
        return None

    @property
    def months(self) -> DataFrame | None:
        return self._marts.fct_mrr_complete_months

    @property
    def by_account(self) -> DataFrame | None:
        return self._marts.fct_mrr_complete_by_account


MART_NAMES = (
    "fct_mrr",
    "fct_mrr_enriched",
    "fct_mrr_complete",
    "metrics_nrr_monthly",
    "fct_arr",
    "metrics_arr_monthly",
    "metrics_grr_monthly",
    "fct_pipeline",
    "metrics_pipeline_summary",
    "metrics_pipeline_monthly",
    "metrics_pipeline_created_monthly",
    "metrics_pipeline_coverage",
    "fct_stage_velocity",
    "metrics_stage_conversion",
    "fct_account_health",
)
# Read by month range again and again, so laid out by month.
BY_MONTH = ("fct_mrr_complete", "fct_arr")


def build_marts(
    raw: Mapping[str, DataFrame], as_of: date, target: Callable[[str], str]
) -> dict[str, DataFrame]:
    """Write every mart to ``target(name)``, a folder or table name, facts first.

    Marts built on a fact read the stored fact, so each fact is computed once. The
    monthly sums behind three of the marts are stored as ``monthly_revenue``, the dense
    fact's month index as ``fct_mrr_complete_months``. If the targets are tables, the two revenue
    facts are also stored in buckets of one account each, as ``fct_mrr_by_account`` and
    ``fct_mrr_complete_by_account``; a folder cannot keep buckets.
    """

    def write(name: str, df: DataFrame) -> DataFrame:
        return write_mart(df, target(name), ["month"] if name in BY_MONTH else [])

    built: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame) -> DataFrame:
        built[name] = write(name, df)
        return built[name]

    def lay_out(name: str, df: DataFrame) -> DataFrame:
        buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        built[name] = write_mart(df, target(name), buckets=buckets)
        return built[name]

    as_tables = "/" not in target("fct_mrr_by_account")
    marts = Marts(raw, as_of, keep, lay_out if as_tables else None)
    if as_tables:
        # Read by metrics over the stored marts only.
        marts.fct_mrr_complete_by_account
    for name in MART_NAMES:
        df = getattr(marts, name)
        if name not in built:
            built[name] = write(name, df)
    return built


def governed_view(marts: Mapping[str, DataFrame]) -> DataFrame:
    """The monthly view over stored marts."""
    return semantic.gtm_metrics(
        marts["metrics_arr_monthly"],
        marts["metrics_nrr_monthly"],
        marts["metrics_grr_monthly"],
        marts["metrics_pipeline_monthly"],
        marts["metrics_pipeline_coverage"],
    )


def context_of(tables: Mapping[str, DataFrame | None]) -> Context:
    """A context over tables named as ``resolve_tables`` and ``resolve_layouts`` name them."""
    return Context(
        mrr=tables["fct_mrr"],
        pipeline=tables["fct_pipeline"],
        accounts=tables["accounts"],
        reps=tables.get("sales_reps"),
        history=tables.get("stage_history"),
        tickets=tables.get("support_tickets"),
        health=tables.get("health_snapshot"),
        months=tables.get("mrr_months"),
        by_account=tables.get("mrr_by_account"),
    )
