"""Layers, stored tables, views, and finding the tables that exist."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

# The layers that receive objects.
LAYERS = ("raw", "marts", "semantic")

# Where each dataset may live, first match wins.
CANDIDATES: dict[str, tuple[str, ...]] = {
    "accounts": ("raw.accounts",),
    "sales_reps": ("raw.sales_reps",),
    "fct_mrr": ("marts.fct_mrr_complete", "marts.fct_mrr"),
    "fct_pipeline": ("marts.fct_pipeline",),
    "stage_history": (
        "raw.opportunity_stage_history",
        "marts.opportunity_stage_history",
    ),
    "support_tickets": ("raw.support_tickets",),
    "health_snapshot": (
        "marts.account_health",
        "marts.metrics_account_health",
        "marts.fct_account_health",
    ),
}
REQUIRED = ("accounts", "fct_mrr", "fct_pipeline")
#: What is stored beside a fact to read it faster: dataset, table of the fact, own table.
LAYOUTS: dict[str, tuple[str, str]] = {
    "mrr_months": ("marts.fct_mrr_complete", "marts.fct_mrr_complete_months"),
    "mrr_by_account": ("marts.fct_mrr_complete", "marts.fct_mrr_complete_by_account"),
}
NOT_FOUND = "NOT FOUND"


class MissingTables(LookupError):
    """A dataset that every metric needs has no table."""


def ensure_layers(spark: SparkSession, layers: Sequence[str] = LAYERS) -> None:
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")


#: View properties of a stored table: the version it shows, and the one before.
CURRENT, PREVIOUS = "revtide.current", "revtide.previous"


def write_mart(
    df: DataFrame,
    target: str,
    partition_by: Sequence[str] = (),
    buckets: int = 0,
    bucket_by: str = "account_id",
) -> DataFrame:
    """Replace a stored table by ``df`` and return it as read back.

    ``target`` is a folder if it contains a slash, else a table name. The new rows are
    written whole beside the old ones before readers are switched over (``stage_mart``,
    ``publish_mart``), so a write that fails leaves the old rows, and a mart can be
    rebuilt from itself.

    With ``partition_by`` rows are first regrouped by those columns; REBALANCE lets the
    adaptive planner cut a value with many rows into several files.

    ``buckets`` lays a table out by ``bucket_by`` instead, so that later joins and
    windows on that column need no shuffle. It fits facts with few rows per key.
    """
    version = stage_mart(df, target, partition_by, buckets, bucket_by)
    publish_mart(df.sparkSession, target, version)
    spark = df.sparkSession
    if "/" in target:
        return spark.read.schema(df.schema).parquet(target).select(df.columns)
    return spark.table(target).select(df.columns)


def stage_mart(
    df: DataFrame,
    target: str,
    partition_by: Sequence[str] = (),
    buckets: int = 0,
    bucket_by: str = "account_id",
) -> str:
    """Write ``df`` as a new version of ``target``, which nobody reads yet; its name.

    What a failed write leaves is dropped.
    """
    if buckets and "/" in target:
        raise ValueError("only a table can be bucketed, not a folder")
    version = f"{target}__v_{uuid.uuid4().hex}"
    if buckets:
        df = df.repartition(buckets, bucket_by)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    try:
        if "/" in target:
            writer.save(version)
        else:
            writer.saveAsTable(version)
    except BaseException:
        discard_mart(df.sparkSession, version)
        raise
    return version


def publish_mart(spark: SparkSession, target: str, version: str) -> None:
    """Let readers of ``target`` see a staged version.

    A table is a view of its version, replaced in one step of the catalog; the version
    before stays for queries that are reading it, and goes with the next publication. A
    folder is swapped by renaming.
    """
    if "/" in target:
        fs, path = _file_system(spark, target)
        old = None
        if fs.exists(path(target)):
            old = f"{version}_old"
            if not fs.rename(path(target), path(old)):
                raise OSError(f"cannot move {target}")
        if not fs.rename(path(version), path(target)):
            if old:
                fs.rename(path(old), path(target))
            raise OSError(f"cannot move {version}")
        if old:
            fs.delete(path(old), True)
        return
    shown = _versions(spark, target)
    if shown is None and spark.catalog.tableExists(target):
        # A plain table of that name becomes a version.
        current = f"{target}__v_{uuid.uuid4().hex}"
        spark.sql(f"ALTER TABLE {_quoted(target)} RENAME TO {_quoted(current)}")
        shown = {CURRENT: current}
    shown = shown or {}
    before = shown.get(CURRENT, "")
    spark.sql(
        f"CREATE OR REPLACE VIEW {_quoted(target)} "
        f"TBLPROPERTIES ('{CURRENT}' = '{version}', '{PREVIOUS}' = '{before}') "
        f"AS SELECT * FROM {_quoted(version)}"
    )
    if shown.get(PREVIOUS):
        discard_mart(spark, shown[PREVIOUS])


def discard_mart(spark: SparkSession, version: str) -> None:
    """Drop a version."""
    if "/" in version:
        fs, path = _file_system(spark, version)
        fs.delete(path(version), True)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(version)}")


def _versions(spark: SparkSession, target: str) -> dict[str, str] | None:
    """The versions that a published table names, None if it is none."""
    if not spark.catalog.tableExists(target):
        return None
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_quoted(target)}").collect()}
    return found if CURRENT in found else None


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _file_system(spark: SparkSession, folder: str):
    """The file system that holds a folder, and what makes its paths."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(folder).getFileSystem(spark._jsc.hadoopConfiguration()), path


def register_view(df: DataFrame, name: str) -> None:
    """A named query that is computed when it is read."""
    df.createOrReplaceTempView(name)


def resolve_tables(
    spark: SparkSession,
    candidates: Mapping[str, Sequence[str]] = CANDIDATES,
    required: Sequence[str] = REQUIRED,
) -> dict[str, str | None]:
    """First existing table per dataset, None for an optional one without any."""
    resolved = {
        dataset: next((t for t in names if spark.catalog.tableExists(t)), None)
        for dataset, names in candidates.items()
    }
    missing = [dataset for dataset in required if not resolved.get(dataset)]
    if missing:
        raise MissingTables("no table found for: " + ", ".join(missing))
    return resolved


def resolve_layouts(
    spark: SparkSession,
    resolved: Mapping[str, str | None],
    layouts: Mapping[str, tuple[str, str]] = LAYOUTS,
) -> dict[str, str]:
    """The existing layouts of the facts that were resolved; none of another fact's."""
    return {
        dataset: table
        for dataset, (fact, table) in layouts.items()
        if fact in resolved.values() and spark.catalog.tableExists(table)
    }


def resolution_report(spark: SparkSession, resolved: Mapping[str, str | None]) -> DataFrame:
    rows = [(dataset, table or NOT_FOUND) for dataset, table in resolved.items()]
    return spark.createDataFrame(rows, "dataset string, table_name string")
