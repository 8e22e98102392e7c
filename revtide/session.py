"""Session settings the metrics rely on, and scratch tables on shared storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    # Joins on account_id may meet an account with a large share of all rows.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("revtide")
    options = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        # Do not record the Python call site of every column expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **extra,
    }
    for key, value in options.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def scratch_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; a temporary one only in local mode without it."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="revtide-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """Write once to the shared folder and read back.

    Unlike ``cache`` the result survives lost executors, and unlike ``checkpoint`` it
    stays columnar, so later readers still prune columns and push filters down.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/revtide-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
