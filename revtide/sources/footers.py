"""Counts and bounds of stored Parquet tables, answered from the files' footers.

Every Parquet file states its number of rows and the least and largest value of its
columns. The second version of Spark's reader pushes count, min and max without filters down
to these, so no data page is read, however large the table is.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from revtide.sources.csv_files import row_counts

_FIRST_VERSION = "spark.sql.sources.useV1SourceList"
_PUSHDOWN = "spark.sql.parquet.aggregatePushdown"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def parquet_by_footers(spark: SparkSession, path: str) -> DataFrame:
    """The table in a folder, so read that count, min and max come from its footers.

    They do for whole numbers, floats, dates and booleans, and for counts of any column;
    other aggregates read the data as always.
    """
    spark.conf.set(_PUSHDOWN, "true")
    others = [x for x in spark.conf.get(_FIRST_VERSION).split(",") if x.strip() != "parquet"]
    with _setting(spark, _FIRST_VERSION, ",".join(others)):
        return spark.read.parquet(path)


def stored_row_counts(spark: SparkSession, folders: Mapping[str, str]) -> DataFrame:
    """``row_counts`` of stored tables by name, from footers alone."""
    return row_counts({name: parquet_by_footers(spark, path) for name, path in folders.items()})
