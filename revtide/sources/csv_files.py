"""CSV in and out.

Reading has two steps. ``read_raw_csv`` yields text columns with the null tokens
already null; ``load_table`` types them and fails the whole load on the first value
that does not fit, whatever the session's ANSI setting.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revtide import schemas
from revtide.sources.catalog import discard_mart, publish_mart, stage_mart


def read_raw_csv(
    spark: SparkSession,
    path: str,
    table: str,
    tokens: tuple[str, ...] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """All columns of ``table`` as text, by position, below one header line.

    A line with too few or too many fields aborts the read. ``multi_line`` allows
    line breaks inside quotes, but then one task must read each file whole.
    """
    tokens = schemas.null_tokens(table) if tokens is None else tokens
    lines = (
        spark.read.schema(schemas.text_schema(table))
        .option("header", True)
        .option("sep", ",")
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("multiLine", multi_line)
        # Check the field count also when a caller reads few columns.
        .option("columnPruning", False)
        .csv(path)
    )
    return lines.select(
        *(F.when(~F.col(c).isin(*tokens), F.col(c)).alias(c) for c in lines.columns)
    )


def load_table(raw: DataFrame, table: str) -> DataFrame:
    """Typed copy of a text frame; raises when a value does not fit its column."""
    return raw.select(
        *(_typed(table, name, kind).alias(name) for name, kind in schemas.COLUMNS[table])
    )


def _typed(table: str, name: str, kind: str) -> Column:
    text = F.col(name)
    limit = schemas.text_length(kind)
    if limit:
        problem = F.concat(F.lit(f"{table}.{name} is longer than {limit} characters: "), text)
        return F.when(F.length(text) > limit, F.raise_error(problem)).otherwise(text)
    if kind == "int":
        # "12.0", as exports of nullable integers write it, is a valid integer.
        value = F.round(text.try_cast("decimal(38,6)"), 0).try_cast("int")
    elif kind == "date":
        # try_cast also takes "2024" and "2024-02".
        value = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast(kind))
    else:
        value = text.try_cast(kind)
    problem = F.concat(F.lit(f"{table}.{name} is not a valid {kind}: "), text)
    return F.when(text.isNotNull() & value.isNull(), F.raise_error(problem).cast(kind)).otherwise(
        value
    )


#: Length of a text column from which on it is taken for free text, which may hold line breaks.
FREE_TEXT = 200


def has_free_text(table: str) -> bool:
    return any((schemas.text_length(kind) or 0) >= FREE_TEXT for _, kind in schemas.COLUMNS[table])


def load_csv(spark: SparkSession, path: str, table: str, multi_line: bool | None = None) -> DataFrame:
    """The typed table of a file or a folder of files.

    Quoted fields may hold line breaks where ``multi_line`` says so; a file is then read
    by one task, and a large table comes as a folder of files. By default that is so for
    tables with free text; files of the others are split, and a line break inside
    quotes is a wrong number of fields, which aborts the load.
    """
    whole = has_free_text(table) if multi_line is None else multi_line
    return load_table(read_raw_csv(spark, path, table, multi_line=whole), table)


def load_folder(spark: SparkSession, folder: str, multi_line: bool | None = None) -> dict[str, DataFrame]:
    """The loaded tables by name, each from ``<folder>/<table>.csv``, a file or a folder.

    They are plans; ``load_into`` stores them all or none.
    """
    return {
        table: load_csv(spark, f"{folder}/{table}.csv", table, multi_line)
        for table in schemas.LOADED_TABLES
    }


def load_into(
    spark: SparkSession,
    folder: str,
    target: Callable[[str], str] = "raw.{}".format,
    multi_line: bool | None = None,
) -> dict[str, DataFrame]:
    """Load every table and store it as ``target(table)``: all of them, or none.

    First each table is read, typed and written as a version that nobody sees. Only
    when the last one is whole are they published, one quick switch each; a value that
    does not fit drops what was staged and leaves the tables as they were.
    """
    staged: dict[str, str] = {}
    try:
        for table, df in load_folder(spark, folder, multi_line).items():
            staged[table] = stage_mart(df, target(table))
    except BaseException:
        for version in staged.values():
            discard_mart(spark, version)
        raise
    for table, version in staged.items():
        publish_mart(spark, target(table), version)
    return {
        table: spark.read.schema(schemas.schema(table)).parquet(target(table)) if "/" in target(table) else spark.table(target(table))
        for table in staged
    }


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count), one row per table."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    if not counts:
        raise ValueError("no tables to count")
    total = counts[0]
    for one in counts[1:]:
        total = total.unionAll(one)
    return total


def export_csv(df: DataFrame, path: str) -> None:
    """Write with a header, one file per partition, replacing what was there."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
