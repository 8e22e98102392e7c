"""Run a registered query and its SQL, and compare them as sets of rows."""

from __future__ import annotations

import math
from datetime import datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SPARK_TO_SQL = {
    "string": "VARCHAR",
    "date": "DATE",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def open_database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.10g}")
    return value


def as_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    made = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(made, key=lambda r: tuple((v is None, str(v)) for v in r))


def assert_same(df, con, sql):
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    types = [str(d[1]) for d in rel.description]
    expected = as_rows(names, rel.fetchall())
    assert sorted(df.columns) == sorted(names)
    ours = {f.name: SPARK_TO_SQL[f.dataType.simpleString()] for f in df.schema.fields}
    assert ours == dict(zip(names, types))
    actual = as_rows(df.columns, df.collect())
    assert len(actual) == len(expected)
    different = [(a, e) for a, e in zip(actual, expected) if a != e]
    assert not different, f"{len(different)} rows differ, first: {different[0]}"
    assert expected, "an empty result compares nothing"
