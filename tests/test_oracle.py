"""Every registered query against its SQL on the second engine."""

import pytest
from compare import assert_same, open_database

import __spark_entry__ as entry_points
from revtide.plans.oracle_sql import ORACLE_SQL
from revtide.plans.queries import QUERIES


@pytest.fixture(scope="module")
def database(small):
    return open_database(small)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["month", "start_mrr", "end_mrr", "nrr_pct"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(name, spark, small, database):
    assert_same(QUERIES[name](spark, small), database, ORACLE_SQL[name])


RAW = (
    "accounts sales_reps products contacts dim_date opportunities opportunity_stage_history "
    "activities subscriptions subscription_monthly_mrr invoices support_tickets"
).split()


@pytest.mark.parametrize("table", RAW)
def test_raw_tables(table, spark, small, database):
    """The derived raw tables are the same rows, types apart from decimals."""
    from revtide import schemas
    from revtide.plans.oracle_sql import _with
    from revtide.plans.queries import _plain
    from revtide.sources.star_schema import RawTables

    df = RawTables(spark, small)[table]
    assert df.schema.simpleString() == schemas.schema(table).simpleString()
    columns = ", ".join(
        f"cast({name} as double) as {name}" if kind.startswith("decimal") else name
        for name, kind in schemas.COLUMNS[table]
    )
    assert_same(_plain(df), database, _with(f"select {columns} from {table}"))
