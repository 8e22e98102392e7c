from datetime import date
from decimal import Decimal

import pytest

from revtide import schemas
from revtide.sources.csv_files import export_csv, has_free_text, load_csv, load_into, read_raw_csv, row_counts

HISTORY = "opp_id,account_id,stage,stage_start_date,stage_end_date\n"
PRODUCTS = "product_id,product_name,product_family,list_price_mrr,is_addon\n"


@pytest.fixture
def csv(tmp_path):
    def write(text, name="t.csv"):
        path = tmp_path / name
        path.write_text(text, encoding="utf-8")
        return str(path)

    return write


def test_quotes_and_null_tokens(spark, csv):
    path = csv(
        PRODUCTS
        + '1,"Seat, ""basic""",NULL,1.005,True\n'
        + "2,null,,NULL,false\n"
        + '3,"",x,12,null\n'
    )
    rows = load_csv(spark, path, "products").orderBy("product_id").collect()
    assert rows[0].product_name == 'Seat, "basic"'
    assert rows[0].product_family is None
    assert rows[0].list_price_mrr == Decimal("1.01")
    assert [r.is_addon for r in rows] == [True, False, None]
    assert rows[1].product_name is None and rows[1].list_price_mrr is None
    assert rows[2].product_name is None


def test_date_marker_only_in_later_tables(spark, csv):
    path = csv(HISTORY + "1,a,NaT,2024-01-05,NaT\n")
    row = load_csv(spark, path, "opportunity_stage_history").first()
    assert (row.stage, row.stage_start_date, row.stage_end_date) == (None, date(2024, 1, 5), None)
    reps = csv("rep_id,rep_name,team,region,email,hire_date\n1,NaT,t,r,e,2020-01-01\n", "r.csv")
    assert load_csv(spark, reps, "sales_reps").first().rep_name == "NaT"


def test_columns_are_taken_by_position(spark, csv):
    path = csv("x,y,z,u,v\n1,name,family,3,true\n")
    assert load_csv(spark, path, "products").first().product_name == "name"


def test_integers_written_with_a_fraction(spark, csv):
    head = ",".join(name for name, _ in schemas.COLUMNS["accounts"]) + "\n"
    path = csv(head + "1,n,s,r,i,2020-01-01,12.0,7,w\n2,n,s,r,i,2020-01-01,NULL,7,w\n")
    rows = load_csv(spark, path, "accounts").orderBy("account_id").collect()
    assert [r.employee_count for r in rows] == [12, None]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "line, problem",
    [
        ("1,a,s,2024-13-05,\n", "not a valid date"),
        ("x" * 51 + ",a,s,2024-01-05,\n", "longer than 50"),
    ],
)
def test_bad_value_aborts(spark, csv, line, problem, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match=problem):
            path = csv(HISTORY + "0,a,s,2024-01-05,\n" + line)
            load_csv(spark, path, "opportunity_stage_history").collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_wrong_field_count_aborts(spark, csv):
    path = csv(HISTORY + "1,a,s\n")
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        read_raw_csv(spark, path, "opportunity_stage_history").select("opp_id").collect()


def test_all_schemas_cover_the_columns():
    for table, columns in schemas.COLUMNS.items():
        assert schemas.schema(table).names == [name for name, _ in columns]
        assert {f.dataType.typeName() for f in schemas.text_schema(table)} == {"string"}


def test_row_counts(spark):
    got = row_counts({"a": spark.range(3), "b": spark.range(0)}).collect()
    assert [tuple(r) for r in got] == [("a", 3), ("b", 0)]


def test_export_round_trip(spark, frame, tmp_path):
    df = frame("k string, v int", [('a,"b"', 1), ("c", None)])
    path = str(tmp_path / "out")
    export_csv(df, path)
    back = spark.read.option("header", True).option("escape", '"').csv(path)
    assert {tuple(r) for r in back.collect()} == {('a,"b"', "1"), ("c", None)}


def test_line_break_in_quotes(spark, csv):
    path = csv(PRODUCTS + '1,"two\nlines",x,1,true\n2,one,y,2,false\n')
    rows = load_csv(spark, path, "products").orderBy("product_id").collect()
    assert [r.product_name for r in rows] == ["two\nlines", "one"]


@pytest.mark.parametrize("text", ["2024", "2024-02", "2024-02-30", "2024-2-3"])
def test_partial_dates_are_refused(spark, csv, text):
    path = csv(HISTORY + f"1,a,x,{text},NaT\n")
    with pytest.raises(Exception, match="not a valid date"):
        load_csv(spark, path, "opportunity_stage_history").collect()


def test_tables_are_loaded_all_or_none(spark, small, tmp_path):
    from revtide.sources.star_schema import RawTables

    spark.sql("create database if not exists load_x")
    source = RawTables(spark, small)
    for table in schemas.LOADED_TABLES:
        export_csv(source[table].limit(20), f"{tmp_path}/{table}.csv")
    last = schemas.LOADED_TABLES[-1]
    (tmp_path / f"{last}.csv" / "part-bad.csv").write_text(",".join(n for n, _ in schemas.COLUMNS[last]) + "\n1,1,1,2020-99-01,2020-01-01,1,x,y,2020-01-01\n")
    with pytest.raises(Exception, match="not a valid date"):
        load_into(spark, str(tmp_path), "load_x.{}".format)
    assert [r.tableName for r in spark.sql("show tables in load_x").collect() if not r.isTemporary] == []
    (tmp_path / f"{last}.csv" / "part-bad.csv").write_text(",".join(n for n, _ in schemas.COLUMNS[last]) + "\n")
    loaded = load_into(spark, str(tmp_path), "load_x.{}".format)
    assert set(loaded) == set(schemas.LOADED_TABLES)
    assert all(df.count() == min(20, source[t].count()) for t, df in loaded.items())
    assert loaded[last].schema.simpleString() == schemas.schema(last).simpleString()


def test_files_without_free_text_are_split(spark, tmp_path):
    assert [t for t in schemas.COLUMNS if not has_free_text(t)] == ["dim_date", "opportunity_stage_history", "subscriptions", "subscription_monthly_mrr", "invoices"]
    (tmp_path / "h.csv").write_text(HISTORY + "".join(f"{k},a,s,2024-01-05,\n" for k in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        df = load_csv(spark, str(tmp_path / "h.csv"), "opportunity_stage_history")
        assert df.rdd.getNumPartitions() > 2 and df.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
