"""Column names, types and text lengths of the raw tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The raw tables a user loads. varchar(n) is a string of at most n
# characters, checked when the table is loaded.
COLUMNS: dict[str, list[tuple[str, str]]] = {
    "accounts": [
        ("account_id", "varchar(50)"),
        ("account_name", "varchar(255)"),
        ("segment", "varchar(50)"),
        ("region", "varchar(50)"),
        ("industry", "varchar(100)"),
        ("created_date", "date"),
        ("employee_count", "int"),
        ("owner_rep_id", "varchar(50)"),
        ("website", "varchar(255)"),
    ],
    "sales_reps": [
        ("rep_id", "varchar(50)"),
        ("rep_name", "varchar(255)"),
        ("team", "varchar(100)"),
        ("region", "varchar(50)"),
        ("email", "varchar(255)"),
        ("hire_date", "date"),
    ],
    "products": [
        ("product_id", "varchar(50)"),
        ("product_name", "varchar(255)"),
        ("product_family", "varchar(100)"),
        ("list_price_mrr", "decimal(10,2)"),
        ("is_addon", "boolean"),
    ],
    "contacts": [
        ("contact_id", "varchar(50)"),
        ("account_id", "varchar(50)"),
        ("first_name", "varchar(100)"),
        ("last_name", "varchar(100)"),
        ("email", "varchar(255)"),
        ("phone", "varchar(50)"),
        ("role", "varchar(150)"),
        ("is_primary", "boolean"),
        ("created_date", "date"),
    ],
    "dim_date": [
        ("date", "date"),
        ("year", "int"),
        ("quarter", "int"),
        ("month", "int"),
        ("month_start", "date"),
        ("week", "int"),
        ("day_of_week", "int"),
        ("is_weekend", "boolean"),
    ],
    "opportunities": [
        ("opp_id", "varchar(50)"),
        ("account_id", "varchar(50)"),
        ("product_id", "varchar(50)"),
        ("rep_id", "varchar(50)"),
        ("created_date", "date"),
        ("close_date", "date"),
        ("current_stage", "varchar(50)"),
        ("probability", "decimal(5,2)"),
        ("forecast_category", "varchar(50)"),
        ("amount", "decimal(18,2)"),
        ("is_closed", "boolean"),
        ("is_won", "boolean"),
        ("loss_reason", "varchar(255)"),
        ("competitor", "varchar(255)"),
    ],
    "opportunity_stage_history": [
        ("opp_id", "varchar(50)"),
        ("account_id", "varchar(50)"),
        ("stage", "varchar(50)"),
        ("stage_start_date", "date"),
        ("stage_end_date", "date"),
    ],
    "activities": [
        ("activity_id", "varchar(50)"),
        ("opp_id", "varchar(50)"),
        ("account_id", "varchar(50)"),
        ("rep_id", "varchar(50)"),
        ("activity_type", "varchar(100)"),
        ("activity_date", "date"),
        ("notes", "varchar(1000)"),
    ],
    "subscriptions": [
        ("subscription_id", "varchar(50)"),
        ("account_id", "varchar(50)"),
        ("product_id", "varchar(50)"),
        ("start_date", "date"),
        ("end_date", "date"),
        ("contract_term_months", "int"),
        ("billing_frequency", "varchar(50)"),
        ("currency", "varchar(10)"),
        ("status", "varchar(50)"),
        ("current_mrr", "decimal(18,2)"),
        ("seat_factor", "decimal(10,2)"),
    ],
    "subscription_monthly_mrr": [
        ("subscription_id", "varchar(50)"),
        ("account_id", "varchar(50)"),
        ("product_id", "varchar(50)"),
        ("month", "date"),
        ("mrr", "decimal(18,2)"),
        ("event_type", "varchar(50)"),
    ],
    "invoices": [
        ("invoice_id", "varchar(50)"),
        ("subscription_id", "varchar(50)"),
        ("account_id", "varchar(50)"),
        ("invoice_date", "date"),
        ("due_date", "date"),
        ("amount", "decimal(18,2)"),
        ("currency", "varchar(10)"),
        ("status", "varchar(50)"),
        ("paid_date", "date"),
    ],
    "support_tickets": [
        ("ticket_id", "varchar(50)"),
        ("account_id", "varchar(50)"),
        ("created_date", "date"),
        ("status", "varchar(50)"),
        ("priority", "varchar(50)"),
        ("category", "varchar(255)"),
        ("subject", "varchar(1000)"),
    ],
}

# Every table above is loaded from a file except the tickets, which may be absent.
LOADED_TABLES = tuple(table for table in COLUMNS if table != "support_tickets")

# Texts read as null. The date marker applies to the tables loaded
# after the first six.
NULL_TOKENS = ("NULL", "null", "")
NULL_TOKENS_WITH_DATE_MARKER = ("NULL", "null", "", "NaT")
TABLES_WITHOUT_DATE_MARKER = (
    "accounts",
    "sales_reps",
    "products",
    "contacts",
    "dim_date",
    "opportunities",
)


def null_tokens(table: str) -> tuple[str, ...]:
    return NULL_TOKENS if table in TABLES_WITHOUT_DATE_MARKER else NULL_TOKENS_WITH_DATE_MARKER


def text_length(kind: str) -> int | None:
    """n of varchar(n), else None."""
    return int(kind[len("varchar(") : -1]) if kind.startswith("varchar(") else None


def spark_type(kind: str) -> T.DataType:
    return T.StringType() if text_length(kind) else T.DataType.fromDDL(kind)


def schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(name, spark_type(kind)) for name, kind in COLUMNS[table]])


def text_schema(table: str) -> T.StructType:
    """The same columns, all as text: what a CSV file holds."""
    return T.StructType([T.StructField(name, T.StringType()) for name, _ in COLUMNS[table]])
