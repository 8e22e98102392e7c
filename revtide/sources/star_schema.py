"""The raw tables derived from a star schema of orders, customers and events.

Each function is one projection or join over Parquet tables, so its work grows with
them. An order is a twelve-month subscription and an opportunity; ``error`` events
are support tickets. ``customer`` joins only ``nation`` and ``region``, whose sizes
are fixed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Full months that the calendar goes on after the month of the last order.
CALENDAR_MONTHS_AFTER = 2
#: A Sunday; weekdays are counted from it.
FIRST_SUNDAY = "1995-01-01"
SUBSCRIPTION_MONTHS = 12

Reader = Callable[[str], DataFrame]


def _key(name: str) -> Column:
    return F.col(name).cast("string")


def _bucket(name: str, modulus: int) -> Column:
    return (F.col(name) % modulus).cast("string")


def _from(first_day: str, days: Column) -> Column:
    return F.date_add(F.lit(first_day).cast("date"), days.cast("int"))


def _money(name: str, kind: str = "decimal(18,2)") -> Column:
    return F.col(name).cast(kind)


def _order_day() -> Column:
    return F.col("o_orderdate").cast("date")


def _with_region(df: DataFrame, read: Reader, nation_key: str) -> DataFrame:
    nations = read("nation").join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return df.join(F.broadcast(nations), F.col(nation_key) == F.col("n_nationkey"))


def accounts(read: Reader) -> DataFrame:
    key = F.col("c_custkey")
    return _with_region(read("customer"), read, "c_nationkey").select(
        _key("c_custkey").alias("account_id"),
        F.col("c_name").alias("account_name"),
        F.when(key % 50 != 0, F.col("c_mktsegment")).alias("segment"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("industry"),
        _from("1995-01-01", key % 365).alias("created_date"),
        (key % 5000).cast("int").alias("employee_count"),
        F.when(key % 40 != 0, _bucket("c_custkey", 10)).alias("owner_rep_id"),
        F.col("c_name").alias("website"),
    )


def sales_reps(read: Reader) -> DataFrame:
    return _with_region(read("supplier"), read, "s_nationkey").select(
        _key("s_suppkey").alias("rep_id"),
        F.col("s_name").alias("rep_name"),
        F.col("n_name").alias("team"),
        F.col("r_name").alias("region"),
        F.col("s_name").alias("email"),
        _from("1994-01-01", F.col("s_suppkey") % 365).alias("hire_date"),
    )


def products(read: Reader) -> DataFrame:
    return read("part").select(
        _key("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("product_family"),
        _money("p_retailprice", "decimal(10,2)").alias("list_price_mrr"),
        (F.col("p_size") % 2 == 1).alias("is_addon"),
    )


def contacts(read: Reader) -> DataFrame:
    named = [
        F.col("c_name").alias(c) for c in ("first_name", "last_name", "email", "phone")
    ]
    return read("customer").select(
        _key("c_custkey").alias("contact_id"),
        _key("c_custkey").alias("account_id"),
        *named,
        F.col("c_mktsegment").alias("role"),
        (F.col("c_custkey") % 2 == 0).alias("is_primary"),
        _from("1995-01-01", F.col("c_custkey") % 365).alias("created_date"),
    )


def order_months(read: Reader) -> DataFrame:
    """(month, has_revenue): first and last month of the orders, and the calendar's last.

    As a month index it has the same bounds as that of the dense fact, but for
    orders it reads their day alone.
    """
    seen = read("orders").agg(F.min(_order_day()).alias("first"), F.max(_order_day()).alias("last"))
    after = F.add_months(F.trunc("last", "MM"), CALENDAR_MONTHS_AFTER)
    ends = ((F.trunc("first", "MM"), True), (F.trunc("last", "MM"), True), (after, False))
    rows = F.array(*(F.struct(day.alias("month"), F.lit(paid).alias("has_revenue")) for day, paid in ends))
    return seen.select(F.inline(rows)).where("month is not null")


def dim_date(read: Reader) -> DataFrame:
    """Every day from the first order's month to the second month after the last order's."""
    seen = read("orders").agg(F.min(_order_day()).alias("first"), F.max(_order_day()).alias("last"))
    last = F.last_day(F.add_months("last", CALENDAR_MONTHS_AFTER))
    days = seen.select(F.explode(F.sequence(F.trunc("first", "MM"), last)).alias("date"))
    weekday = F.pmod(F.datediff("date", F.lit(FIRST_SUNDAY).cast("date")), F.lit(7))
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.trunc("date", "MM").alias("month_start"),
        F.weekofyear("date").alias("week"),
        weekday.alias("day_of_week"),
        weekday.isin(0, 6).alias("is_weekend"),
    )


def opportunities(read: Reader) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    order = F.col("o_orderkey")
    open_stage = F.element_at(
        F.array(*map(F.lit, ("Prospecting", "Qualification", "Proposal", "Negotiation"))),
        (order % 4 + 1).cast("int"),
    )
    odds = F.lit("0.10")
    for name, value in (
        ("4-NOT SPECIFIED", "0.30"),
        ("3-MEDIUM", "0.50"),
        ("2-HIGH", "0.70"),
        ("1-URGENT", "0.90"),
    ):
        odds = F.when(priority == name, value).otherwise(odds)
    return read("orders").select(
        _key("o_orderkey").alias("opp_id"),
        _key("o_custkey").alias("account_id"),
        _bucket("o_orderkey", 200).alias("product_id"),
        _bucket("o_orderkey", 10).alias("rep_id"),
        _order_day().alias("created_date"),
        F.when(status != "O", F.date_add(_order_day(), (order % 120).cast("int"))).alias("close_date"),
        F.when(status == "F", "Closed Won")
        .when(status == "P", "Closed Lost")
        .otherwise(open_stage)
        .alias("current_stage"),
        odds.cast("decimal(5,2)").alias("probability"),
        F.when(priority.isin("1-URGENT", "2-HIGH"), "Commit")
        .otherwise("Pipeline")
        .alias("forecast_category"),
        _money("o_totalprice").alias("amount"),
        (status != "O").alias("is_closed"),
        (status == "F").alias("is_won"),
        F.when(status == "P", "Price").alias("loss_reason"),
        F.lit(None).cast("string").alias("competitor"),
    )


def opportunity_stage_history(read: Reader) -> DataFrame:
    """Up to five stages per order; the end of one is the start of the next.

    The steps of an order follow from its own key, so the next start is found inside
    the row's array and nothing is shuffled.
    """
    order = F.col("o_orderkey")
    names = F.array(*map(F.lit, ("Prospecting", "Qualification", "Proposal", "Negotiation", "Closed")))
    steps = F.filter(
        F.sequence(F.lit(1), F.lit(5)), lambda i: (i <= 1 + order % 5) & ((order + i) % 7 != 0)
    )

    def start_of(step: Column) -> Column:
        return F.date_add(_order_day(), (step * (3 + order % 9)).cast("int"))

    return (
        read("orders")
        .select(
            _key("o_orderkey").alias("opp_id"),
            _key("o_custkey").alias("account_id"),
            "o_orderkey",
            "o_orderdate",
            steps.alias("steps"),
        )
        .select("*", F.posexplode("steps").alias("at", "step"))
        .select(
            "opp_id",
            "account_id",
            F.element_at(names, F.col("step")).alias("stage"),
            start_of(F.col("step")).alias("stage_start_date"),
            start_of(F.get("steps", F.col("at") + 1)).alias("stage_end_date"),
        )
    )


def activities(read: Reader) -> DataFrame:
    return (
        read("events")
        .where("event_type <> 'error'")
        .select(
            _key("event_id").alias("activity_id"),
            _key("event_id").alias("opp_id"),
            _key("user_id").alias("account_id"),
            _bucket("user_id", 10).alias("rep_id"),
            F.col("event_type").alias("activity_type"),
            F.col("ts").cast("date").alias("activity_date"),
            F.col("props").alias("notes"),
        )
    )


def subscriptions(read: Reader) -> DataFrame:
    return read("orders").select(
        _key("o_orderkey").alias("subscription_id"),
        _key("o_custkey").alias("account_id"),
        _bucket("o_orderkey", 200).alias("product_id"),
        _order_day().alias("start_date"),
        F.date_add(_order_day(), 365).alias("end_date"),
        F.lit(SUBSCRIPTION_MONTHS).alias("contract_term_months"),
        F.lit("monthly").alias("billing_frequency"),
        F.lit("USD").alias("currency"),
        F.col("o_orderstatus").alias("status"),
        _money("o_totalprice").alias("current_mrr"),
        F.lit(1).cast("decimal(10,2)").alias("seat_factor"),
    )


def subscription_monthly_mrr(read: Reader) -> DataFrame:
    """Twelve months per order, as far as orders go.

    Keys and money are converted before a row is multiplied by its months.
    """
    orders = read("orders")
    last_day = orders.agg(F.max(_order_day())).scalar()
    months = F.sequence(F.lit(0), F.lit(SUBSCRIPTION_MONTHS - 1))
    return (
        orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
        .select(
            _key("o_orderkey").alias("subscription_id"),
            _key("o_custkey").alias("account_id"),
            _bucket("o_orderkey", 200).alias("product_id"),
            F.trunc(_order_day(), "MM").alias("first_month"),
            _money("o_totalprice").alias("mrr"),
        )
        .select("*", F.explode(months).alias("n"))
        .select(
            "subscription_id",
            "account_id",
            "product_id",
            F.add_months("first_month", F.col("n")).alias("month"),
            "mrr",
            F.when(F.col("n") == 0, "new").otherwise("renewal").alias("event_type"),
        )
        .where(F.col("month") <= last_day)
    )


def invoices(read: Reader) -> DataFrame:
    return read("orders").select(
        _key("o_orderkey").alias("invoice_id"),
        _key("o_orderkey").alias("subscription_id"),
        _key("o_custkey").alias("account_id"),
        _order_day().alias("invoice_date"),
        F.date_add(_order_day(), 30).alias("due_date"),
        _money("o_totalprice").alias("amount"),
        F.lit("USD").alias("currency"),
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderstatus") == "F", F.date_add(_order_day(), 15)).alias("paid_date"),
    )


def support_tickets(read: Reader) -> DataFrame:
    return (
        read("events")
        .where("event_type = 'error'")
        .select(
            _key("event_id").alias("ticket_id"),
            _key("user_id").alias("account_id"),
            _from("2001-04-01", (F.dayofmonth("ts") - 1) * 7).alias("created_date"),
            F.lit("open").alias("status"),
            F.when(F.col("value") > 10, "high").otherwise("low").alias("priority"),
            F.col("event_type").alias("category"),
            F.col("props").alias("subject"),
        )
    )


DERIVED: dict[str, Callable[[Reader], DataFrame]] = {
    "accounts": accounts,
    "sales_reps": sales_reps,
    "products": products,
    "contacts": contacts,
    "dim_date": dim_date,
    "opportunities": opportunities,
    "opportunity_stage_history": opportunity_stage_history,
    "activities": activities,
    "subscriptions": subscriptions,
    "subscription_monthly_mrr": subscription_monthly_mrr,
    "invoices": invoices,
    "support_tickets": support_tickets,
}


class RawTables:
    """The raw tables by name, each declared on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._declared: dict[str, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        return self._once(
            f"source {name}", lambda: self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        )

    def __getitem__(self, table: str) -> DataFrame:
        return self._once(table, lambda: DERIVED[table](self.source))

    def _once(self, name: str, declare: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._declared:
            self._declared[name] = declare()
        return self._declared[name]
