"""The tables a metric reads, dimension filters, and plain lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtide.functions.periods import in_months

# The month range shown when no revenue is loaded starts here.
FALLBACK_FIRST_MONTH = date(2023, 1, 1)


@dataclass(frozen=True)
class Context:
    """Frames the filterable metrics read; the last six may be absent.

    ``months`` is the month index (see ``month_index``) of a dense ``mrr``, where every
    account has a row in every month; ``by_account`` holds the rows of ``mrr`` laid out by
    account. Both only change how a metric reads, never its result.
    """

    mrr: DataFrame
    pipeline: DataFrame
    accounts: DataFrame
    reps: DataFrame | None = None
    history: DataFrame | None = None
    tickets: DataFrame | None = None
    health: DataFrame | None = None
    months: DataFrame | None = None
    by_account: DataFrame | None = None


@dataclass(frozen=True)
class MonthRange:
    """Loaded months: the first, the last with revenue, and the last of the calendar."""

    start: date
    end: date
    boundary: date


@dataclass(frozen=True)
class DimFilter:
    """Selected dimension values; an empty selection selects everything.

    A row passes when each non-empty selection holds its value, so a null dimension
    passes only where nothing is selected. Rep selections need a rep and therefore
    drop rows without one. ``account_id`` is expected to be unique in accounts and
    ``rep_id`` in reps.
    """

    segments: Sequence[str] = ()
    regions: Sequence[str] = ()
    industries: Sequence[str] = ()
    rep_teams: Sequence[str] = ()
    rep_regions: Sequence[str] = ()

    def by_rep(self, reps: DataFrame | None) -> bool:
        """Without a reps table the rep selections have no effect."""
        return reps is not None and bool(self.rep_teams or self.rep_regions)

    def link_columns(self, reps: DataFrame | None, rep_key: str) -> list[str]:
        """The fact's columns that ``apply`` joins on."""
        return ["account_id"] + (["rep_id"] if self.by_rep(reps) and rep_key == "rep_id" else [])

    def apply(
        self,
        df: DataFrame,
        accounts: DataFrame,
        reps: DataFrame | None = None,
        rep_key: str = "owner_rep_id",
    ) -> DataFrame:
        """Rows of ``df`` whose account, and rep, are selected.

        ``rep_key`` names the role of the rep: ``owner_rep_id`` for the account's
        owner, ``rep_id`` for the fact's own rep. The dimensions are filtered and cut
        to their keys first. Whether they are broadcast is left to the planner, which
        knows their size; if they are, it moves the semi-join below the fact's own
        shuffles, down to its scan.
        """
        if rep_key not in ("owner_rep_id", "rep_id"):
            raise ValueError(f"unknown rep key: {rep_key!r}")
        selected = _selection(
            accounts,
            {"segment": self.segments, "region": self.regions, "industry": self.industries},
        )
        if self.by_rep(reps):
            team = _selection(reps, {"team": self.rep_teams, "region": self.rep_regions})
            if rep_key == "rep_id":
                df = _having(df, team, "rep_id")
            else:
                owners = team.select(F.col("rep_id").alias("owner_rep_id"))
                selected = _having(selected, owners, "owner_rep_id")
        return _having(df, selected, "account_id")


EVERYTHING = DimFilter()


def _having(df: DataFrame, selected: DataFrame, key: str) -> DataFrame:
    return df.join(selected.select(key), key, "left_semi").select(df.columns)


def _selection(df: DataFrame, wanted: Mapping[str, Sequence[str]]) -> DataFrame:
    for column, values in wanted.items():
        if values:
            df = df.where(F.col(column).isin(list(values)))
    return df


def scoped_mrr(
    ctx: Context,
    start: date,
    end: date,
    filt: DimFilter = EVERYTHING,
    by_account: bool = False,
) -> DataFrame:
    """(account_id, month, total_mrr) of the selected accounts and months.

    A metric that orders each account's rows asks for the fact laid out by account, if
    there is one: its window then needs no shuffle.
    """
    fact = ctx.by_account if by_account and ctx.by_account is not None else ctx.mrr
    months = fact.select("account_id", "month", "total_mrr").where(
        in_months(F.col("month"), start, end)
    )
    return filt.apply(months, ctx.accounts, ctx.reps, "owner_rep_id")


def month_index(fact: DataFrame) -> DataFrame:
    """(month, row_count, has_revenue), one row a month: which months a fact holds."""
    return fact.groupBy("month").agg(
        F.count("*").alias("row_count"),
        F.coalesce(F.max(F.col("total_mrr") > 0), F.lit(False)).alias("has_revenue"),
    )


def indexed_months(index: DataFrame, n: int) -> Column:
    """Scalar struct m0, m1, ...: the n newest months of an index, null where there are fewer.

    It reads one row a month, so a filter by it prunes a fact stored by month without
    reading the fact first.
    """
    months = index.agg(F.reverse(F.array_sort(F.collect_set("month"))).alias("m"))
    picked = (F.get("m", F.lit(k)).alias(f"m{k}") for k in range(n))
    return months.select(F.struct(*picked).alias("newest")).scalar()


def newest_rows(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` newest rows of each account, with their place ``back`` from 1.

    Each task keeps no more than these before anything is shuffled.
    """
    newest_first = Window.partitionBy("account_id").orderBy(F.col("month").desc())
    return rows.withColumn("back", F.row_number().over(newest_first)).where(F.col("back") <= n)


def newest_month(rows: DataFrame) -> Column:
    """Scalar: the last month among ``rows`` of (account_id, month, total_mrr).

    It reads the same columns as the query around it. When the fact is still a plan,
    both then share one shuffle, instead of computing the fact twice.
    """
    return rows.agg(F.max(F.struct("month", "total_mrr"))["month"]).scalar()


def scoped_sums(
    facts: DataFrame,
    ctx: Context,
    filt: DimFilter,
    keys: Sequence[str],
    sums: Mapping[str, Column],
    rep_key: str = "rep_id",
) -> DataFrame:
    """Sums by ``keys`` over the selected accounts and reps.

    Facts are first summed per account (and rep), on the map side too, so the join on
    account_id meets one row per account and key however many facts an account has.
    """
    links = filt.link_columns(ctx.reps, rep_key)
    per_account = facts.groupBy(*links, *keys).agg(
        *(F.sum(col).alias(name) for name, col in sums.items())
    )
    scoped = filt.apply(per_account, ctx.accounts, ctx.reps, rep_key)
    return scoped.groupBy(*keys).agg(*(F.sum(name).alias(name) for name in sums))


def filter_domains(accounts: DataFrame, reps: DataFrame | None = None) -> DataFrame:
    """(dimension, value): the values each filter can take, sorted."""
    domains = _long(accounts, {"segment": "segment", "region": "region", "industry": "industry"})
    if reps is not None:
        domains = domains.unionAll(_long(reps, {"team": "rep_team", "region": "rep_region"}))
    return domains.orderBy("dimension", "value")


def _long(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    wide = df.select(*(F.col(column).alias(name) for column, name in names.items()))
    return wide.unpivot([], list(names.values()), "dimension", "value").dropna().distinct()


def month_bounds(mrr: DataFrame, today: date) -> DataFrame:
    """(min_month, max_month), or the fallback range when there is no month."""
    seen = mrr.agg(F.min("month").alias("first"), F.max("month").alias("last"))
    return seen.select(
        F.coalesce("first", F.lit(FALLBACK_FIRST_MONTH)).alias("min_month"),
        F.coalesce("last", F.lit(today)).alias("max_month"),
    )


def loaded_range(months: DataFrame, today: date) -> MonthRange:
    """The range to show when none is chosen, from a month index; one row is read at once.

    A stored index (``fct_mrr_complete_months``) has one row a month, so the fact itself
    is not read. Without months the fallback range holds, and without revenue the end is the
    last month.
    """
    paid = F.max(F.when(F.col("has_revenue"), F.col("month")))
    seen = months.agg(F.min("month").alias("start"), paid.alias("end"), F.max("month").alias("boundary")).first()
    if seen.start is None:
        return MonthRange(FALLBACK_FIRST_MONTH, today, today)
    return MonthRange(seen.start, seen.end or seen.boundary, seen.boundary)


def account_directory(accounts: DataFrame) -> DataFrame:
    """Accounts with a label to pick them by."""
    name = F.coalesce("account_name", F.lit(""))
    return accounts.select(
        "account_id",
        name.alias("account_name"),
        "segment",
        "region",
        "industry",
        "owner_rep_id",
        "website",
        F.concat(name, F.lit(" ("), F.col("account_id"), F.lit(")")).alias("label"),
    )


def account_mrr(
    ctx: Context,
    start: date,
    end: date,
    filt: DimFilter = EVERYTHING,
    account_id: str | None = None,
) -> DataFrame:
    """Monthly revenue by account; of one account, in the order of months."""
    rows = scoped_mrr(ctx, start, end, filt).select(
        "account_id", "month", F.round("total_mrr", 2).alias("total_mrr")
    )
    return rows if account_id is None else rows.where(F.col("account_id") == account_id).orderBy("month")


def _latest(df: DataFrame, account_id: str, key: str, columns: Sequence[str], n: int | None) -> DataFrame:
    newest_first = F.col("created_date").desc_nulls_first()
    rows = df.where(F.col("account_id") == account_id).select(*columns).orderBy(newest_first, F.col(key))
    return rows if n is None else rows.limit(n)


def account_opportunities(pipe: DataFrame, account_id: str, n: int | None = None) -> DataFrame:
    """The account's opportunities, newest first, all or n of them; equal dates are ordered by opp_id."""
    columns = (
        "opp_id",
        "created_date",
        "close_date",
        "current_stage",
        "probability",
        "amount",
        "is_closed",
        "is_won",
    )
    return _latest(pipe, account_id, "opp_id", columns, n)


def account_tickets(tickets: DataFrame, account_id: str, n: int | None = None) -> DataFrame:
    """The account's support tickets, newest first, all or n of them; equal dates are ordered by ticket_id."""
    columns = ("ticket_id", "created_date", "status", "priority", "category", "subject")
    return _latest(tickets, account_id, "ticket_id", columns, n)
