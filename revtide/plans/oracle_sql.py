"""The registered queries once more, as SQL for a second engine.

Written apart from the DataFrame code and, where that is possible, by another route:
money is counted in whole cents, ratios are rounded with integer arithmetic, and
previous or next months are found by self-joins instead of window functions.
"""

from __future__ import annotations

import re
from datetime import date

from revtide.operators.evidence import GROUNDING_RULE, PIPELINE_RULE, RETENTION_RULE
from revtide.plans import queries as q
from revtide.schemas import LOADED_TABLES

# The raw tables, derived from the star schema.
RAW_TABLES: dict[str, str] = {
    "accounts": """
select cast(c_custkey as varchar(50)) as account_id, c_name as account_name,
  case when c_custkey % 50 = 0 then null else c_mktsegment end as segment,
  r_name as region, n_name as industry,
  date '1995-01-01' + cast(c_custkey % 365 as int) as created_date,
  cast(c_custkey % 5000 as int) as employee_count,
  case when c_custkey % 40 = 0 then null else cast(c_custkey % 10 as varchar(50)) end as owner_rep_id,
  c_name as website
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
""",
    "sales_reps": """
select cast(s_suppkey as varchar(50)) as rep_id, s_name as rep_name, n_name as team,
  r_name as region, s_name as email,
  date '1994-01-01' + cast(s_suppkey % 365 as int) as hire_date
from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
""",
    "products": """
select cast(p_partkey as varchar(50)) as product_id, p_name as product_name,
  p_brand as product_family, cast(p_retailprice as decimal(10,2)) as list_price_mrr,
  p_size % 2 = 1 as is_addon
from part
""",
    "contacts": """
select cast(c_custkey as varchar(50)) as contact_id, cast(c_custkey as varchar(50)) as account_id,
  c_name as first_name, c_name as last_name, c_name as email, c_name as phone,
  c_mktsegment as role, c_custkey % 2 = 0 as is_primary,
  date '1995-01-01' + cast(c_custkey % 365 as int) as created_date
from customer
""",
    "dim_date": """
with o as (select min(cast(o_orderdate as date)) as lo, max(cast(o_orderdate as date)) as hi from orders),
g as (select cast(unnest(generate_series(date_trunc('month', lo), cast(last_day(hi + interval 2 month) as timestamp), interval 1 day)) as date) as date from o),
x as (select date, date_diff('day', date '1995-01-01', date) as n from g)
select date, cast(year(date) as int) as year, cast(quarter(date) as int) as quarter,
  cast(month(date) as int) as month,
  make_date(cast(year(date) as int), cast(month(date) as int), 1) as month_start,
  cast(weekofyear(date) as int) as week, cast(n % 7 as int) as day_of_week,
  n % 7 in (0, 6) as is_weekend
from x
""",
    "opportunities": """
select cast(o_orderkey as varchar(50)) as opp_id, cast(o_custkey as varchar(50)) as account_id,
  cast(o_orderkey % 200 as varchar(50)) as product_id, cast(o_orderkey % 10 as varchar(50)) as rep_id,
  cast(o_orderdate as date) as created_date,
  case when o_orderstatus = 'O' then null
       else cast(o_orderdate as date) + cast(o_orderkey % 120 as int) end as close_date,
  case o_orderstatus when 'F' then 'Closed Won' when 'P' then 'Closed Lost'
       else case cast(o_orderkey % 4 as int) when 0 then 'Prospecting' when 1 then 'Qualification'
            when 2 then 'Proposal' else 'Negotiation' end end as current_stage,
  cast(case o_orderpriority when '1-URGENT' then 0.90 when '2-HIGH' then 0.70 when '3-MEDIUM' then 0.50
       when '4-NOT SPECIFIED' then 0.30 else 0.10 end as decimal(5,2)) as probability,
  case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'Commit' else 'Pipeline' end as forecast_category,
  cast(o_totalprice as decimal(18,2)) as amount,
  o_orderstatus <> 'O' as is_closed, o_orderstatus = 'F' as is_won,
  case when o_orderstatus = 'P' then 'Price' end as loss_reason,
  cast(null as varchar(255)) as competitor
from orders
""",
    "opportunity_stage_history": """
with st as (select * from (values (1,'Prospecting'),(2,'Qualification'),(3,'Proposal'),(4,'Negotiation'),(5,'Closed')) t(i, stage)),
r as (select cast(o_orderkey as varchar(50)) as opp_id, cast(o_custkey as varchar(50)) as account_id, stage,
    cast(o_orderdate as date) + cast(i * (3 + o_orderkey % 9) as int) as stage_start_date
  from orders cross join st
  where i <= 1 + o_orderkey % 5 and (o_orderkey + i) % 7 <> 0)
select opp_id, account_id, stage, stage_start_date,
  lead(stage_start_date) over (partition by opp_id order by stage_start_date) as stage_end_date
from r
""",
    "activities": """
select cast(event_id as varchar(50)) as activity_id, cast(event_id as varchar(50)) as opp_id,
  cast(user_id as varchar(50)) as account_id, cast(user_id % 10 as varchar(50)) as rep_id,
  event_type as activity_type, cast(ts as date) as activity_date, props as notes
from events where event_type <> 'error'
""",
    "subscriptions": """
select cast(o_orderkey as varchar(50)) as subscription_id, cast(o_custkey as varchar(50)) as account_id,
  cast(o_orderkey % 200 as varchar(50)) as product_id, cast(o_orderdate as date) as start_date,
  cast(o_orderdate as date) + 365 as end_date, 12 as contract_term_months,
  'monthly' as billing_frequency, 'USD' as currency, o_orderstatus as status,
  cast(o_totalprice as decimal(18,2)) as current_mrr, cast(1 as decimal(10,2)) as seat_factor
from orders
""",
    "subscription_monthly_mrr": """
with k as (select * from (values (0),(1),(2),(3),(4),(5),(6),(7),(8),(9),(10),(11)) t(n)),
x as (select o_orderkey, o_custkey, o_totalprice, n,
    year(o_orderdate) * 12 + month(o_orderdate) - 1 + n as tm
  from orders cross join k),
y as (select cast(o_orderkey as varchar(50)) as subscription_id, cast(o_custkey as varchar(50)) as account_id,
    cast(o_orderkey % 200 as varchar(50)) as product_id,
    make_date(cast(floor(tm / 12) as int), cast(tm % 12 as int) + 1, 1) as month,
    cast(o_totalprice as decimal(18,2)) as mrr,
    case when n = 0 then 'new' else 'renewal' end as event_type
  from x)
select * from y where month <= (select max(cast(o_orderdate as date)) from orders)
""",
    "invoices": """
select cast(o_orderkey as varchar(50)) as invoice_id, cast(o_orderkey as varchar(50)) as subscription_id,
  cast(o_custkey as varchar(50)) as account_id, cast(o_orderdate as date) as invoice_date,
  cast(o_orderdate as date) + 30 as due_date, cast(o_totalprice as decimal(18,2)) as amount,
  'USD' as currency, o_orderstatus as status,
  case when o_orderstatus = 'F' then cast(o_orderdate as date) + 15 end as paid_date
from orders
""",
    "support_tickets": """
select cast(event_id as varchar(50)) as ticket_id, cast(user_id as varchar(50)) as account_id,
  date '2001-04-01' + cast(7 * (day(ts) - 1) as int) as created_date,
  'open' as status, case when value > 10 then 'high' else 'low' end as priority,
  event_type as category, props as subject
from events where event_type = 'error'
""",
}


def _round(num: str, den: str, digits: int = 2, factor: int = 1) -> str:
    """round(factor * num / den, digits), half away from zero, of whole numbers."""
    scale = 10**digits
    top = f"{2 * scale * factor} * abs(cast({num} as hugeint)) + abs(cast({den} as hugeint))"
    whole = f"({top}) // (2 * abs(cast({den} as hugeint)))"
    sign = f"(case when cast({num} as hugeint) < 0 then -1 else 1 end)"
    return (
        f"(case when {den} = 0 then null else cast({sign} * ({whole}) as double) / {scale} end)"
    )


def _pct(num: str, den: str) -> str:
    return _round(num, den, 2, 100)


def _money(cents: str) -> str:
    return f"(cast({cents} as double) / 100)"


def _day(d: date | str) -> str:
    return d if isinstance(d, str) else f"date '{d.isoformat()}'"


def _order_month(end: str, later: int) -> str:
    """A month counted from that of the first or the last order."""
    day = f"date_trunc('month', {end}(cast(o_orderdate as date)))"
    return f"(select cast({day} + interval ({later}) month as date) from orders)"


# The loaded months: the first, the last with revenue, the one before it, and the calendar's last.
START, END = _order_month("min", 0), _order_month("max", 0)
COHORT, BOUNDARY_END = _order_month("max", -1), _order_month("max", 2)


def _in(column: str, values) -> str:
    listed = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"{column} in ({listed})" if values else "true"


def _accounts_passing(f: q.DimFilter) -> str:
    """Account ids passing account dimensions and the owner's dimensions."""
    return (
        "select a.account_id from accounts a left join sales_reps r on r.rep_id = a.owner_rep_id"
        f" where {_in('a.segment', f.segments)} and {_in('a.region', f.regions)}"
        f" and {_in('a.industry', f.industries)} and {_in('r.team', f.rep_teams)}"
        f" and {_in('r.region', f.rep_regions)}"
    )


def _deal_passes(f: q.DimFilter) -> str:
    """A deal d passes account dimensions and the dimensions of its own rep."""
    rep = (
        f"d.rep_id in (select rep_id from sales_reps where {_in('team', f.rep_teams)}"
        f" and {_in('region', f.rep_regions)})"
        if f.rep_teams or f.rep_regions
        else "true"
    )
    return (
        f"d.account_id in (select account_id from accounts where {_in('segment', f.segments)}"
        f" and {_in('region', f.regions)} and {_in('industry', f.industries)}) and {rep}"
    )


def _scope(start: date | str, end: date | str, f: q.DimFilter = q.filters.EVERYTHING) -> str:
    return (
        f"(select account_id, month, c from dense where month >= {_day(start)} and"
        f" month <= {_day(end)} and account_id in ({_accounts_passing(f)}))"
    )


# Steps shared by several queries. Cents are whole numbers: c now, p one month before.
SHARED: dict[str, str] = {
    "mrr_cents": """
select account_id, month, sum(cast(mrr * 100 as bigint)) as c
from subscription_monthly_mrr group by account_id, month
""",
    "cal": """
select m.month, (select max(month_start) from dim_date where month_start < m.month) as prior
from (select distinct month_start as month from dim_date) m
""",
    "dense": """
select g.account_id, g.month, coalesce(x.c, 0) as c, coalesce(y.c, 0) as p
from (select account_id, month, prior from (select distinct account_id from accounts), cal) g
left join mrr_cents x on x.account_id = g.account_id and x.month = g.month
left join mrr_cents y on y.account_id = g.account_id and y.month = g.prior
""",
    "revenue_end": "select max(month) as month from dense where c > 0",
    "deals": f"""
select opp_id, account_id, product_id, rep_id, created_date, close_date, current_stage,
  probability, is_closed, is_won, cast(amount * 100 as bigint) as a,
  cast(amount * 100 as bigint) * cast(probability * 100 as bigint) as w,
  cast(date_trunc('month', close_date) as date) as close_month,
  cast(case when is_closed then date_diff('day', created_date, close_date) end as int) as cycle,
  cast(case when not is_closed then date_diff('day', created_date, {_day(q.AS_OF)}) end as int) as age
from opportunities
""",
    "closed_months": """
select close_month, sum(a) as a, sum(a) filter (where is_won) as won_a, count(*) as n,
  count(*) filter (where is_won) as won_n, sum(cycle) as days, count(cycle) as day_n
from deals where is_closed group by close_month
""",
    "steps": """
select opp_id, account_id, stage, stage_start_date, stage_end_date, row_number() over (
    partition by opp_id
    order by stage_start_date, stage_end_date nulls last, stage) as pos
from opportunity_stage_history
""",
}


def _with(body: str) -> str:
    """Put the named steps that ``body`` needs in front of it."""
    steps = {**RAW_TABLES, **SHARED}
    needed: set[str] = set()
    todo = [body]
    while todo:
        text = todo.pop()
        for name in steps:
            if name not in needed and re.search(rf"(?:from|join|,)\s+{name}\b", text):
                needed.add(name)
                todo.append(steps[name])
    ctes = ",\n".join(f"{n} as ({steps[n].strip()})" for n in steps if n in needed)
    return f"with {ctes}\n{body.strip()}" if ctes else body.strip()


def _movement(now: str, before: str, rule: str) -> str:
    """Class names by sign; ``before`` is null without a predecessor in the app rule."""
    if rule == "mart":
        return (
            f"case when {before} = 0 and {now} > 0 then 'New'"
            f" when {before} > 0 and {now} = 0 then 'Churn' when {now} > {before} then 'Expansion'"
            f" when {now} > 0 and {now} < {before} then 'Contraction' else 'Flat' end"
        )
    return (
        f"case when {before} is null then case when {now} > 0 then 'New' else 'Flat' end"
        f" when {now} = 0 and {before} > 0 then 'Churn'"
        f" else case sign({now} - {before}) when 1 then 'Expansion' when -1 then 'Contraction'"
        f" else 'Flat' end end"
    )


def _retention(start: date | str, end: date | str, f: q.DimFilter = q.filters.EVERYTHING) -> str:
    scope = _scope(start, end, f)
    return f"""
select month, {_money('s')} as start_mrr, {_money('e')} as end_mrr, {_money('k')} as retained_mrr,
  {_pct('e', 's')} as nrr_pct, {_pct('k', 's')} as grr_pct
from (select t.month, sum(t.c) as s, sum(coalesce(u.c, 0)) as e,
    sum(case when coalesce(u.c, 0) < t.c then coalesce(u.c, 0) else t.c end) as k
  from {scope} t left join {scope} u
    on u.account_id = t.account_id and u.month = cast(t.month + interval 1 month as date)
  where t.c > 0 and t.month < (select max(month) from {scope}) group by t.month)
"""


def _closed_series(start: date | str, end: date | str, f: q.DimFilter = q.filters.EVERYTHING) -> str:
    return f"""
select close_month, {_money('a')} as total_closed_revenue,
  {_money('coalesce(won_a, 0)')} as total_won_revenue,
  {_pct('won_n', 'n')} as win_rate_pct, {_round('days', 'n')} as avg_sales_cycle_days
from (select close_month, sum(a) as a, sum(a) filter (where is_won) as won_a, count(*) as n,
    count(*) filter (where is_won) as won_n, sum(cycle) as days
  from deals d
  where is_closed and close_month >= {_day(start)} and close_month <= {_day(end)}
    and {_deal_passes(f)} group by close_month)
"""


def _coverage(start: date | str, end: date | str, f: q.DimFilter = q.filters.EVERYTHING) -> str:
    return f"""
select {_money('o')} as total_open_pipeline,
  cast(s as double) / 100 / n as avg_3m_closed_revenue,
  {_round('o * n', 's')} as pipeline_coverage_ratio
from (select
    (select sum(a) from deals d where not is_closed and {_deal_passes(f)}) as o, sum(a) as s,
    count(*) as n
  from (select close_month, sum(a) as a from deals d
    where is_closed and close_month >= {_day(start)} and close_month <= {_day(end)}
      and {_deal_passes(f)} group by close_month
    order by close_month desc limit 3))
"""


def _by_stage(f: q.DimFilter = q.filters.EVERYTHING) -> str:
    return f"""
select current_stage, {_money('sum(a)')} as open_pipeline,
  {_round('sum(w)', '10000')} as weighted_pipeline, count(*) as opp_count
from deals d where not is_closed and {_deal_passes(f)} group by current_stage
"""


def _arr(start: date | str, end: date | str, f: q.DimFilter = q.filters.EVERYTHING) -> str:
    return f"""
select month, {_money('sum(c) * 12')} as total_arr from {_scope(start, end, f)} group by month
"""


def _summary(start: date | str, end: date | str, f: q.DimFilter = q.filters.EVERYTHING) -> str:
    return f"""
select movement_type, count(*) as rows_count, {_money('sum(c - coalesce(b, 0))')} as net_mrr_change
from (select c, b, {_movement('c', 'b', 'app')} as movement_type
  from (select c, lag(c) over (partition by account_id order by month) as b
    from {_scope(start, end, f)}))
group by movement_type
"""


def _movers(start: date | str, end: date | str, order: str) -> str:
    scope = _scope(start, end)
    return f"""
select s.account_id, {_money('s.c')} as mrr_curr, {_money('s.b')} as mrr_prev,
  {_money('s.c - s.b')} as mrr_delta, a.account_name, a.segment, a.region, a.industry
from (select x.account_id, coalesce(t.c, 0) as c, coalesce(u.c, 0) as b
  from accounts x
  left join (select account_id, c from {scope} where month = (select max(month) from {scope})) t
    on t.account_id = x.account_id
  left join (select account_id, c from {scope}
      where month = (select cast(max(month) - interval 1 month as date) from {scope})) u
    on u.account_id = x.account_id
  where t.account_id is not null or u.account_id is not null) s
join accounts a on a.account_id = s.account_id
order by s.c - s.b {order}, s.account_id limit 10
"""


def _health(start: date | str, end: date | str) -> str:
    scope = _scope(start, end)
    newest = f"(select max(month) from {scope})"
    return f"""
select account_id, account_name, segment, region, industry, {_money('c')} as total_mrr,
  {_money('b')} as prev_mrr, {_round('c - b', 'b', 4)} as mom_mrr_pct,
  {_round('three', 'n * 100')} as mrr_avg_3m, t as ticket_cnt_90d,
  cast(greatest(0, least(100, 70 + 15 * sign(c - b)
    - case when c = 0 and b > 0 then 50 else 0 end
    - case when t >= 8 then 20 when t >= 4 then 10 else 0 end)) as int) as health_score,
  case when c = 0 then case when b > 0 then 'Lost' else 'Stable' end
    when t >= 8 then 'High Risk'
    else case sign(c - b) when -1 then 'At Risk' when 1 then 'Growing' else 'Stable' end
  end as health_status
from (select a.*, m.c, coalesce(m1.c, 0) as b,
    m.c + coalesce(m1.c, 0) + coalesce(m2.c, 0) as three,
    1 + (m1.c is not null)::int + (m2.c is not null)::int as n,
    (select count(*) from support_tickets k where k.account_id = a.account_id
       and k.created_date >= {newest} - 90) as t
  from accounts a
  join (select account_id, c from {scope} where month = {newest}) m
    on m.account_id = a.account_id
  left join (select account_id, c from {scope}
      where month = cast({newest} - interval 1 month as date)) m1 on m1.account_id = a.account_id
  left join (select account_id, c from {scope}
      where month = cast({newest} - interval 2 month as date)) m2 on m2.account_id = a.account_id)
"""


def _stage_days(f: q.DimFilter = q.filters.EVERYTHING) -> str:
    return f"""
select stage, count(distinct opp_id) as deals_reached_stage,
  {_round('sum(stage_end_date - stage_start_date)', 'count(*)')} as avg_stage_duration_days
from opportunity_stage_history
where stage_end_date is not null and account_id in ({_accounts_passing(f)})
group by stage
"""


def _stage_moves(f: q.DimFilter = q.filters.EVERYTHING) -> str:
    passing = _accounts_passing(f)
    return f"""
select m.from_stage, m.to_stage, m.n as deals_progressed, i.n as deals_in_stage,
  {_pct('m.n', 'i.n')} as conversion_rate_pct
from (select s.stage as from_stage, t.stage as to_stage, count(*) as n
    from steps s join steps t on t.opp_id = s.opp_id and t.pos = s.pos + 1
    where s.account_id in ({passing}) group by all) m
join (select stage, count(distinct opp_id) as n from opportunity_stage_history
    where account_id in ({passing}) group by stage) i on i.stage = m.from_stage
"""


def _newest(series: str, time: str, guard: str, prefixes: dict[str, str], extra: str = "") -> str:
    """Newest row r and the one before it s, among rows with a positive guard."""
    ranked = f"(select *, row_number() over (order by {time} desc) as pos from ({series}) where {guard} > 0)"
    picks = ", ".join(
        f"r.{c} as {p}_latest, s.{c} as {p}_previous, r.{c} - s.{c} as {p}_delta"
        for c, p in prefixes.items()
    )
    return f"""
select r.{time} as latest_month, {extra}{picks}
from (select 1 as one) o
left join (select * from {ranked} where pos = 1) r on true
left join (select * from {ranked} where pos = 2) s on true
"""


def _alerts(nrr: float = 90, grr: float = 90, coverage: float = 3) -> str:
    ret = _retention(START, END)
    return f"""
with ret as (select * from ({_with(ret)}) where start_mrr > 0 order by month desc limit 1),
cov as ({_with(_coverage(START, END))}),
arr as (select row_number() over (order by month desc) as pos, total_arr
  from ({_with(_arr(START, BOUNDARY_END))}))
select 'nrr' as rule, nrr_pct as value, cast({nrr} as double) as threshold,
  'Net Revenue Retention below {nrr:.0f}% (NRR=' || format('{{:.2f}}', nrr_pct) || '%).' as message
from ret where nrr_pct < {nrr}
union all select 'grr', grr_pct, {grr},
  'Gross Revenue Retention below {grr:.0f}% (GRR=' || format('{{:.2f}}', grr_pct) || '%).'
from ret where grr_pct < {grr}
union all select 'coverage', pipeline_coverage_ratio, {coverage},
  'Pipeline coverage below {coverage:.1f}x (Coverage=' || format('{{:.2f}}', pipeline_coverage_ratio) || 'x).'
from cov where pipeline_coverage_ratio < {coverage}
union all select 'arr_trend', x.total_arr, y.total_arr, 'ARR trending down over recent months.'
from arr x join arr y on x.pos = 1 and y.pos = 3 where x.total_arr < y.total_arr
"""


def _tail_records() -> str:
    return f"""
select cast(row_number() over (order by month) - 1 as integer) as place,
  strftime(month, '%Y-%m-%dT00:00:00.000') as month, total_arr
from (select * from ({_with(_arr(START, END))}) order by month desc limit 12)
"""


def _assessment(r: str) -> str:
    return (
        f"case when {r} is null then 'unknown' when {r} < 3 then 'low' when {r} < 6 then 'healthy'"
        f" when {r} < 10 then 'strong' else 'very high (validate denominator)' end"
    )


def _evidence() -> str:
    arr, ret = _arr(START, END), _retention(START, END)
    closed, stage = _closed_series(START, END), _by_stage()
    steps = {
        "a": _newest(arr, "month", "total_arr", {"total_arr": "v"}),
        "r": _newest(ret, "month", "start_mrr", {"nrr_pct": "n", "grr_pct": "g"}),
        "w": _newest(closed, "close_month", "total_closed_revenue", {"win_rate_pct": "v"}),
        "c": _coverage(START, END),
        "h": f"select max(month) as m from ({_with(ret)}) where start_mrr > 0",
        "d": _quality(False, COHORT, END),
    }
    singles = (
        (str(q.TARGET_X), "(select 1)"), ("v_latest", "a"), ("v_delta", "a"), ("n_latest", "r"),
        ("g_latest", "r"), ("v_latest", "w"), ("v_delta", "w"), ("pipeline_coverage_ratio", "c"),
        ("total_open_pipeline", "c"), ("avg_3m_closed_revenue", "c"), ("cohort_accounts", "d"),
        ("next_month_accounts", "d"), ("next_month_coverage_pct", "d"), ("coverage_threshold_pct", "d"),
    )
    texts = (
        (f"{START}::varchar || ' to ' || {END}::varchar", "(select 1)"),
        (f"{START}::varchar", "(select 1)"), (f"{END}::varchar", "(select 1)"),
        ("cast(m as varchar)", "h"), (_assessment("pipeline_coverage_ratio"), "c"),
        ("cast(retention_interpretable as varchar)", "d"), ("retention_note", "d"),
        *((f"'{x.replace(chr(39), chr(39) * 2)}'", "(select 1)") for x in (GROUNDING_RULE, RETENTION_RULE, PIPELINE_RULE)),
    )
    #: Of each list: its rows, in the document's order.
    lists = {
        "series.arr_trend_last_12": (arr, "month desc", "month desc"),
        "series.retention_last_12": (ret, "month desc", "month desc"),
        "series.closed_rev_last_12": (closed, "close_month desc", "close_month desc"),
        "pipeline.coverage_row": (_coverage(START, END), "1", None),
        "pipeline.open_by_stage_top_8": (stage, "open_pipeline desc nulls last, current_stage", None),
        "mrr_movement.movement_summary": (_summary(START, END), "movement_type", None),
        "mrr_movement.top_expansions": (_movers(START, END, "desc"), "mrr_delta desc, account_id", None),
        "mrr_movement.top_contractions": (_movers(START, END, "asc"), "mrr_delta, account_id", None),
    }
    rows = [f"select '{f}' as field, cast({x} as double) as value, cast(null as varchar) as text from {source}" for f, (x, source) in zip(q.EVIDENCE_NUMBERS, singles, strict=True)]
    rows += [f"select '{f}', cast(null as double), {x} from {source}" for f, (x, source) in zip(q.EVIDENCE_TEXTS, texts, strict=True)]
    for k, (path, (n, figures, name)) in enumerate(q.EVIDENCE_LISTS.items()):
        body, order, newest_first = lists[path]
        steps[f"l{k}"] = f"select *, row_number() over (order by {order}) as pos, count(*) over () as n from ({_with(body)})"
        place = f"least(n, {n}) - pos" if newest_first else "pos - 1"
        where = f"from l{k} where pos <= {n}"
        field = f"'{path}[' || ({place}) || '].{{}}'"
        rows += [f"select {field.format(x)}, cast({x} as double), cast(null as varchar) {where}" for x in figures]
        if name:
            text = f"strftime({name}, '%Y-%m-%dT00:00:00.000')" if name.endswith("MONTH") else name
            rows.append(f"select {field.format(name)}, cast(null as double), {text} {where}")
    ctes = ",\n".join(f"{name} as materialized ({_with(body)})" for name, body in steps.items())
    return f"with {ctes}\nselect * from (" + "\nunion all ".join(rows) + ")\nwhere value is not null or text is not null"


def _quality(strict: bool, cohort: date | str, end: date | str) -> str:
    scope = _scope(START, end)
    following = f"({_day(cohort)} + interval 1 month)"
    in_cohort = f"select account_id from {scope} where c > 0 and month = {_day(cohort)}"
    in_next = f"select account_id from {scope} where month = {following}"
    if strict:
        in_next += f" and c > 0 and account_id in ({in_cohort})"
    pct = _pct("n", "k")
    return f"""
select k as cohort_accounts, n as next_month_accounts, {pct} as next_month_coverage_pct,
  coalesce({pct} >= 90, false) as retention_interpretable,
  cast(90 as double) as coverage_threshold_pct,
  case when coalesce({pct} >= 90, false)
    then 'Retention is interpretable (next-month MRR coverage is high).'
    else 'Retention is NOT interpretable: next-month MRR appears incomplete/not loaded '
      || 'for the selected period.' end as retention_note
from (select (select count(distinct account_id) from ({in_cohort})) as k,
  (select count(distinct account_id) from ({in_next})) as n)
"""


def _scaled_text(v: str) -> str:
    return (
        f"case when abs({v}) >= 1e9 then format('{{:,.2f}}B', {v} / 1e9)"
        f" when abs({v}) >= 1e6 then format('{{:,.2f}}M', {v} / 1e6)"
        f" when abs({v}) >= 1e3 then format('{{:,.0f}}', {v}) else format('{{:,.2f}}', {v}) end"
    )


def _two_decimals(v: str, suffix: str) -> str:
    return f"coalesce(format('{{:.2f}}{suffix}', cast({v} as double)), '—')"


def _months_until(last: date | str) -> str:
    """Months of the calendar up to ``last``."""
    return f"month <= {_day(last)}"


_SECTIONS = ("Headline", "Executive Summary", "Key Risks", "Recommended Actions")
_HEADING = r"(?im)^\s*(" + "|".join(_SECTIONS) + r")\s*:\s*$"


def _section_content(name: str) -> str:
    """Content after the last heading of that name; the whole text if there is none."""
    hits = f"list_filter(parts, lambda x: lower(x.head) = '{name.lower()}')"
    found = f"coalesce({hits}[len({hits})].body, '')"
    if name == "Executive Summary":
        return f"case when len(parts) = 0 then t else {found} end"
    return found


def _replies() -> str:
    trim = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
    one, two = "chr(1) || '<'", "'>' || chr(2)"
    numbered = r"'^\d+\.\s*(.+)$'"
    rows = []
    for name in _SECTIONS:
        content = _section_content(name)
        rows.append(f"select conv_id, turn, '{name}' as section, 0 as item_no, {content} as item from cut")
        if name in ("Key Risks", "Recommended Actions"):
            line = trim.format("l")
            items = (
                f"list_filter(list_transform(string_split({content}, chr(10)),"
                f" lambda l: {trim.format(f'regexp_extract({line}, {numbered}, 1)')}), lambda i: i <> '')"
            )
            rows.append(
                f"select conv_id, turn, '{name}', cast(unnest(range(1, len(xs) + 1)) as int), unnest(xs)"
                f" from (select conv_id, turn, {items} as xs from cut)"
            )
    return f"""
with raw as (select conv_id, turn, case cast(turn % 4 as int)
    when 0 then text
    when 1 then '"### Headline:\\n' || text || chr(10) || ' executive summary :' || chr(10) || text
      || chr(10) || chr(10) || 'Key Risks:' || chr(10) || '1. ' || text || chr(10)
      || '  2.second risk' || chr(10) || 'no number\\n3.   third risk ' || chr(10)
      || 'Recommended Actions:' || chr(10) || '10. ' || text || '"'
    when 2 then 'intro' || chr(10) || 'Key Risks:' || chr(10) || '1. first' || chr(10)
      || 'key risks:' || chr(10) || '## 1. ' || text
    else chr(39) || text || chr(39) end as reply
  from conversations),
trimmed as (select conv_id, turn, {trim.format("coalesce(reply, '')")} as t from raw),
unquoted as (select conv_id, turn, case
    when (starts_with(t, '"') and ends_with(t, '"')) or (starts_with(t, '''') and ends_with(t, ''''))
    then {trim.format("substr(t, 2, greatest(len(t) - 2, 0))")} else t end as t from trimmed),
clean as (select conv_id, turn,
    {trim.format("replace(replace(replace(t, '\\n', chr(10)), '\\t', chr(9)), '#', '')")} as t
  from unquoted),
cut as (select conv_id, turn, t, list_transform(
    string_split(regexp_replace(t, '{_HEADING}', {one} || '\\1' || {two}, 'g'), {one})[2:],
    lambda x: {{'head': string_split(x, {two})[1],
           'body': {trim.format(f"string_split(x, {two})[2]")}}}) as parts
  from clean)
{chr(10).join(rows[:1])}
{chr(10).join('union all ' + r for r in rows[1:])}
"""


_AMOUNT_SCALES = "[1e-4, 1e-2, -1.0, 1.0, 1e2, -1e5]"
_VALUE = f"(cast(cast(a as double) / 100 as double) * cast({_AMOUNT_SCALES}[cast(opp_id as int) % 6 + 1] as double))"

BODIES: dict[str, str] = {
    "load_row_counts": "\nunion all ".join(
        f"select '{t}' as table_name, count(*) as row_count from {t}" for t in LOADED_TABLES
    ),
    "filtered_arr_trend": _arr(START, END, q.OWNER_FILTER),
    "filtered_by_industry_and_team": _arr(START, END, q.TEAM_FILTER),
    "filtered_open_pipeline": f"""
select opp_id, account_id, rep_id, current_stage, {_money('a')} as amount,
  cast(w as double) / 10000 as weighted_pipeline
from deals d where not is_closed and {_deal_passes(q.REP_FILTER)}
""",
    "filter_domains": """
select distinct 'segment' as dimension, segment as value from accounts where segment is not null
union all select distinct 'region', region from accounts where region is not null
union all select distinct 'industry', industry from accounts where industry is not null
union all select distinct 'rep_team', team from sales_reps where team is not null
union all select distinct 'rep_region', region from sales_reps where region is not null
""",
    "mrr_month_bounds": "select min(month) as min_month, max(month) as max_month from dense",
    "account_directory": """
select account_id, coalesce(account_name, '') as account_name, segment, region, industry,
  owner_rep_id, website, coalesce(account_name, '') || ' (' || account_id || ')' as label
from accounts
""",
    "account_mrr_series": f"""
select account_id, month, {_money('c')} as total_mrr from dense where {_months_until(END)}
""",
    "account_mrr_one_account": f"""
select account_id, month, {_money('c')} as total_mrr from dense
where {_months_until(END)} and account_id = '{q.ACCOUNT_ID}'
""",
    "account_opportunities": f"""
select opp_id, created_date, close_date, current_stage, cast(probability as double) as probability,
  {_money('a')} as amount, is_closed, is_won
from deals where account_id = '{q.ACCOUNT_ID}'
order by created_date desc nulls first, opp_id limit 200
""",
    "account_tickets": f"""
select ticket_id, created_date, status, priority, category, subject
from support_tickets where account_id = '{q.ACCOUNT_ID}'
order by created_date desc nulls first, ticket_id limit 200
""",
    "fct_mrr": f"select account_id, month, {_money('c')} as total_mrr from mrr_cents",
    "fct_mrr_enriched": f"""
select account_id, month, {_money('c')} as total_mrr, {_money('b')} as previous_mrr,
  {_money('c - b')} as mrr_change, {_movement('c', 'b', 'mart')} as movement_type
from (select x.account_id, x.month, x.c, coalesce(y.c, 0) as b
  from (select m.*, (select max(o.month) from mrr_cents o
      where o.account_id = m.account_id and o.month < m.month) as earlier from mrr_cents m) x
  left join mrr_cents y on y.account_id = x.account_id and y.month = x.earlier)
""",
    "fct_mrr_complete": f"""
select account_id, month, {_money('c')} as total_mrr, {_money('p')} as previous_mrr,
  {_money('c - p')} as mrr_change, {_movement('c', 'p', 'mart')} as movement_type
from dense
""",
    "metrics_nrr_monthly": f"""
select month, {_money('sum(p)')} as start_mrr, {_money('sum(c)')} as end_mrr,
  {_pct('sum(c)', 'sum(p)')} as nrr_pct
from dense where p > 0 and month <= (select month from revenue_end) group by month
""",
    "fct_arr": f"""
select account_id, month, {_money('c')} as total_mrr, {_money('c * 12')} as arr from dense
""",
    "metrics_arr_monthly": f"""
select month, {_money('12 * sum(c)')} as total_arr
from dense where month <= (select month from revenue_end) group by month
""",
    "metrics_grr_monthly": f"""
select month, {_money('sum(p)')} as start_mrr, {_money('sum(least(c, p))')} as retained_mrr,
  {_pct('sum(least(c, p))', 'sum(p)')} as grr_pct
from dense where p > 0 and month <= (select month from revenue_end) group by month
""",
    "fct_pipeline": f"""
select opp_id, account_id, product_id, rep_id, created_date, close_date, current_stage,
  cast(probability as double) as probability, {_money('a')} as amount,
  cast(w as double) / 10000 as weighted_pipeline, is_closed, is_won,
  cycle as sales_cycle_days, age as deal_age_days
from deals
""",
    "metrics_pipeline_summary": f"""
select {_money('sum(a) filter (where not is_closed)')} as total_open_pipeline,
  cast(sum(w) filter (where not is_closed) as double) / 10000 as total_weighted_pipeline,
  {_pct('count(*) filter (where is_won)', 'count(*) filter (where is_closed)')} as win_rate_pct,
  {_round('sum(cycle)', 'count(cycle)')} as avg_sales_cycle_days
from deals
""",
    "metrics_pipeline_monthly": f"""
select close_month, {_money('a')} as total_closed_revenue,
  {_money('coalesce(won_a, 0)')} as total_won_revenue,
  {_pct('won_n', 'n')} as win_rate_pct, {_round('days', 'day_n')} as avg_sales_cycle_days
from closed_months
""",
    "metrics_pipeline_created_monthly": f"""
select cast(date_trunc('month', created_date) as date) as created_month,
  count(*) as opportunities_created, {_money('sum(a)')} as total_created_pipeline_value,
  {_round('sum(a)', '(100 * count(a))')} as avg_created_deal_size
from deals group by 1
""",
    "metrics_pipeline_coverage": f"""
select {_money('o')} as total_open_pipeline, {_money('a')} as total_closed_revenue,
  {_round('o', 'a')} as pipeline_coverage_ratio
from (select a, (select sum(a) from deals where not is_closed) as o
  from closed_months where close_month is not null
  order by close_month desc limit 1)
""",
    "fct_stage_velocity": """
select stage, count(distinct opp_id) as deals_reached_stage,
  avg(stage_end_date - stage_start_date) as avg_stage_duration_days
from opportunity_stage_history where stage_end_date is not null group by stage
""",
    "metrics_stage_conversion": f"""
select m.from_stage, m.to_stage, m.n as deals_progressed, i.n as deals_in_stage,
  {_pct('m.n', 'i.n')} as conversion_rate_pct
from (select s.stage as from_stage, t.stage as to_stage, count(distinct s.opp_id) as n
    from steps s join steps t on t.opp_id = s.opp_id and t.pos - s.pos = 1 group by all) m
join (select stage, count(distinct opp_id) as n from opportunity_stage_history group by stage) i
  on i.stage = m.from_stage
""",
    "fct_account_health": f"""
select account_id, {_money('m0')} as latest_mrr, {_money('coalesce(m1, 0)')} as mrr_1m_ago,
  {_money('coalesce(m2, 0)')} as mrr_2m_ago, {_money('o')} as open_pipeline_value,
  case when m0 > m1 and m1 > m2 then 'Growing' when m0 < m1 and m1 < m2 then 'Declining'
    else 'Stable' end as mrr_trend_3m,
  cast(m0 > 10000000 as int) as high_value_flag,
  cast(case when m0 = 0 then -3 else coalesce(sign(m0 - m1), 0) end + (o > 0)::int as int)
    as health_score,
  case when m0 = 0 then 'Lost' when m0 < m1 then case when o = 0 then 'High Risk' else 'At Risk' end
    when m0 > m1 then 'Growing' else 'Stable' end as health_status
from (select a.account_id, x.c as m0, y.c as m1, z.c as m2, coalesce(k.o, 0) as o
  from accounts a
  join (select * from dense where month = (select month from revenue_end)) x
    on x.account_id = a.account_id
  left join cal p1 on p1.month = x.month
  left join dense y on y.account_id = a.account_id and y.month = p1.prior
  left join cal p2 on p2.month = y.month
  left join dense z on z.account_id = a.account_id and z.month = p2.prior
  left join (select account_id, sum(a) as o from deals where not is_closed group by 1) k
    on k.account_id = a.account_id)
""",
    "v_gtm_metrics": f"""
select r.month, {_money('12 * r.c')} as total_arr, {_pct('r.e', 'r.s')} as nrr_pct,
  {_pct('r.k', 'r.s')} as grr_pct, {_money('m.a')} as total_closed_revenue,
  {_pct('m.won_n', 'm.n')} as win_rate_pct, {_round('v.o', 'v.a')} as pipeline_coverage_ratio
from (select month, sum(c) as c, sum(p) filter (where p > 0) as s, sum(c) filter (where p > 0) as e,
    sum(least(c, p)) filter (where p > 0) as k
  from dense where month <= (select month from revenue_end) group by month) r
left join closed_months m on m.close_month = r.month
cross join (select a, (select sum(a) from deals where not is_closed) as o
  from closed_months where close_month is not null order by close_month desc limit 1) v
""",
    "app_arr_trend": _arr(START, END),
    "app_retention_trend": _retention(START, END),
    "app_retention_trend_boundary": _retention(START, BOUNDARY_END),
    "app_retention_trend_filtered": _retention(START, END, q.OWNER_FILTER),
    "app_closed_revenue_monthly": _closed_series(START, END),
    "app_closed_revenue_monthly_filtered": _closed_series(date(1996, 3, 15), END, q.REP_FILTER),
    "app_pipeline_coverage": _coverage(START, END),
    "app_pipeline_coverage_filtered": _coverage(START, END, q.REP_FILTER),
    "app_open_pipeline_by_stage": _by_stage(),
    "app_open_pipeline_by_stage_filtered": _by_stage(q.REP_FILTER),
    "app_mrr_movement_summary": _summary(START, END),
    "app_mrr_movement_summary_filtered": _summary(date(1999, 1, 1), END, q.OWNER_FILTER),
    "app_top_expansions": _movers(START, END, "desc"),
    "app_top_contractions": _movers(START, END, "asc"),
    "latest_snapshot": f"""
select account_id, month, {_money('c')} as total_mrr from mrr_cents
where month = (select max(month) from mrr_cents where {_months_until(END)})
""",
    "app_computed_health": _health(START, END),
    "app_computed_health_boundary": _health(START, BOUNDARY_END),
    "app_stage_duration": _stage_days(),
    "app_stage_duration_filtered": _stage_days(q.OWNER_FILTER),
    "app_stage_transitions": _stage_moves(),
    "app_stage_transitions_filtered": _stage_moves(q.OWNER_FILTER),
    "kpi_arr": _newest(_arr(START, BOUNDARY_END), "month", "total_arr", {"total_arr": "arr"}),
    "kpi_retention": _newest(
        _retention(START, END),
        "month",
        "start_mrr",
        {"nrr_pct": "nrr", "grr_pct": "grr"},
        "r.start_mrr as start_mrr_latest, ",
    ),
    "kpi_win_rate": _newest(
        _closed_series(START, END),
        "close_month",
        "total_closed_revenue",
        {"win_rate_pct": "win_rate"},
    ),
    "coverage_assessment": f"""
select current_stage, r as ratio, {_assessment('r')} as assessment
from (select current_stage, round(open_pipeline / weighted_pipeline * 2, 4) as r
  from ({_by_stage()}))
""",
    "retention_display": f"""
select month, {', '.join(
    f"case when start_mrr > 0 and {c}_pct = 0 then 'Data not loaded for selected period'"
    f" else coalesce(format('{{:.2f}}%', {c}_pct), 'Not available') end as {c}_text"
    for c in ('nrr', 'grr'))}
from ({_retention(START, BOUNDARY_END)})
""",
    "health_distribution": f"""
select health_status, count(*) as count from ({_health(START, END)}) group by health_status
""",
    "at_risk_accounts": f"""
select * from ({_health(START, END)}) order by health_score, account_id limit 50
""",
    "retention_quality": _quality(False, COHORT, END),
    "retention_quality_strict": _quality(True, END, BOUNDARY_END),
    "quality_checks": """
select 'MRR date bounds' as check, min(month) as min, max(month) as max, cast(null as bigint) as rows
from dense
union all select 'Pipeline close bounds', min(close_date), max(close_date), null from deals
union all select 'Row count — FCT_MRR', null, null, count(*) from dense
union all select 'Row count — FCT_PIPELINE', null, null, count(*) from deals
union all select 'Row count — Accounts', null, null, count(*) from accounts
union all select 'Row count — Stage History', null, null, count(*) from opportunity_stage_history
union all select 'Row count — Support Tickets', null, null, count(*) from support_tickets
""",
    "display_formats": f"""
select opp_id,
  coalesce(case when v < 0 then '-' else '' end || '$' || {_scaled_text('abs(v)')}, '—') as currency,
  coalesce({_scaled_text('v')}, '—') as number, {_two_decimals('probability * 100', '%')} as pct,
  {_two_decimals('cast(cycle as double) / 8', 'x')} as multiple
from (select *, {_VALUE} as v from deals)
""",
    "retention_series_long": f"""
select month, 'nrr_pct' as series, nrr_pct as value from ({_retention(START, END)})
union all select month, 'grr_pct', grr_pct from ({_retention(START, END)})
""",
}

BODIES["health_snapshot"] = f"""
select account_id, health_score, health_status from ({BODIES["fct_account_health"]})
"""

ORACLE_SQL: dict[str, str] = {
    **{name: _with(body) for name, body in BODIES.items()},
    "kpi_alerts": _alerts().strip(),
    "kpi_alerts_tight": _alerts(q.TIGHT.nrr_below, q.TIGHT.grr_below, q.TIGHT.coverage_below).strip(),
    "tail_records": _tail_records().strip(),
    "evidence_pack": _evidence(),
    "response_sections": _replies().strip(),
}
