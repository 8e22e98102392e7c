import random
from collections import Counter, defaultdict
from datetime import date, timedelta

import pytest

from revtide.operators import stages as s
from revtide.operators.filters import Context, DimFilter

HIST = "opp_id string, account_id string, stage string, stage_start_date date, stage_end_date date"


def day(n):
    return date(2024, 1, 1) + timedelta(days=n)


def brute_moves(rows):
    deals = defaultdict(list)
    for opp, _, stage, start, end in rows:
        deals[opp].append((start or date.max, end or date.max, stage))
    moves = []
    for opp, steps in deals.items():
        steps.sort()
        moves += [(opp, a[2], b[2]) for a, b in zip(steps, steps[1:])]
    return moves


@pytest.fixture
def rows():
    rng = random.Random(3)
    made = []
    for i in range(40):
        for _ in range(rng.randint(1, 6)):
            start = day(rng.randint(0, 3))
            end = rng.choice([None, start, start + timedelta(days=2)])
            made.append((f"o{i}", f"a{i % 4}", rng.choice("PQRS"), start, end))
    # One deal with a large share of all rows, many of them equal.
    made += [("hot", "a0", rng.choice("PQ"), day(rng.randint(0, 2)), None) for _ in range(200)]
    return made


def test_conversion_against_brute_force(frame, rows):
    pairs = {(o, a, b) for o, a, b in brute_moves(rows)}
    progressed = Counter((a, b) for _, a, b in pairs)
    in_stage = Counter(stage for _, stage in {(r[0], r[2]) for r in rows})
    got = {(r.from_stage, r.to_stage): (r.deals_progressed, r.deals_in_stage)
           for r in s.stage_conversion(frame(HIST, rows)).collect()}
    assert got == {k: (n, in_stage[k[0]]) for k, n in progressed.items()}


def test_transitions_count_repeats(frame, rows):
    accounts = frame("account_id string, segment string, region string, industry string,"
                     " owner_rep_id string", [(f"a{i}", "x", "x", "x", None) for i in range(3)])
    hist = frame(HIST, rows)
    known = [r for r in rows if r[1] != "a3"]
    counts = Counter((a, b) for _, a, b in brute_moves(known))
    ctx = Context(hist, hist, accounts, history=hist)
    got = {(r.from_stage, r.to_stage): r.deals_progressed
           for r in s.stage_transitions(ctx).collect()}
    assert got == dict(counts)


def test_straight_skipped_and_repeated_path(frame):
    hist = frame(HIST, [
        ("1", "a", "P", day(0), day(2)), ("1", "a", "Q", day(2), day(5)), ("1", "a", "P", day(5), None),
        ("2", "a", "P", day(0), day(4)), ("2", "a", "R", day(4), None),
        ("3", "a", "P", day(0), None),
    ])
    got = {(r.from_stage, r.to_stage): (r.deals_progressed, r.deals_in_stage, r.conversion_rate_pct)
           for r in s.stage_conversion(hist).collect()}
    assert got == {("P", "Q"): (1, 3, 33.33), ("P", "R"): (1, 3, 33.33), ("Q", "P"): (1, 1, 100.0)}
    velocity = {r.stage: (r.deals_reached_stage, r.avg_stage_duration_days)
                for r in s.stage_velocity(hist).collect()}
    assert velocity == {"P": (2, 3.0), "Q": (1, 3.0)}


def test_same_start_goes_by_end_date(frame):
    hist = frame(HIST, [("1", "a", "Z", day(0), day(0)), ("1", "a", "B", day(0), None)])
    assert [(r.from_stage, r.to_stage) for r in s.stage_steps(hist).collect()] == [("Z", "B")]


def test_duration_with_filter(frame):
    hist = frame(HIST, [("1", "a", "P", day(0), day(3)), ("2", "b", "P", day(0), day(4)),
                        ("3", "c", "P", day(0), day(9))])
    accounts = frame("account_id string, segment string, region string, industry string,"
                     " owner_rep_id string", [("a", "x", "r", "i", "1"), ("b", None, "r", "i", "1")])
    ctx = Context(hist, hist, accounts, history=hist)
    assert tuple(s.stage_duration(ctx).first()) == ("P", 2, 3.5)
    assert tuple(s.stage_duration(ctx, DimFilter(segments=("x",))).first()) == ("P", 1, 3.0)
    with pytest.raises(ValueError):
        s.stage_duration(Context(hist, hist, accounts))


def test_rows_without_a_deal_move_nowhere(frame, rows):
    odd = rows + [(None, "a0", "P", day(0), None), (None, "a0", "Q", day(1), None)]
    odd += [("n", "a0", None, day(0), day(1)), ("n", "a0", "P", None, None), ("n", "a0", "Q", day(2), None)]
    known = frame(HIST, [r for r in odd if r[0] is not None])
    assert sorted(map(str, s.stage_conversion(frame(HIST, odd)).collect())) == sorted(map(str, s.stage_conversion(known).collect()))
    found = sorted((r.from_stage or "", r.to_stage, r.steps) for r in s.stage_steps(frame(HIST, odd[-3:])).collect())
    # A null start date comes last.
    assert found == [("", "Q", 1), ("Q", "P", 1)]


def test_a_hot_deal_spans_tasks(spark):
    """One deal owns a third of the distinct rows; no task gets more than twice the median."""
    from pyspark.sql import functions as F

    n = 60_000
    start = F.date_add(F.lit(day(0)), (F.col("id") % 1500).cast("int"))
    hist = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 997).cast("string")).alias("opp_id"),
        F.lit("a").alias("account_id"),
        F.concat(F.lit("S"), F.col("id") % 7).alias("stage"),
        start.alias("stage_start_date"),
        F.date_add(start, (F.col("id") / 1500).cast("int")).alias("stage_end_date"),
    )
    distinct = hist.distinct()
    assert distinct.count() == n and distinct.where("opp_id = 'hot'").count() == n // 3
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for key, value in zip(kept, ("false", "8", "-1")):
            spark.conf.set(key, value)
        steps = s.stage_steps(hist)
        sizes = sorted(r["count"] for r in steps.groupBy(F.spark_partition_id()).count().collect())
        assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]
        assert steps.agg(F.sum("steps")).first()[0] == n - distinct.select("opp_id").distinct().count()
        plan = s.stage_conversion(hist)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Range (0") == 1 and "ReusedExchange" in plan
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)
