import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import assert_same, open_database

from revtide.llm import divergence as dv
from revtide.llm.oracle_sql import ORACLE_SQL
from revtide.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})


def brute(rows, least, top):
    counts, held = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = TERM.findall((text or "").translate(LOWER))
        counts[lang or "", source or ""].update(terms)
        held[lang or ""].update(set(terms))
    out = set()
    for lang, docs in held.items():
        kept = [t for t, n in docs.items() if n >= least]
        groups = {s: c for (x, s), c in counts.items() if x == lang}
        whole = Counter()
        for c in groups.values():
            whole.update(c)

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        q, p = shares(whole), {s: shares(c) for s, c in groups.items()}
        for s in groups:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in groups if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                order = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, k) for k, (value, item) in enumerate(order[:most], 1)}
    return out


SCHEMA = "lang string, source string, text string, term string, n long"


def made_rows():
    rng = random.Random(6)
    words = ["The", "a", "É", "été", "ÀB", "x_y", "foo-bar", "naïve", "Z", "don't", "ｆｕｌｌ", "İ", "w1w", "zz[q]", "\x00", "\x7f", "{", "`t`", "日本", "~"]
    rows = []
    for k in range(300):
        text = " ".join(rng.choice(words[: 4 + k % 16]) for _ in range(k % 40))
        rows.append((("en", "fr", None, "")[k % 4 if k % 3 else 0], ("s1", "s2", "", None, "é", "Z")[k % 6 if k % 2 else 0], text))
    rows += [("en", "quiet", None), ("en", "quiet", ""), ("de", "a", "12 !"), ("de", "b", None), ("solo", "only", "one one"), ("en", "s1", "long " * 100_000), *rows[:5]]
    return rows


@pytest.mark.parametrize("least, top", [(5, 4), (1, 50), (10_000, 3)])
def test_as_brute_force(spark, least, top):
    rows = made_rows()
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(6)
    found = dv.audit(docs, least=least, top=top)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    told = [tuple(r) for r in found.collect()]
    assert len(told) == len(set(told)) and set(told) == brute(rows, least, top)


def test_tasks_that_send_early_count_alike(spark, monkeypatch):
    rows = made_rows()
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).coalesce(1)
    monkeypatch.setattr(dv, "GATHERED", 8)
    monkeypatch.setattr(dv, "STEP", 200)
    monkeypatch.setattr(dv, "CELLS", 6)
    assert {tuple(r) for r in dv.audit(docs, least=3).collect()} == brute(rows, 3, 50)


def test_frequencies_of_large_counts():
    rng = random.Random(1)
    wholes = [rng.randrange(1, dv.LARGEST) for _ in range(200)] + [1, dv.LARGEST - 1]
    counts = [rng.randrange(w + 1) for w in wholes]
    assert dv.parts(np.array(counts), np.array(wholes)).tolist() == [1 + 10**9 * c // w for c, w in zip(counts, wholes)]


def test_frequencies_in_spark(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(w + 1), w) for w in (rng.randrange(1, dv.LARGEST) for _ in range(200))]
    df = spark.createDataFrame(rows, "c long, w long")
    assert all(r.p == 1 + 10**9 * r.c // r.w for r in df.withColumn("p", dv._parts(df["c"], df["w"])).collect())


def test_no_rows(spark):
    assert dv.audit(spark.createDataFrame([], SCHEMA)).collect() == []


def test_counts_are_dealt_once(spark):
    docs = spark.createDataFrame([(*r, "clash", 1) for r in made_rows()], SCHEMA)
    plan = dv.shards(docs, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1, plan


def test_as_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert_same(QUERIES["op11_source_divergence"](spark, folder), open_database(folder), ORACLE_SQL["op11_source_divergence"])
