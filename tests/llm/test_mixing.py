from collections import defaultdict

import pytest

from revtide.llm import mixing


def expected_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Reshare what lies above the limits until nothing does."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    full, total = set(), share * sum(sizes.values())
    while True:
        left = total - sum(most * sizes[s] for s in full)
        open_ = sum(weight[s] for s in order if s not in full)
        target = {s: most * sizes[s] if s in full else left * weight[s] / open_ for s in order}
        above = {s for s in order if s not in full and target[s] > most * sizes[s]}
        if not above:
            return target
        full |= above


def planned(docs):
    return mixing.with_plan(docs, mixing.mixing_plan(docs)).select("doc_id", "source", "size", "source_size", "target", "taken").collect()


SCHEMA = "doc_id long, source string, text string, _size string, n_chars long"


def made_docs(spark):
    rows = [(k, ("a", "b", "c", None, "é", "")[k % 6 if k % 2 else 0], "w " * (k * 7 % 40), "x", k) for k in range(300)]
    rows += [(900, "z", None, None, None), (901, "z", "", "x", 0), (None, "a", "no id", "x", 1), (5, "b", "one two three", "x", 1), (5, "b", "one two three", "x", 1)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def test_targets_and_words_taken(spark):
    rows = planned(made_docs(spark))
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size
    want = expected_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
    for source, target in want.items():
        assert taken[source] == pytest.approx(target, abs=2)
    assert sorted(map(str, rows)) == sorted(map(str, planned(made_docs(spark).repartition(3))))


def test_mixed_rows_hold_the_words_taken(spark):
    docs = made_docs(spark)
    words = defaultdict(int)
    rows = mixing.mix(docs).collect()
    assert rows[0].__fields__ == docs.columns
    for r in rows:
        words[r.doc_id] += len((r.text or "").split())
    taken = defaultdict(int)
    for r in planned(docs):
        taken[r.doc_id] += r.taken
    assert {d: n for d, n in words.items() if n} == {d: n for d, n in taken.items() if n}


def test_empty_table_and_texts(spark):
    assert planned(spark.createDataFrame([], SCHEMA)) == []
    only = planned(spark.createDataFrame([(1, "a", None, "x", 1), (2, None, " ", "x", 1)], SCHEMA))
    assert [(r.size, r.target, r.taken) for r in only] == [(0, 0.0, 0)] * 2
