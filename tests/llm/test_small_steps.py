import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa

from revtide.llm import substrings, toxicity
from revtide.llm.common import scratch_dir, stored
from revtide.llm.components import components


class _Captured:
    """A table that keeps what is to be run over it."""

    def select(self, *_):
        return self

    def mapInArrow(self, run, schema):
        self.run = run
        return self

    def __getattr__(self, name):
        return lambda *_: self


def test_steps_over_texts_take_little_memory(spark):
    """Workers keep what a step of theirs took; with 2 MB of text a step these took 60 to 160 MB."""
    rng = np.random.default_rng(5)
    words = np.array([f"w{k}" for k in range(5000)])
    texts = [" ".join(rng.choice(words, 400)) for _ in range(3000)]
    batch = pa.RecordBatch.from_pydict({"text": texts, "doc": np.arange(3000), "digest": np.arange(3000)})
    for made in (lambda t: toxicity._texts(t), lambda t: substrings._routes(t, 20, False), lambda t: substrings._routes(t, 20, True)):
        table = _Captured()
        made(table)
        for _ in table.run(iter([batch.slice(0, 1)])):
            pass
        tracemalloc.start()
        for _ in table.run(iter([batch])):
            pass
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 40e6


def test_small_tables_are_stored_in_few_files(spark):
    """However many partitions the shuffles have: 500 links took 50 files of each star."""
    scratch = Path(scratch_dir(spark).removeprefix("file://"))
    settings = {"spark.sql.shuffle.partitions": "50", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    kept = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        before = {*scratch.iterdir()} if scratch.exists() else set()
        links = spark.createDataFrame([(k, k + 1) for k in range(500)], "a long, b long").coalesce(2)
        found = components(links).collect()
        assert len(found) == 501 and {r.component for r in found} == {0}
        files = [len([*x.glob("part-*")]) for x in scratch.iterdir() if x not in before]
        assert len(files) > 2 and max(files) <= 2
        rows = stored(spark.range(1000).repartition(50, "id"), 1000, per_file=250)
        assert rows.count() == 1000 and len(rows.inputFiles()) <= 4
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_forms_of_training_texts_are_summed_before_they_travel(spark):
    """A row a form, not one a form and text; copies (equal signatures) count once, by the most sightings."""
    table = _Captured()
    toxicity._sightings(table, None)
    texts = ["word other", "word word other", None, *["word other"] * 40]
    batch = pa.RecordBatch.from_pydict({"signature": [1, 1, 2, *range(3, 43)], "text": texts})
    rows = [r for b in table.run(iter([batch])) for r in b.to_pylist()]
    assert len(rows) == len({r["form"] for r in rows}) == 5
    made = {r["form"]: (r["texts"], r["seen"]) for r in rows}
    assert made == {"word": (41, 42), "wor*": (41, 42), "other": (41, 41), "oth*": (41, 41), "othe*": (41, 41)}
