import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from revtide.llm.common import training_rows
from revtide.llm import quality_model as quality

TEXTS = ["some Words here", "", None, " \n", "ÉTÉ AB ab", "x x x x", "one", "A B", "tail word "]


def test_mean_margins_as_bucket_by_bucket():
    margin = np.random.default_rng(0).normal(size=quality.BUCKETS + 3)
    features = quality.Features(pa.RecordBatch.from_pydict({"text": pa.array(TEXTS)}))
    means = features.means(margin)
    for k in range(len(TEXTS)):
        where, weights = features.of_text(k)
        assert weights.sum() == pytest.approx(1, abs=1e-5)
        assert margin[where] @ weights == pytest.approx(means[k], abs=1e-5)
    # A word's share does not depend on the texts around it.
    alone = quality.Features(pa.RecordBatch.from_pydict({"text": pa.array(TEXTS[:1])}))
    assert alone.means(margin)[0] == pytest.approx(means[0])


def test_repeats_and_capitals_are_seen():
    features = quality.Features(pa.RecordBatch.from_pydict({"text": pa.array(["a b c d", "a a a a", "AB cd", "word wordy"])}))
    assert features.again.tolist() == [0, 6, 0, 0]
    assert features.capitals.tolist() == [False] * 8 + [True, False, False, False]


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.learn(docs, labels)
    held_out = labels.where(F.crc32(F.col("doc_id").cast("string")) % 4 == 2).join(docs, "doc_id")
    rows = held_out.select("quality", quality.score(F.col("text"), model).alias("score")).collect()
    assert np.mean([(r.score >= 0.7) == bool(r.quality) for r in rows]) > 0.93


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "good text here", "x"), (2, None, "x"), (None, "", "x")], "doc_id long, text string, label string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, quality int")
    for labels, low, high in ((none, 0.99, 1), (one, 0, 0.01)):
        model = quality.learn(docs, labels)
        assert all(low <= r.s <= high for r in docs.select(quality.score(F.col("text"), model).alias("s")).collect())
    assert docs.limit(0).select(quality.score(F.col("text"), quality.learn(docs, none)).alias("s")).collect() == []


def test_one_training_row_an_id(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, "c"), (2, None), (3, None), (None, "d")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1) for k in (1, 2, 3, None)], "doc_id long, quality int")
    rows = training_rows(docs.union(docs), labels, "quality", 1000, 999, 3).collect()
    assert sorted(r.doc_id for r in rows) == [1, 2, 3]
