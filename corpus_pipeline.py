"""The corpus pipeline: documents through five stages, each written and read again.

Defined results. Null and empty texts pass all stages; the mix takes them as often as it
repeats their source in whole, and they are packed as an end id alone. A
null id is never a near copy; rows of one id share its fate. Other columns come along until
the last stage. Empty tables give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from revtide.llm import mixing, near_duplicates, packing, substrings, toxicity
from revtide.llm.common import stored


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject; it learns from the labelled ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.learn(docs, labels))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similarity 0.8 or more on five-word shingles, the smallest id."""
    report = near_duplicates.near_duplicates(docs.select("doc_id", "text"), percent=80)
    # Written, so that the planner knows its size when it chooses the join.
    copies = stored(report.where("not kept").select("doc_id").distinct(), docs.count(), per_file=20_000)
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 20 words and more that an earlier one holds."""
    return substrings.without_repeats(docs, length=20)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights, documents repeated where needed."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxic),
    ("near_duplicates", near_copies),
    ("substrings", repeated_passages),
    ("mixing", mixed_sources),
    ("packing", packed),
]

#: SQL can express neither the models nor the ids of a tokenizer; the tests hold the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
