"""Mixing sources to target weights: hash-random order, prefix sums, exact budgets.

Every row gets a random key from its id. Within a source the rows are ordered by key;
the order is dealt into ranges of keys, whose word sums are added up first (one row a
source and range), then only the range in which the budget ends is sorted. What a row
gives follows from its key and its source's plan alone, so texts are never shuffled.

Defined results. Null text: size 0. Null source: a source of its own, the last one. Null
id: a key like any other. Rows with one id have one key: at the cut they share what is
left evenly. Empty table: no rows. Other columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtide.llm.common import WORD, stored, word_count

#: Hexadecimal digits of the key that name its range: 4,096 ranges a source.
RANGE_DIGITS = 3


def _key(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def _name(source: Column) -> Column:
    return F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """Words to take of each source; sizes has _source and _source_size, a row a source.

    Sources in code-point order, null last, weigh `weights` in turn and share `share`
    times all words. A target ends at `most` times its source's size; what lies above
    goes to the others by weight until no target is above. Sources are filled in the
    order of limit over weight: one is full if its part of what is left exceeds its
    limit. The windows run over one row a source.
    """
    everything = Window.partitionBy(F.lit(0))
    before = Window.partitionBy(F.lit(0)).orderBy(F.col("_limit") / F.col("_weight"), "_rank")
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    rank = F.row_number().over(everything.orderBy(F.substring("_source", 1, 1) == "n", "_source")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    left = F.lit(float(share)) * F.sum("_source_size").over(everything) - F.coalesce(F.sum("_limit").over(earlier), F.lit(0))
    level = left / (F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(earlier), F.lit(0)))
    return (
        sizes.withColumn("_rank", rank)
        .withColumn("_weight", weight.cast("long"))
        .withColumn("_limit", F.col("_source_size") * most)
        .withColumn("_level", level)
        .withColumn("_place", F.row_number().over(before))
        .withColumn("_open", F.col("_limit") > F.col("_weight") * F.col("_level"))
        .withColumn("_level", F.min(F.when(F.col("_open"), F.struct("_place", "_level"))).over(everything)["_level"])
        .withColumn("_target", F.least(F.col("_limit").cast("double"), F.coalesce(F.col("_weight") * F.col("_level"), F.col("_limit").cast("double"))))
        .select("_source", "_source_size", "_target")
    )


def mixing_plan(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: str = "mix") -> DataFrame:
    """A row a source: how often all rows go in, and up to which key once more."""
    rows = docs.select(
        _name(F.col("source")).alias("_source"),
        _key(F.col("doc_id"), seed).alias("_key"),
        word_count(F.col("text")).alias("_size"),
    ).withColumn("_range", F.substring("_key", 1, RANGE_DIGITS))
    rows = stored(rows)
    ranges = rows.groupBy("_source", "_range").agg(F.sum("_size").alias("_words"))
    sizes = ranges.groupBy("_source").agg(F.sum("_words").alias("_source_size"))
    plan = stored(
        source_targets(sizes, weights, share, most)
        .withColumn("_whole", F.when(F.col("_source_size") == 0, 0).otherwise(F.floor(F.round("_target") / F.col("_source_size"))).cast("long"))
        .withColumn("_rest", (F.round("_target") - F.col("_whole") * F.col("_source_size")).cast("long"))
    )
    running = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    last_range = (
        ranges.withColumn("_upto", F.sum("_words").over(running))
        .join(plan.select("_source", "_rest"), "_source")
        .where((F.col("_upto") >= F.col("_rest")) & (F.col("_upto") - F.col("_words") < F.col("_rest")))
        .select("_source", "_range", (F.col("_rest") - F.col("_upto") + F.col("_words")).alias("_rest"))
    )
    by_key = Window.partitionBy("_source").orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)
    cut = (
        rows.join(last_range, ["_source", "_range"])
        .groupBy("_source", "_key", "_rest")
        .agg(F.sum("_size").alias("_words"), F.count("*").alias("_sharing"))
        .withColumn("_upto", F.sum("_words").over(by_key))
        .where((F.col("_upto") >= F.col("_rest")) & (F.col("_upto") - F.col("_words") < F.col("_rest")))
        .select("_source", F.col("_key").alias("_cut"), F.floor((F.col("_rest") - F.col("_upto") + F.col("_words")) / F.col("_sharing")).alias("_part"))
    )
    # As a stored table the plan has a known size, by which the planner chooses the join.
    return stored(plan.drop("_rest").join(cut, "_source", "left"))


def with_plan(docs: DataFrame, plan: DataFrame, seed: str = "mix") -> DataFrame:
    """docs with size, source_size, target, taken and the parts: _whole copies and _once words."""
    size, key = F.col("_size"), _key(F.col("doc_id"), seed)
    once = F.when(key < F.col("_cut"), size).when(key == F.col("_cut"), F.least(size, "_part")).otherwise(0)
    return (
        docs.withColumns({"_size": word_count(F.col("text")), "_source": _name(F.col("source"))})
        .join(plan, "_source")
        .withColumn("_once", once.cast("long"))
        .withColumns({"size": size, "source_size": F.col("_source_size"), "target": F.col("_target"), "taken": F.col("_whole") * size + F.col("_once")})
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: str = "mix") -> DataFrame:
    """The mixed corpus: each row as often as its source is repeated.

    The row at which a source's budget ends gives its first words only, joined by one
    space. Rows without words come along as often as their source is repeated in whole.
    """
    columns = docs.columns
    planned = with_plan(docs, mixing_plan(docs, weights, share, most, seed), seed)
    copies = F.concat(
        F.array_repeat(F.col("_size"), F.col("_whole").cast("int")),
        F.when(F.col("_once") > 0, F.array("_once")).otherwise(F.array().cast("array<bigint>")),
    )
    first = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), F.col("_words").cast("int")), " ")
    shorter = F.col("_words") < F.col("_size")
    mixed = planned.withColumn("_words", F.explode(copies)).withColumn("text", F.when(shorter, first).otherwise(F.col("text")))
    if "n_chars" in columns:
        mixed = mixed.withColumn("n_chars", F.when(shorter, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return mixed.select(*columns)
