"""Divergence of sources: how far the term frequencies of a language's sources lie apart.

Texts are lower-cased, split and counted by Arrow's own kernels inside the tasks: ascii_lower,
split_pattern_regex, dictionary_encode and a hash group_by, which a task repeats over what
it has gathered before it sends counts on. These meet once, dealt by language and term, and
are written as columnar shards of the terms that enough documents hold. Smoothed frequencies are
integers, in parts of 10**9, so that sums are exact in any order.

Pairs of sources are compared term by term: a shard makes a matrix of its terms' counts by
the sources of the language, and sends one sum for each pair. The result has a row for each
pair, so this work and a task's memory grow with the square of a language's number of sources,
not with the corpus.

Defined results. Null text, language or source: empty, and an empty one is a value as any
other. Rows are documents, repeated ones too. A source without terms is a group with counts of 0. A language
without kept terms: pairs of value 0. Ties rank by the item's UTF-8 bytes. Empty table: no
rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtide.llm.common import steps, stored

#: What stands between terms: ASCII but for letters.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of text counted at once, and rows of counts that a task gathers before it sends them.
STEP, GATHERED = 8 << 20, 1_000_000
#: Frequencies are given in parts of so many; what is added to each count.
PARTS, ADDED = 10**9, 5
#: Counts up to which long division by thousands stays within 64 bits.
LARGEST = 2**53
#: Cells of a matrix of terms by sources that one step works on.
CELLS = 1 << 21

_PARTIAL = "lang string, source string, term string, n long, docs long"


def _counted(part: pa.RecordBatch) -> pa.Table:
    """lang, source, term, occurrences and documents; and of each group a row of its
    own, so named that no term can be and that groups are dealt apart."""
    words = pc.split_pattern_regex(pc.ascii_lower(part.column("text")), BETWEEN)
    terms = pc.list_flatten(words)
    row = pc.list_parent_indices(words)
    some = pc.not_equal(terms, "")
    coded = terms.filter(some).dictionary_encode()
    langs, sources = (part.column(x).dictionary_encode() for x in ("lang", "source"))
    group = pc.add(pc.multiply(langs.indices.cast(pa.int64()), len(sources.dictionary)), sources.indices.cast(pa.int64()))
    # Occurrences in each document, then sums over the documents of a group.
    held = pa.table({"row": row.filter(some), "term": coded.indices}).group_by(["row", "term"], use_threads=False).aggregate([([], "count_all")])
    held = held.append_column("group", group.take(held["row"]))
    sums = held.group_by(["group", "term"], use_threads=False).aggregate([("count_all", "sum"), ([], "count_all")])
    groups = pc.unique(group)
    numbers = pa.concat_arrays([sums["group"].combine_chunks(), groups])
    lang, source = np.divmod(numbers.to_numpy(), len(sources.dictionary))
    marks = pa.array([f" {x}" for x in sources.dictionary.take(pa.array(source[len(sums) :])).to_pylist()], pa.string())
    empty = pa.array(np.zeros(len(groups), np.int64))
    return pa.table(
        {
            "lang": langs.dictionary.take(pa.array(lang)),
            "source": sources.dictionary.take(pa.array(source)),
            "term": pa.concat_arrays([coded.dictionary.take(sums["term"].combine_chunks()), marks]),
            "n": pa.concat_arrays([sums["count_all_sum"].combine_chunks().cast(pa.int64()), empty]),
            "docs": pa.concat_arrays([sums["count_all"].combine_chunks().cast(pa.int64()), empty]),
        }
    )


def _merged(tables: list[pa.Table]) -> pa.Table:
    sums = pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return sums.select(["lang", "source", "term", "n_sum", "docs_sum"]).rename_columns(["lang", "source", "term", "n", "docs"])


def partial_counts(docs: DataFrame) -> DataFrame:
    """Counts of each task, by language, source and term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        fresh = kept = 0
        for part in steps(batches, size=STEP):
            held.append(_counted(part))
            fresh += held[-1].num_rows
            if fresh < max(GATHERED // 2, kept):
                continue
            held, fresh = [_merged(held)], 0
            kept = held[0].num_rows
            if kept >= GATHERED:
                yield from held.pop().to_batches(65536)
                kept = 0
        if held:
            yield from _merged(held).to_batches(65536)

    blank = [F.coalesce(F.col(x).cast("string"), F.lit("")).alias(x) for x in ("lang", "source", "text")]
    return docs.select(*blank).mapInArrow(run, _PARTIAL)


def shards(docs: DataFrame, least: int) -> DataFrame:
    """lang, source, term and n, and whether it is the term's first row, its count in all
    sources, of the terms in at least `least` documents of their language; and one row a
    group, whose term begins with a space. Dealt once, by language and term."""
    sums = partial_counts(docs).repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # The same columns deal these windows, so that nothing moves again.
    of_term = Window.partitionBy("lang", "term")
    seen = sums.withColumns(
        {"held": F.sum("docs").over(of_term), "of_lang": F.sum("n").over(of_term), "first": F.row_number().over(of_term.orderBy("source")) == 1}
    )
    return seen.where(F.col("term").startswith(" ") | (F.col("held") >= least)).drop("docs", "held")


def parts(count: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(PARTS * count / whole), by long division; counts and wholes below LARGEST."""
    out, rest = np.divmod(count, whole)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + more
    return out + 1


def _pair_sums(terms: DataFrame) -> DataFrame:
    """lang, i, j, value: the sum of differences between sources i < j, over rows (lang, wholes,
    held, counts) of one kept term each: the wholes of all sources, and which of them hold it how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                rows = batch.filter(pc.equal(langs.indices, code))
                wholes = rows.column("wholes")[0].values.to_numpy()
                size = len(wholes)
                total = sums.setdefault(lang, np.zeros((size, size), np.int64))
                step = max(1, CELLS // max(size, 1))
                for at in range(0, rows.num_rows, step):
                    some = rows.slice(at, step)
                    count = np.zeros((some.num_rows, size), np.int64)
                    held = some.column("held")
                    count[pc.list_parent_indices(held).to_numpy(), held.flatten().to_numpy()] = some.column("counts").flatten().to_numpy()
                    p = np.ascontiguousarray(parts(count + ADDED, wholes).T)
                    for i in range(size - 1):
                        total[i, i + 1 :] += np.abs(p[i + 1 :] - p[i]).sum(1)
        for lang, total in sums.items():
            i, j = np.triu_indices(len(total), 1)
            for at in range(0, len(i), 65536):
                cut = slice(at, at + 65536)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(i[cut]), pa.string()), "i": i[cut].astype(np.int64), "j": j[cut].astype(np.int64), "value": total[i[cut], j[cut]]})

    return terms.mapInArrow(run, "lang string, i long, j long, value long").groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least: int = 30, top: int = 50) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value and rank, of docs (lang, source, text)."""
    counts = stored(shards(docs, least))
    term = ~F.col("term").startswith(" ")
    terms = counts.where(term)
    # One row a group, and one a language with its groups in order.
    own = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    of_lang = counts.groupBy("lang").agg(F.count_if(term & F.col("first")).alias("v"), F.sum("n").alias("all"))
    sized = own.join(of_lang, "lang")
    whole = F.col("n") + ADDED * F.col("v")
    checked = F.when(F.col("all") + ADDED * F.col("v") < LARGEST, whole).otherwise(F.raise_error(F.lit("too many words for exact frequencies")).cast("long"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = stored(sized.select("lang", "source", place.cast("long").alias("i"), checked.alias("whole"), (F.col("all") + ADDED * F.col("v")).alias("lang_whole")))

    listed = groups.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("i", "whole"))).alias("g")).select("lang", F.col("g.whole").alias("wholes"))
    placed = terms.join(groups.select("lang", "source", "i", "whole", "lang_whole"), ["lang", "source"])
    held = placed.groupBy("lang", "term").agg(F.collect_list(F.struct("i", "n")).alias("c")).select("lang", F.col("c.i").alias("held"), F.col("c.n").alias("counts"))
    sums = _pair_sums(held.join(listed, "lang").select("lang", "wholes", "held", "counts"))
    one, other = groups.select("lang", "source", "i"), groups.select("lang", F.col("source").alias("item"), F.col("i").alias("j"))
    both = one.join(other, "lang").where("i <> j").withColumns({"low": F.least("i", "j"), "high": F.greatest("i", "j")})
    found = both.join(sums.select("lang", F.col("i").alias("low"), F.col("j").alias("high"), "value"), ["lang", "low", "high"], "left")
    pairs = found.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [pairs.withColumn("rank", F.row_number().over(order))]
    p, q = (_parts(F.col(c) + ADDED, F.col(w)) for c, w in (("n", "whole"), ("of_lang", "lang_whole")))
    likelier = placed.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (p - q).alias("value")).where("value > 0")
    # Tasks keep their own first rows before any move.
    ranked.append(likelier.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))
    return ranked[0].unionByName(ranked[1])


def _parts(count: Column, whole: Column) -> Column:
    """`parts` in Spark's integers."""
    out, rest = F.call_function("div", count, whole), F.pmod(count, whole)
    for _ in range(3):
        out = out * 1000 + F.call_function("div", rest * 1000, whole)
        rest = F.pmod(rest * 1000, whole)
    return out + 1
