"""Connected components of links, by stars: distributed, with a written table a round."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.llm.common import stored


class Forest:
    """Sets of linked numbers 0..n-1; each is named by its smallest."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, k: int) -> int:
        parent = self.parent
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    def link(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b

    def roots(self) -> np.ndarray:
        return np.array([self.root(k) for k in range(len(self.parent))], np.int64)


def _thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each batch's links, as many as join the same nodes: one a node to its smallest."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (batch.column(k).to_numpy() for k in (0, 1))
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        forest = Forest(len(nodes))
        for x, y in zip(at[: len(a)].tolist(), at[len(a) :].tolist()):
            forest.link(x, y)
        roots = forest.roots()
        more = roots != np.arange(len(nodes))
        yield pa.RecordBatch.from_pydict({"u": nodes[more], "v": nodes[roots[more]]})


#: Links a written file, where there are as many.
FILE_LINKS = 20_000

#: A node of this many links, or of this share of all of them, is a hub.
HUB_LINKS, HUB_SHARE = 1_000, 1e-4


def _with_least(links: DataFrame, key: str, least: DataFrame, total: int) -> DataFrame:
    """Each link with m, the smallest neighbour of its end `key`, or null.

    Links of hubs stay where they are: a hub holds one ten-thousandth of all links or more, so
    there are ten thousand of them at most, and their rows of `least` are broadcast.
    """
    many = links.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") >= max(HUB_LINKS, HUB_SHARE * total)).select(key)
    hubs = F.broadcast(many.join(least, key, "left").withColumn("hub", F.lit(True)))
    marked = links.join(hubs.withColumnRenamed("m", "of_hub"), key, "left")
    others = marked.where("hub is null").select(*links.columns).join(least, key, "left").select(*links.columns, "m")
    return marked.where("hub").select(*links.columns, F.col("of_hub").alias("m")).unionByName(others)


def _large_star(links: DataFrame, total: int) -> DataFrame:
    """Moves each link's smaller end to that one's smallest neighbour, if it is smaller still."""
    least = links.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m"))
    return _with_least(links, "v", least, total).select("u", F.coalesce("m", "v").alias("v")).distinct()


def _small_star(links: DataFrame, total: int) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = _with_least(links, "u", least, total).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", "m")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node and component (its smallest node) of all nodes in links, two columns of longs.

    Links of a node to itself and nulls are left out. A node of any degree is summed up
    before it is shuffled, and the links of one of many never meet in a task.
    """
    a, b = links.columns
    pairs = links.where(F.col(a) != F.col(b)).select(F.col(a).cast("long"), F.col(b).cast("long"))
    pairs = stored(pairs.mapInArrow(_thinned, "u long, v long"))
    before = None
    while True:
        # Every link has u > v; both kinds of star keep that.
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if now == before or not now[0]:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(pairs.select("v", "v").distinct())
        before = now
        # Neither star makes more links than there were.
        for star in (_large_star, _small_star):
            pairs = stored(star(pairs, now[0]), now[0], FILE_LINKS)
