"""Centroid clustering with a vantage-point tree over the centroids.

Vectors become integers. Each round builds a vantage-point tree over the centroids on the
driver and broadcasts it; tasks look up every vector's nearest centroid by best-first
branch-and-bound, and send one sum a cluster and component. A block of vectors descends
together, but each has its own best distance and its own order of nodes: in every step each
vector takes the pending node of its lowest bound, until that bound exceeds the radius of
its best centroid. The radius is inclusive and widened by more than the bounds' rounding, so
a centroid at an equal distance is always met; leaf distances are exact integers, and of
equal ones the smaller number wins.

The driver holds the centroids and their sums: as many rows as clusters times components,
however many vectors there are.

Defined results. Vectors that are null, hold a null or non-finite component or another number
of components than asked for: no row. Null id: assigned as any other, never a starting
centroid. Repeated rows: each is assigned and counts; of equal hashes the smaller components start
first. Fewer vectors than clusters: as many clusters as vectors. Components of 2**27 and more
(after scaling): an error, as squared distances would leave 64 bits. Empty table: no rows.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revtide.llm.common import stored

#: Centroids in a leaf of the tree, at most.
LEAF = 4
#: Bounds of vectors and nodes, and components of vectors, that one step works on.
CELLS = 1 << 20
LARGEST = 2**27
#: Relative rounding error that bounds are allowed for.
SLACK = 1e-9


@dataclass
class Tree:
    """Nodes in order of making. Inner nodes have a vantage centroid, and of each child the
    least and the largest distance of its centroids from it; leaves list centroids."""

    centroids: np.ndarray
    vantage: list[int]
    children: list[tuple[tuple[int, float, float], ...]]
    members: list[np.ndarray]


def distances(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances."""
    apart = vectors - centroid
    return np.einsum("ij,ij->i", apart, apart)


def build(centroids: np.ndarray) -> Tree:
    """A tree over all centroids; the vantage point of a node is its centroid farthest from the mean."""
    tree = Tree(centroids, [], [], [])

    def add(members: np.ndarray) -> int:
        node = len(tree.vantage)
        tree.vantage.append(-1)
        tree.children.append(())
        tree.members.append(members)
        if len(members) <= LEAF:
            return node
        points = centroids[members].astype(np.float64)
        at = int(np.argmax(((points - points.mean(0)) ** 2).sum(1)))
        vantage, others = members[at], np.delete(members, at)
        apart = np.sqrt(distances(centroids[others], centroids[vantage]).astype(np.float64))
        order = np.argsort(apart, kind="stable")
        halves = np.split(order, [len(order) // 2])
        tree.vantage[node], tree.members[node] = int(vantage), members[:0]
        tree.children[node] = tuple((add(others[x]), float(apart[x].min()), float(apart[x].max())) for x in halves)
        return node

    add(np.arange(len(centroids)))
    return tree


def nearest(tree: Tree, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of each vector's nearest centroid; and how many distances it took."""
    n, nodes = len(vectors), len(tree.vantage)
    best, where = np.full(n, np.iinfo(np.int64).max), np.full(n, len(tree.centroids))
    bounds = np.full((n, nodes), np.inf)
    bounds[:, 0] = 0
    radius = np.full(n, np.inf)
    active, taken = np.arange(n), 0
    while len(active):
        node = bounds[active].argmin(1)
        least = bounds[active, node]
        # Inclusive, and wide enough for the rounding of roots and differences.
        go = np.isfinite(least) & (least <= radius[active])
        active, node = active[go], node[go]
        bounds[active, node] = np.inf
        for k in np.unique(node).tolist():
            rows = active[node == k]
            for c in [tree.vantage[k]] if tree.vantage[k] >= 0 else tree.members[k].tolist():
                found = distances(vectors[rows], tree.centroids[c])
                taken += len(rows)
                nearer = (found < best[rows]) | ((found == best[rows]) & (c < where[rows]))
                best[rows[nearer]], where[rows[nearer]] = found[nearer], c
            radius[rows] = np.sqrt(best[rows].astype(np.float64)) * (1 + SLACK) + SLACK
            if tree.vantage[k] >= 0:
                away = np.sqrt(found.astype(np.float64))
                for child, low, high in tree.children[k]:
                    bound = np.maximum(np.maximum(away - high, low - away), 0)
                    # Of two large roots the difference is as far off as the roots are.
                    bounds[rows, child] = np.maximum(bound - SLACK * (away + high), 0)
    return where, best, taken


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _blocks(batches: Iterator[pa.RecordBatch], nodes: int, size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    step = max(1, CELLS // max(nodes, size))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield part, _matrix(part.column("point"), size)


def points(vectors: DataFrame, size: int, scale: int) -> DataFrame:
    """vec_id and point (integers) of the vectors that count, of vectors (vec_id, embedding)."""
    x = F.col("embedding").cast("array<double>")
    good = F.coalesce(F.size(x) == size, F.lit(False)) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    kept = vectors.where(good).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))

    def whole(v):
        up = F.floor(v * scale)
        return F.when(F.abs(v * scale) < LARGEST, up).otherwise(F.raise_error(F.lit("a component is too large for exact distances")).cast("long"))

    return kept.select("vec_id", F.transform("x", whole).alias("point"))


def first_centroids(kept: DataFrame, k: int) -> np.ndarray:
    """The k points of the smallest hashes of their ids."""
    mark = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256).alias("mark")
    rows = kept.where("vec_id is not null").select(mark, "point").orderBy("mark", "point").limit(k).collect()
    return np.array([r["point"] for r in rows], np.int64)


def moved(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid at the floor of its vectors' mean; without vectors it stays."""
    spark, size = kept.sparkSession, centroids.shape[1]
    sent = spark.sparkContext.broadcast(build(centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = sent.value
        sums, counts = np.zeros(tree.centroids.shape, np.int64), np.zeros(len(tree.centroids), np.int64)
        for _, vectors in _blocks(batches, len(tree.vantage), size):
            where, _, _ = nearest(tree, vectors)
            order = np.argsort(where, kind="stable")
            found, begins = np.unique(where[order], return_index=True)
            sums[found] += np.add.reduceat(vectors[order], begins, axis=0)
            counts += np.bincount(where, minlength=len(counts))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {
                "cluster": pa.array(np.repeat(some, size), pa.int64()),
                "place": pa.array(np.tile(np.arange(size), len(some)), pa.int64()),
                "total": pa.array(sums[some].ravel(), pa.int64()),
                "n": pa.array(np.repeat(counts[some], size), pa.int64()),
            }
        )

    parts = kept.select("point").mapInArrow(run, "cluster long, place long, total long, n long")
    exact = T.DecimalType(38, 0)
    rows = parts.groupBy("cluster", "place").agg(F.sum(F.col("total").cast(exact)).alias("total"), F.sum(F.col("n").cast(exact)).alias("n")).collect()
    out = centroids.copy()
    for r in rows:
        out[r["cluster"], r["place"]] = int(r["total"]) // int(r["n"])
    sent.unpersist()
    return out


def clusters(vectors: DataFrame, k: int = 16, rounds: int = 3, size: int = 64, scale: int = 64) -> DataFrame:
    """vec_id, cluster, distance (squared) and the cluster's figures, of each vector that counts.

    Each round reads the stored points again; nothing but sums leaves the tasks.
    """
    spark = vectors.sparkSession
    kept = stored(points(vectors, size, scale))
    schema = "vec_id long, cluster int, distance long"
    centroids = first_centroids(kept, k)
    if not len(centroids):
        return spark.createDataFrame([], f"{schema}, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        centroids = moved(kept, centroids)
    sent = spark.sparkContext.broadcast(build(centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = sent.value
        for part, vectors_ in _blocks(batches, len(tree.vantage), size):
            where, best, _ = nearest(tree, vectors_)
            yield pa.RecordBatch.from_pydict({"vec_id": part.column("vec_id"), "cluster": pa.array(where, pa.int32()), "distance": best})

    assigned = stored(kept.mapInArrow(run, schema))
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast(T.DecimalType(38, 0))).cast("long").alias("n")).collect()
    own = {r["cluster"]: r["n"] for r in sums}
    # One row a cluster.
    figures = [(c, own.get(c, 0), sum(own.values()), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for c, x in enumerate(centroids.tolist())]
    told = spark.createDataFrame(figures, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
