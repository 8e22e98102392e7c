"""Embedding near-duplicates: a pigeonhole join over blocks of rotated coordinates.

Unit vectors of cosine t or more lie within squared distance 2 - 2t. After a random
rotation the coordinates are cut into blocks; as squared distances add up, one block at
least stays within its share of the budget. Each block is range-joined: vectors are dealt
into slices of its first coordinate as wide as the share's root, and a slice meets the next
one. A pair within the share is then confirmed by its cosine in double precision, in the
first block that finds it. Equal vectors are one node; a slice of many nodes is split into
chunks that meet in pairs. Tasks return sums and spanning links, not pairs.

Defined results. Null label, null or zero vector, or one with null or non-finite parts:
linked with nothing. Vectors of different lengths: never compared. Null id: linked with
nothing, null component, kept. Rows of one id and vector: one vector. Empty table: no
rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.llm.common import grouped, stored
from revtide.llm.components import Forest, components

#: Coordinates of a block; nodes of a chunk.
BLOCK = 8
CHUNK = 2048
#: Room for rounding, in squared distance.
ROOM = 1e-6


def rotation(size: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(size).normal(size=(size, size)))[0]


def rotated(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors, rotated; each row's result does not depend on the others."""
    unit = vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))
    out = np.zeros_like(unit)
    for k, row in enumerate(rotation(vectors.shape[1])):
        out += unit[:, k, None] * row
    return out


def blocks_of(size: int) -> list[slice]:
    return [slice(k, min(k + BLOCK, size)) for k in range(0, size, BLOCK)]


def share(block: slice, size: int, least: float) -> float:
    """A block's part of the squared distance that cosine `least` allows."""
    return (2 - 2 * least) * (block.stop - block.start) / size


def _checked(kind: str):
    """Vectors as bytes of their own kind of number; null where they can't be linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, label, name in zip(batch.column("embedding").to_pylist(), batch.column("label"), batch.column("vec_id")):
                vector = None
                if row and label.is_valid and name.is_valid and None not in row:
                    x = np.array(row, np.float64)
                    with np.errstate(over="ignore"):
                        norm = x @ x
                    if np.isfinite(x).all() and 0 < norm < np.inf:
                        vector = (x + 0.0).astype(kind).tobytes()
                out.append(vector)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(out, pa.binary())], ["vec_id", "label", "vector"])

    return run


def _numbers(column: pa.Array, size: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, size).astype(np.float64)


def _sliced(least: float, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(x) // int(kind[1]) for x in batch.column("vector").to_pylist()])
            for size in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                turned = rotated(_numbers(part.column("vector"), size, kind))
                for k, block in enumerate(blocks_of(size)):
                    home = np.floor(turned[:, block.start] / np.sqrt(share(block, size, least) + ROOM)).astype(np.int64)
                    for guest in (False, True):
                        n = len(home)
                        yield pa.RecordBatch.from_arrays(
                            [
                                *(part.column(c) for c in ("label", "node", "copies", "vector")),
                                pa.array(np.full(n, size, np.int32)),
                                pa.array(np.full(n, k, np.int32)),
                                pa.array(home - guest),
                                pa.array(np.full(n, guest)),
                            ],
                            ["label", "node", "copies", "vector", "size", "block", "slice", "guest"],
                        )

    return run


def _joined(group: pa.Table, least: float, kind: str) -> pa.RecordBatch | None:
    """Of each node that is linked in a pair of chunks: copies linked to, and a node it hangs on."""
    size, block = group.column("size")[0].as_py(), group.column("block")[0].as_py()
    left, right = group.column("left")[0].as_py(), group.column("right")[0].as_py()
    node, copies, chunk, guest = (group.column(c).to_numpy() for c in ("node", "copies", "chunk", "guest"))
    vectors = _numbers(group.column("vector"), size, kind)
    lengths = np.sqrt((vectors * vectors).sum(1))
    turned = rotated(vectors)
    cuts = blocks_of(size)
    own = turned[:, cuts[block]]
    norms = (own * own).sum(1)
    rows, others = np.flatnonzero(chunk == left), np.flatnonzero(chunk == right)
    forest, links, linked = Forest(len(node)), np.zeros(len(node), np.int64), np.zeros(len(node), bool)
    for k in range(0, len(rows), 512):
        part = rows[k : k + 512]
        distance = norms[part, None] + norms[None, others] - 2 * own[part] @ own[others].T
        a, b = np.nonzero(distance <= share(cuts[block], size, least) + 10 * ROOM)
        a, b = part[a], others[b]
        good = ~(guest[a] & guest[b]) & (a < b if left == right else True)
        a, b = a[good], b[good]
        found = np.ones(len(a), bool)
        for earlier in range(block + 1):
            cut = cuts[earlier]
            inside = np.zeros(len(a))
            for c in range(cut.start, cut.stop):
                inside += (turned[a, c] - turned[b, c]) ** 2
            inside = inside <= share(cut, size, least) + ROOM
            found &= inside if earlier == block else ~inside
        a, b = a[found], b[found]
        cosine = (vectors[a] * vectors[b]).sum(1) / (lengths[a] * lengths[b])
        a, b = a[cosine >= least], b[cosine >= least]
        links += np.bincount(a, copies[b], len(node)).astype(np.int64) + np.bincount(b, copies[a], len(node)).astype(np.int64)
        linked[a] = linked[b] = True
        for x, y in zip(a.tolist(), b.tolist()):
            forest.link(x, y)
    if not linked.any():
        return None
    return pa.RecordBatch.from_pydict({"node": node[linked], "links": links[linked], "other": node[forest.roots()[linked]]})


def embedding_duplicates(vectors: DataFrame, least: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row of vectors (vec_id, embedding, label)."""
    floats = vectors.schema["embedding"].dataType.elementType.typeName() == "float"
    kind = "f4" if floats else "f8"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    known = stored(rows.mapInArrow(_checked(kind), "vec_id long, label string, vector binary"))
    nodes = stored(
        known.where("vector is not null").distinct().groupBy("label", "vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    )
    sliced = nodes.select("label", "node", "copies", "vector").mapInArrow(
        _sliced(least, kind), "label string, node long, copies long, vector binary, size int, block int, slice long, guest boolean"
    )
    place = ["label", "size", "block", "slice"]
    chunks = sliced.groupBy(*place).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"), F.min("guest").alias("empty")).where("not empty")
    pairs = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda t: F.struct(F.least(t, "chunk").alias("left"), F.greatest(t, "chunk").alias("right")))
    dealt = (
        sliced.join(chunks, place)
        .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
        .withColumn("pair", F.explode(pairs))
        .select(F.xxhash64(*place, "pair").alias("meeting"), *place, "pair.left", "pair.right", "chunk", "guest", "node", "copies", "vector")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, [*place, "left", "right"]):
            out = _joined(group, least, kind)
            if out is not None:
                yield out

    key = [*place, "left", "right"]
    found = stored(dealt.repartition("meeting").sortWithinPartitions(*key, "node").mapInArrow(run, "node long, links long, other long"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    hanging = components(found.where("node != other").select("node", "other"))
    own = nodes.join(links, "node", "left").join(hanging, "node", "left")
    own = own.select(
        F.col("label").alias("_label"),
        F.col("vector").alias("_vector"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
        F.coalesce("component", "node").alias("component_id"),
    )
    return (
        known.join(own, (F.col("label") == F.col("_label")) & (F.col("vector") == F.col("_vector")), "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
