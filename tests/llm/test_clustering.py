import hashlib
import random

import numpy as np
import pytest
from compare import assert_same, open_database

from revtide.llm import clustering as c
from revtide.llm.oracle_sql import ORACLE_SQL
from revtide.llm.queries import QUERIES


def brute(rows, k, rounds, size, scale):
    """Every vector against every centroid, in Python's integers."""
    kept = []
    for vec_id, x in rows:
        if x is not None and len(x) == size and all(v is not None and abs(v) < float("inf") for v in x):
            kept.append((vec_id, [int(np.floor(scale * v)) for v in x]))
    start = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), p) for i, p in kept if i is not None)
    centroids = [p for _, p in start[:k]]

    def assigned():
        return [min((sum((a - b) ** 2 for a, b in zip(p, m)), j) for j, m in enumerate(centroids)) for _, p in kept]

    for _ in range(rounds):
        found = assigned()
        for j in range(len(centroids)):
            own = [p for (_, p), (_, w) in zip(kept, found) if w == j]
            if own:
                centroids[j] = [sum(v) // len(own) for v in zip(*own)]
    found = assigned()
    digests = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in centroids]
    total = sum(d for d, _ in found)
    of = [sum(d for d, w in found if w == j) for j in range(len(centroids))]
    return sorted(((i is None, i or 0), w, d, of[w], total, digests[w]) for (i, _), (d, w) in zip(kept, found))


def made(df):
    return sorted(((r[0] is None, r[0] or 0), *r[1:]) for r in df.collect())


def vectors(spark, rows):
    return spark.createDataFrame([(i, x, "no", 7) for i, x in rows], "vec_id long, embedding array<double>, cluster string, distance int")


@pytest.mark.parametrize("k, rounds", [(16, 3), (40, 2), (3, 0)])
def test_as_brute_force(spark, k, rounds):
    rng = random.Random(k)
    rows = [(n, [rng.choice([rng.gauss(0, 1), 0.0, -0.5]) for _ in range(6)]) for n in range(400)]
    rows += [rows[3], rows[3], (None, rows[5][1]), (900, None), (901, []), (902, [1.0] * 5), (903, [None] + [1.0] * 5), (904, [float("nan")] * 6), (905, [float("inf")] + [0.0] * 5)]
    df = c.clusters(vectors(spark, rows).repartition(5), k=k, rounds=rounds, size=6, scale=4)
    assert df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert made(df) == brute(rows, k, rounds, 6, 4)


def test_ties_go_to_the_smaller_number(spark):
    rows = [(n, [float(n % 3 - 1), 0.0]) for n in range(60)]
    assert made(c.clusters(vectors(spark, rows), k=16, rounds=3, size=2, scale=2)) == brute(rows, 16, 3, 2, 2)


def test_fewer_vectors_than_clusters_and_none(spark):
    rows = [(1, [1.0, 2.0]), (2, [-3.0, 0.1])]
    assert made(c.clusters(vectors(spark, rows), size=2)) == brute(rows, 16, 3, 2, 64)
    empty = c.clusters(vectors(spark, rows).limit(0), size=2)
    assert empty.collect() == [] and empty.columns[-1] == "centroid_sha256"


def test_tree_finds_the_nearest_and_prunes():
    rng = np.random.default_rng(3)
    places = rng.integers(-4000, 4000, (300, 3))
    points = places[rng.integers(0, 300, 4000)] + rng.integers(-30, 30, (4000, 3))
    centroids = np.concatenate([places, places[:20]])  # the last ones tie with the first
    where, best, taken = c.nearest(c.build(centroids), points)
    apart = ((points[:, None] - centroids[None]) ** 2).sum(2)
    assert (where == apart.argmin(1)).all() and (best == apart.min(1)).all()
    assert taken < 0.25 * apart.size
    far = np.full((2, 3), 2**26)
    assert c.nearest(c.build(centroids), far)[1].tolist() == ((far[:1] - centroids) ** 2).sum(1).min().repeat(2).tolist()


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        c.clusters(vectors(spark, [(1, [1e9, 0.0])]), size=2).collect()


def test_as_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert_same(QUERIES["op12_centroid_clusters"](spark, folder), open_database(folder), ORACLE_SQL["op12_centroid_clusters"])
