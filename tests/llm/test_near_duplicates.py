import random
import re
import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa

from revtide.llm import near_duplicates as near
from revtide.llm.components import components


def shingle_set(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def expected(rows, percent=85):
    """Brute force over inverted shingles: doc_id to (n_shingles, component)."""
    sets = {d: shingle_set(t) for d, t in rows}
    holders = defaultdict(list)
    for d, own in sets.items():
        for x in own:
            holders[x].append(d)
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    common = defaultdict(int)
    for own in holders.values():
        own.sort()
        for k, a in enumerate(own):
            for b in own[k + 1 :]:
                common[a, b] += 1
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(own), root(d)) for d, own in sets.items()}


def check(df, rows, percent=85):
    made = {r.doc_id: (r.n_shingles, r.component_id) for r in near.near_duplicates(df, percent).collect()}
    assert made == expected(rows, percent)


def test_documents_as_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    check(docs, [tuple(r) for r in docs.collect()])


def test_edges_of_the_definition(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b c"), (5, "A B\tC"), (6, "a b c d e"), (7, "a b c d e f"), (8, "x y z"), (9, "É b c"), (10, "é b c")]
    df = spark.createDataFrame([(*r, "clash", r[0]) for r in rows], "doc_id long, text string, node string, key long")
    check(df, rows)


def test_nulls_and_repeated_ids(spark):
    text = " ".join(map(str, range(50)))
    rows = [(None, text), (None, text), (2, text), (2, text), (3, text + " z"), (4, "other words"), (3, "other words")]
    made = sorted(map(tuple, near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert made == sorted([(None, 46, None, True), (None, 46, None, True), (2, 46, 2, True), (2, 46, 2, True), (3, 47, 2, False), (4, 1, 2, False), (3, 1, 2, False)], key=str)


def test_empty_table(spark):
    assert near.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_large_group_in_blocks(spark, monkeypatch):
    """A group of many unequal near copies, some linked and some not, larger than a block."""
    monkeypatch.setattr(near, "BLOCK", 16)
    rng = random.Random(5)
    base = [str(rng.random()) for _ in range(60)]
    rows = []
    for k in range(90):
        words = list(base)
        for _ in range(rng.choice((0, 1, 1, 2, 3))):
            words[rng.randrange(60)] = f"w{k}{rng.random()}"
        rows.append((k, " ".join(words)))
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def altered(rng, words, n, mark):
    words = list(words)
    for k in rng.sample(range(len(words)), n):
        words[k] = f"{mark}{rng.random()}"
    return words


def classes_of(spark, rows):
    known = near.sketch(spark.createDataFrame(rows, "doc_id long, text string"))
    return known.select(known.doc_id.alias("node"), "signature")


def test_weak_likeness_chains_no_groups(spark):
    """Each text is like the next one by 0.5: bands are shared all along, similar is none."""
    rng = random.Random(8)
    stream = [f"w{rng.random()}" for _ in range(100 * 301)]
    rows = [(k, " ".join(stream[100 * k : 100 * k + 300])) for k in range(299)]
    bands = classes_of(spark, rows).mapInArrow(near._bands, "key long, node long")
    assert bands.groupBy("key").count().where("count > 1").count() > 200
    assert near.candidate_groups(classes_of(spark, rows), 85, near.MISS).count() == 0
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_groups_do_not_hang_on_a_buckets_first(spark):
    """Pairs that are similar to each other and not to the smallest node of their bucket."""
    rng = random.Random(9)
    rows = []
    for group in range(12):
        base = [f"g{group}x{k}" for k in range(400)]
        rows.append((100 * group, " ".join(altered(rng, base, 40, "a"))))
        for k in range(1, 15):
            family = altered(random.Random(1000 * group + k % 4), base, 45, "f")
            rows.append((100 * group + k, " ".join(altered(rng, family, 2, "n"))))
    made = near.candidate_groups(classes_of(spark, rows), 85, near.MISS).collect()
    group_of = {r.node: r.candidates for r in made}
    wanted = expected(rows)
    assert len({c for _, c in wanted.values()}) > 30
    assert all(group_of[d] == group_of[c] for d, (_, c) in wanted.items() if c != d)
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), rows)


def test_bucket_links_join_what_passes(spark):
    """Against all pairs of each bucket, over several batches and bucket sizes."""
    rng = np.random.default_rng(4)
    centres = rng.integers(0, 2**32, (5, near.SIGNATURE), np.uint32)
    keys = np.sort(rng.integers(0, 60, 700))
    keys[200:420] = keys[200]
    keys.sort()
    values = np.where(rng.random((700, near.SIGNATURE)) < 0.93, centres[rng.integers(0, 5, 700)], rng.integers(0, 2**32, (700, near.SIGNATURE), np.uint32))
    nodes = np.arange(700) * 3
    batch = pa.RecordBatch.from_pydict({"key": keys, "node": nodes, "signature": [v.tobytes() for v in values]})
    tables = list(near._whole_buckets(iter([batch.slice(k, 90) for k in range(0, 700, 90)])))
    assert sum(t.num_rows for t in tables) == 700
    made, want = near.Forest(700 * 61), near.Forest(700 * 61)
    links = 0
    for table in tables:
        own = table.column("key").to_numpy()
        assert not set(own) & {k for t in tables if t is not table for k in t.column("key").to_pylist()}
        for a, b in zip(*near._bucket_links(table, 85, near.MISS)):
            assert keys[a // 3] == keys[b // 3]
            links += made.link(int(a // 3), int(b // 3))
    for key in set(keys.tolist()):
        rows = np.flatnonzero(keys == key)
        x, y = np.triu_indices(len(rows), 1)
        for k in near.likely(values[rows[x]], values[rows[y]], 85, near.MISS):
            want.link(int(rows[x[k]]), int(rows[y[k]]))
    assert made.roots().tolist() == want.roots().tolist() and links > 300


def test_large_buckets_are_groups(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 4)
    rng = random.Random(10)
    base = [f"b{k}" for k in range(200)]
    rows = [(k, " ".join(altered(rng, base, k % 7, "n"))) for k in range(60)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_sequential_test_keeps_similar_pairs():
    rng = np.random.default_rng(3)
    pairs = 20_000
    left = rng.integers(0, 2**32, (pairs, near.SIGNATURE), np.uint32)
    for similar, least, most in ((0.85, 0.999, 1), (0.5, 0, 0.001)):
        right = np.where(rng.random(left.shape) < similar, left, left + np.uint32(1))
        assert least <= len(near.likely(left, right, 85, near.MISS)) / pairs <= most


def test_components_of_a_chain_and_a_hub(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(500 + k, 300) for k in range(50)] + [(7, 7), (9, None)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long").repartition(8)).collect()}
    assert found == {k: 100 for k in range(100, 161)} | {k: 300 for k in [300, *range(500, 550)]}


def test_components_with_hubs(spark, monkeypatch):
    """Hubs on both ends of links, found with every node of three links taken for one."""
    import random

    from revtide.llm import components as c

    monkeypatch.setattr(c, "HUB_LINKS", 3)
    rng = random.Random(5)
    links = [(k, 7) for k in range(8, 400, 3)] + [(900, k) for k in range(1000, 1100)] + [(k, k + 1) for k in range(2000, 2040)]
    links += [(rng.randrange(5000, 5200), rng.randrange(5000, 5200)) for _ in range(150)] + [(399, 399), (None, 4)]
    forest = c.Forest(6000)
    for a, b in links:
        if a is not None:
            forest.link(a, b)
    nodes = {x for a, b in links if a != b and a is not None for x in (a, b)}
    made = c.components(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()
    assert {r.node: r.component for r in made} == {x: forest.root(x) for x in nodes} and len(made) == len(nodes)


def near_copies(n, rng, size=300):
    base = rng.integers(0, 2**63, size, np.uint64)
    sets = []
    for _ in range(n):
        own = base.copy()
        at = rng.choice(size, 6, replace=False)
        own[at] = rng.integers(0, 2**63, 6, np.uint64)
        sets.append(np.sort(own).tobytes())
    return {"node": np.arange(n), "grams": pa.array(sets, pa.binary())}


def test_group_of_near_copies_takes_little_memory():
    """A full block, and two blocks whose rows meet across; all pairs of either held at once take 600 and 1,300 MB."""
    rng = np.random.default_rng(6)
    block = pa.table(near_copies(near.BLOCK, rng))
    two = pa.table(near_copies(2 * near.BLOCK, rng) | {"side": np.arange(2 * near.BLOCK) % 2, "label": np.arange(2 * near.BLOCK) // 4})
    for table, across, links in ((block, False, near.BLOCK - 1), (two, True, near.BLOCK // 2 - 1)):
        tracemalloc.start()
        a, _ = near._links_of(table, 80, near.MISS, across)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(a) == links and peak < 100e6


def test_bucket_of_unlike_signatures_takes_little_memory():
    values = np.random.default_rng(7).integers(0, 2**32, (near.BLOCK, near.SIGNATURE), np.uint32)
    table = pa.table({"key": np.zeros(near.BLOCK, np.int64), "node": np.arange(near.BLOCK), "signature": pa.array([v.tobytes() for v in values], pa.binary())})
    tracemalloc.start()
    a, _ = near._bucket_links(table, 80, near.MISS)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert not len(a) and peak < 60e6
