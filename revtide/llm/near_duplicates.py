"""Near-duplicate documents: MinHash bands, sequential Bayesian verification, exact sets."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.llm.common import SMALL_STEP_BYTES, gram_hashes, grouped, mixed, random_odd, steps, stored, text_bytes, within, word_hashes, word_spans
from revtide.llm.components import Forest, components

SHINGLE = 5
BANDS, ROWS = 24, 5
SIGNATURE = BANDS * ROWS
_FACTORS = random_odd(11, SIGNATURE)


def shingles(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted, and where each text's begin (one more at the end)."""
    data, offsets = text_bytes(part.column("text"))
    starts, ends, bounds = word_spans(data, offsets)
    words = word_hashes(data, starts, ends, lower=True)
    good = within(bounds, SHINGLE)
    grams = gram_hashes(words, SHINGLE)[good]
    counts = np.maximum(np.diff(bounds) - SHINGLE + 1, 0)
    own = np.repeat(np.arange(len(counts)), counts)
    few = np.flatnonzero((np.diff(bounds) > 0) & (counts == 0))
    if len(few):
        whole = [gram_hashes(words[bounds[k] : bounds[k + 1]], int(bounds[k + 1] - bounds[k]))[0] for k in few]
        grams = np.concatenate([grams, mixed(np.array(whole, np.uint64))])
        own = np.concatenate([own, few])
    order = np.lexsort((grams, own))
    grams, own = grams[order], own[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (own[1:] != own[:-1])
    grams, own = grams[new], own[new]
    return grams, np.searchsorted(own, np.arange(len(counts) + 1))


def signatures(grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of SIGNATURE minima for each text that has shingles."""
    begins = bounds[:-1][np.diff(bounds) > 0]
    out = np.empty((len(begins), SIGNATURE), np.uint32)
    if len(begins):
        for k, factor in enumerate(_FACTORS):
            out[:, k] = np.minimum.reduceat(grams * factor, begins) >> np.uint64(32)
    return out


#: A pair is dropped as soon as the chance that it is similar enough falls below this.
MISS = 1e-5
#: Signature values compared at a time.
BATCH = 20
#: Rows of a candidate group that one task compares with each other.
BLOCK = 1024


@lru_cache(maxsize=8)
def least_matches(percent: int, miss: float) -> tuple[int, ...]:
    """Fewest equal values after each batch with which a pair may still be similar.

    Under a uniform prior the chance that the similarity is at least t, with m of n values
    equal, is the chance of at most m successes in n + 1 trials of probability t.
    """
    t = percent / 100
    out = []
    for n in range(BATCH, SIGNATURE + 1, BATCH):
        chance, m = 0.0, 0
        while True:
            chance += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if chance >= miss:
                break
            m += 1
        out.append(m)
    return tuple(out)


def likely(left: np.ndarray, right: np.ndarray, percent: int, miss: float) -> np.ndarray:
    """Indexes of the row pairs of two signature tables that no batch rules out."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    for k, least in enumerate(least_matches(percent, miss)):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches = matches + (left[alive, part] == right[alive, part]).sum(1)
        good = matches >= least
        alive, matches = alive[good], matches[good]
    return alive


#: Pairs whose signatures or bands are laid side by side at a time.
PAIRS = 1 << 14


def likely_pairs(values: np.ndarray, x: np.ndarray, y: np.ndarray, percent: int, miss: float) -> np.ndarray:
    """Indexes of the pairs (x, y) of rows of a signature table that no batch rules out."""
    parts = (slice(k, k + PAIRS) for k in range(0, len(x), PAIRS))
    found = [likely(values[x[p]], values[y[p]], percent, miss) + p.start for p in parts]
    return np.concatenate(found) if found else np.empty(0, np.int64)


def band_keys(values: np.ndarray) -> np.ndarray:
    """Hash of each band of each signature."""
    out = np.empty((len(values), BANDS), np.uint64)
    for k in range(BANDS):
        own = np.full(len(values), k, np.uint64)
        for x in values[:, k * ROWS : (k + 1) * ROWS].T:
            own = mixed(own ^ x.astype(np.uint64)) + np.uint64(k)
        out[:, k] = own
    return out


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, two checksums of the shingle set (null if empty) and the signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, size=SMALL_STEP_BYTES):
            grams, bounds = shingles(part)
            some = np.diff(bounds) > 0
            sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(grams ^ np.uint64(x)))]) for x in (0x9E37, 0x79B9)]
            low, high = ((x[bounds[1:]] - x[bounds[:-1]]).view(np.int64) for x in sums)
            rows = iter(signatures(grams, bounds))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column("doc_id").cast(pa.int64()),
                    "n_shingles": np.diff(bounds),
                    "low": pa.array(low, mask=~some),
                    "high": pa.array(high, mask=~some),
                    "signature": pa.array([next(rows).tobytes() if x else None for x in some], pa.binary()),
                }
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, low long, high long, signature binary")


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys = band_keys(np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(-1, SIGNATURE))
            nodes = np.repeat(batch.column("node").to_numpy(), BANDS)
            yield pa.RecordBatch.from_pydict({"key": keys.reshape(-1).view(np.int64), "node": nodes})


def _whole_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole buckets, of batches that come sorted by key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column("key").to_numpy()
        last = int(np.searchsorted(keys, keys[-1]))
        if held and (last or held[-1].column("key")[0].as_py() != keys[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        elif last:
            yield pa.Table.from_batches([batch.slice(0, last)])
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def _bucket_links(table: pa.Table, percent: int, miss: float) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the rows of each bucket whose signatures pass the sequential test.

    All rows meet their bucket's first; only those that it does not join meet the others.
    """
    key, node = (table.column(c).to_numpy() for c in ("key", "node"))
    values = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint32).reshape(-1, SIGNATURE)
    new = np.concatenate([[True], key[1:] != key[:-1]])
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(key))
    bucket = np.cumsum(new) - 1
    rows = np.flatnonzero(~new)
    joined = rows[likely_pairs(values, starts[bucket[rows]], rows, percent, miss)]
    apart = np.setdiff1d(rows, joined)
    apart = apart[(ends - starts)[bucket[apart]] > 2]
    a, b = [starts[bucket[joined]]], [joined]
    edges = np.flatnonzero(np.concatenate([[True], bucket[apart][1:] != bucket[apart][:-1], [True]])) if len(apart) else ()
    for k, stop in zip(edges[:-1], edges[1:]):
        own = apart[k:stop]
        first, end = starts[bucket[own[0]]], ends[bucket[own[0]]]
        others = np.arange(first + 1, end)
        alone = np.isin(others, own)
        forest = Forest(end - first)
        for row in joined[(joined > first) & (joined < end)].tolist():
            forest.link(0, row - first)
        for step in range(0, len(own), 128):
            x, y = (m.reshape(-1) for m in np.meshgrid(own[step : step + 128], others, indexing="ij"))
            # Of two rows apart, the later one meets the earlier.
            good = ~np.tile(alone, len(x) // len(others)) | (y < x)
            x, y = x[good], y[good]
            good = likely_pairs(values, x, y, percent, miss)
            found = [(i, j) for i, j in zip(x[good].tolist(), y[good].tolist()) if forest.link(i - first, j - first)]
            if found:
                left, right = np.array(found).T
                a.append(left)
                b.append(right)
    return node[np.concatenate(a)], node[np.concatenate(b)]


def candidate_groups(classes: DataFrame, percent: int, miss: float) -> DataFrame:
    """node and candidates (the smallest node of its group) of the nodes that may have a partner.

    Bands deal nodes into buckets. Nodes of a bucket whose signatures pass the sequential
    test are linked, and what hangs together is a group; so a chain of bands that texts of
    little likeness share makes none. A bucket of more than BLOCK nodes is one group's as it
    is: that can only make the group larger than needed.
    """
    bands = classes.select("node", "signature").mapInArrow(_bands, "key long, node long")
    shared = bands.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last"), F.count("*").alias("rows")).where("hub < last")
    placed = stored(bands.join(shared, "key").select("key", "node", "hub", "rows"), BANDS * classes.count(), per_file=100_000)
    meeting = placed.where(F.col("rows") <= BLOCK).select("key", "node").join(classes.select("node", "signature"), "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_buckets(batches):
            a, b = _bucket_links(table, percent, miss)
            yield pa.RecordBatch.from_pydict({"a": a, "b": b})

    similar = meeting.repartition("key").sortWithinPartitions("key", "node").mapInArrow(run, "a long, b long")
    stars = placed.where((F.col("rows") > BLOCK) & (F.col("node") > F.col("hub"))).select("hub", "node")
    return components(similar.union(stars)).withColumnRenamed("component", "candidates")


def _with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the shingle set of each row's text as bytes."""
    for part in steps(batches, size=SMALL_STEP_BYTES):
        grams, bounds = shingles(part)
        rows = pa.array([grams[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())
        yield pa.RecordBatch.from_arrays([part.column("node"), part.column("candidates"), part.column("blocks"), rows], ["node", "candidates", "blocks", "grams"])


def _links_of(group: pa.Table, percent: int, miss: float, across: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the rows of a group, confirmed on their sets.

    Compared are rows that share a band and are not joined yet; in `across` only rows of
    different blocks and labels.
    """
    nodes = group.column("node").to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in group.column("grams").to_pylist()]
    sizes = np.array([len(x) for x in sets])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    values = signatures(np.concatenate(sets), bounds)
    forest = Forest(len(nodes))
    if across:
        side, label = group.column("side").to_numpy(), group.column("label").to_numpy()
        first = {}
        for k, x in enumerate(label.tolist()):
            forest.link(first.setdefault(x, k), k)
    keys = band_keys(values)
    out = []
    # Some rows at a time meet all rows after them, so that no list of all pairs is held.
    step = max(16, PAIRS // len(nodes))
    for begin in range(0, len(nodes), step):
        met = (keys[begin : begin + step, None] == keys[None, begin:]).any(2)
        x, y = (k + begin for k in np.nonzero(np.triu(met, 1)))
        good = 100 * np.minimum(sizes[x], sizes[y]) >= percent * np.maximum(sizes[x], sizes[y])
        if across:
            good &= (side[x] != side[y]) & (label[x] != label[y])
        roots = forest.roots()
        good &= roots[x] != roots[y]
        x, y = x[good], y[good]
        good = likely_pairs(values, x, y, percent, miss)
        for a, b in zip(x[good].tolist(), y[good].tolist()):
            if forest.root(a) != forest.root(b):
                # Both are sorted and without repeats: equal neighbours are common shingles.
                both = np.sort(np.concatenate([sets[a], sets[b]]))
                common = int((both[1:] == both[:-1]).sum())
                if 100 * common >= percent * (len(both) - common):
                    forest.link(a, b)
                    out.append((a, b))
    found = np.array(out, np.int64).reshape(-1, 2)
    return nodes[found[:, 0]], nodes[found[:, 1]]


def _verified(rows: DataFrame, keys: list[str], percent: int, miss: float, across: bool = False) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, keys):
            if group.num_rows > 1:
                a, b = _links_of(group, percent, miss, across)
                if len(a):
                    yield pa.RecordBatch.from_pydict({"a": a, "b": b})

    return rows.repartition(*keys).sortWithinPartitions(*keys, "node").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = 85, miss: float = MISS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of docs (doc_id, text).

    Rows of equal sets are one node, so copies are never compared. Bands deal nodes into
    buckets; a bucket's nodes whose signatures pass the sequential test are linked, and what
    hangs together is a candidate group. A group's rows meet in blocks, with the group's smallest node in each;
    pairs that share a band pass the sequential test and are confirmed on their full sets.
    Blocks of a group that is not yet joined are then compared with each other.

    Defined results. Without words or text: empty set, a component of its own. Null id:
    not linked, null component, kept. Rows of one id count as one node and share its
    component. Empty table: no rows. Other columns are not read.
    """
    known = stored(sketch(docs))
    same_set = ["n_shingles", "low", "high"]
    n = known.count()
    classes = known.where("n_shingles > 0 and doc_id is not null").groupBy(*same_set).agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature"))
    classes = stored(classes, n)
    members = stored(candidate_groups(classes, percent, miss), n)
    blocks = members.groupBy("candidates").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    members = stored(members.join(blocks, "candidates").select("node", "candidates", "blocks"), n)
    with_text = docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(members, "node").select("node", "candidates", "blocks", "text")
    sets = stored(with_text.mapInArrow(_with_sets, "node long, candidates long, blocks int, grams binary").where(F.length("grams") > 0))
    own_block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    everywhere = F.when(F.col("node") == F.col("candidates"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(own_block))
    links = stored(_verified(sets.withColumn("block", F.explode(everywhere)), ["candidates", "block"], percent, miss))
    same_id = known.where("doc_id is not null and n_shingles > 0").join(classes.drop("signature"), same_set).select("doc_id", "node")
    links = links.union(stored(same_id.where("doc_id != node"), n))
    split = sets.where("blocks > 1")
    if split.select("node").head(1):
        joined = components(links)
        labelled = split.join(joined, "node", "left").withColumn("label", F.coalesce("component", "node")).withColumn("side", own_block).drop("component")
        open_groups = labelled.groupBy("candidates").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least < most")
        # Block s meets block t in the pair (smaller, larger).
        pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda t: F.struct(F.least(t, "side").alias("left"), F.greatest(t, "side").alias("right")))
        rows = (
            labelled.join(open_groups, "candidates", "left_semi")
            .withColumn("pair", F.explode(pairs))
            .select("node", "candidates", "grams", "label", "side", "pair.left", "pair.right")
            .where("left < right")
        )
        links = links.union(stored(_verified(rows, ["candidates", "left", "right"], percent, miss, across=True)))
    found = components(links)
    return (
        known.drop("signature")
        .join(found, known["doc_id"] == found["node"], "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
        .select("doc_id", "n_shingles", "component_id", "kept")
    )
