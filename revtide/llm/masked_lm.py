"""Masked pseudo-likelihood: a window network predicts every word from both sides.

The words of the whole corpus are counted first. The most frequent ones are symbols of their
own, the others share symbols by their last letters, which tell language and inflection;
there are as many symbols as the root of the number of distinct words asks for. Within a symbol a word has
its share of the counts. The shares of the most frequent words travel with the tasks, those
of all others come by a join with the counts, which stay distributed.

The network sums the embeddings of the symbols on both sides, scaled by place, and passes
them through tanh. A symbol's probability is the product of the decisions on its way down a
Huffman tree over all symbols, each a logistic unit; it starts from the corpus counts, so that before training
it predicts word frequencies. Every task trains a copy on masked words of its own part of the corpus
by stochastic gradient descent with a rate for each row of the parameters; rows are averaged
by the times they were trained, and the next round, which masks other words, starts from the
average. After all rounds every word of the corpus has been masked once. A document's score
is the sum of its words' conditional log-probabilities.

Every word of every document trains and is scored, so the work, the symbols and what is
gathered grow with the corpus. Defined results. Null or empty text: 0 words and a score of 0. Null id
and repeated rows: scored like any other row. A very long text is one row of one task. Words of equal counts are
ordered by their hash. Empty table: no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.llm.common import lower_bytes, mixed, random_odd, steps, stored, text_bytes, word_hashes, word_spans

#: Words with a symbol of their own, and symbols that the others share, are each so many times
#: the root of the number of distinct words; at least LEAST.
BREADTH, LEAST = 2.0, 64
#: Letters at a word's end that choose its shared symbol.
ENDING = 3
#: Words on each side, size of embeddings.
WINDOW, SIZE = 2, 7
#: Decisions nearest the root, which most ways pass, are made by one matrix product.
TOP = 64
#: Each word is masked for training in one of so many rounds.
ROUNDS = 2
RATE, BATCH = 0.2, 2048
#: Words at most whose shares travel with the tasks; those of the others are joined. No result depends on it.
LISTED = 100_000
#: Words that one numpy step works on.
CODED_WORDS = 1 << 18
#: Rows of the parameters that travel together when they are averaged.
ROWS = 256
SEED = 5
_SALT, _FOLD = random_odd(21, 2)
_PLACES = (*range(-WINDOW, 0), *range(1, WINDOW + 1))


@dataclass
class Vocabulary:
    """The listed words and the symbols; `own` and `shared` of them, and one beyond a text's ends."""

    #: Hashes of the listed words, sorted; their symbols and logarithmic shares in them.
    hashes: np.ndarray
    symbols: np.ndarray
    shares: np.ndarray
    own: int
    shared: int
    #: How often each symbol stands in the corpus.
    totals: np.ndarray

    @property
    def outside(self) -> int:
        return self.own + self.shared


@dataclass
class Tree:
    """Decisions on the way from the root to each symbol, numbered from the most frequent on.

    Of the first TOP ones, `top` tells for each symbol the side: 1, -1, or 0 where its way
    does not pass. Those beyond are listed: the symbol's begin at its `begins`.
    """

    top: np.ndarray
    begins: np.ndarray
    nodes: np.ndarray
    sides: np.ndarray
    #: Logarithmic odds of side 1 at each node, by the corpus counts.
    odds: np.ndarray


def huffman(totals: np.ndarray) -> Tree:
    """The tree of shortest ways for symbols that occur so often."""
    n = len(totals)
    weights = [max(float(x), 0.5) for x in totals]
    heap = [(w, k) for k, w in enumerate(weights)]
    heapq.heapify(heap)
    parent, side = np.full(2 * n - 1, -1), np.full(2 * n - 1, -1, np.int8)
    odds = np.zeros(max(n - 1, 0))
    for node in range(n, 2 * n - 1):
        (a, left), (b, right) = heapq.heappop(heap), heapq.heappop(heap)
        parent[left] = parent[right] = node
        side[right] = 1
        odds[2 * n - 2 - node] = np.log(b / a)  # nodes are made by rising weight
        heapq.heappush(heap, (a + b, node))
    top, ways = np.zeros((n, TOP), np.int8), []
    at, symbol = np.arange(n), np.arange(n)
    while len(at):
        more = parent[at] >= 0
        at, symbol = at[more], symbol[more]
        node, way = 2 * n - 2 - parent[at], side[at]
        near = node < TOP
        top[symbol[near], node[near]] = way[near]
        ways.append((symbol[~near], node[~near], way[~near]))
        at = parent[at]
    symbols, nodes, sides = (np.concatenate(x) for x in zip(*ways))
    order = np.argsort(symbols, kind="stable")
    begins = np.searchsorted(symbols[order], np.arange(n + 1))
    return Tree(top, begins, nodes[order], sides[order].astype(np.float32), odds)


def first_parameters(known: Vocabulary, tree: Tree) -> np.ndarray:
    """A row for each embedding, each decision (its last value is the bias) and each place's scale."""
    rng = np.random.default_rng(SEED)
    embeddings = rng.normal(scale=0.3, size=(known.outside + 1, SIZE + 1))
    embeddings[:, SIZE] = 0
    decisions = np.concatenate([rng.normal(scale=0.05, size=(len(tree.odds), SIZE)), tree.odds[:, None]], 1)
    return np.concatenate([embeddings, decisions, np.ones((2 * WINDOW, SIZE + 1))]).astype(np.float32)


def _hashed(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word, hash of its last letters, and where each text's words begin."""
    data, offsets = text_bytes(part.column("text"))
    starts, ends, bounds = word_spans(data, offsets)
    lower, tails = lower_bytes(data), np.zeros(len(ends), np.uint64)
    for k in range(1, ENDING + 1):
        at = ends - k
        tails = tails * np.uint64(256) + np.where(at >= starts, lower[np.maximum(at, 0)], 0).astype(np.uint64)
    return word_hashes(data, starts, ends), mixed(tails * _FOLD) >> np.uint64(1), bounds


def word_counts(docs: DataFrame) -> DataFrame:
    """How often each word (its hash) stands in the corpus, and the hash of its ending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches):
            words, endings, _ = _hashed(part)
            values, at, counts = np.unique(words, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_pydict({"word": values.view(np.int64), "ending": endings[at].view(np.int64), "n": counts.astype(np.int64)})

    parts = docs.select("text").mapInArrow(run, "word long, ending long, n long")
    return parts.groupBy("word").agg(F.min("ending").alias("ending"), F.sum("n").alias("n"))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From word_counts. What the driver gathers grows with the root of the number of distinct words.

    The listed words are those from a least count on, found on a histogram of logarithms, so
    that no task sends more than is kept.
    """
    step = F.floor(F.log("n") * 16)
    by_step = {r["k"]: r["words"] for r in counts.groupBy(step.alias("k")).agg(F.count("*").alias("words")).collect()}
    own = shared = max(LEAST, int(BREADTH * sum(by_step.values()) ** 0.5))
    least, words = max(by_step, default=0) + 1, 0
    for k in sorted(by_step, reverse=True):
        words += by_step[k]
        if words > max(LISTED, 2 * own):
            break
        least = k
    top = counts.where(step >= least).toArrow()
    hashes, endings, n = (top.column(c).to_numpy() for c in ("word", "ending", "n"))
    order = np.lexsort((hashes, -n))
    hashes, endings, n = hashes[order].view(np.uint64), endings[order], n[order].astype(np.float64)
    own = min(own, len(n))
    totals = np.zeros(own + shared)
    for r in counts.groupBy(F.pmod("ending", F.lit(shared)).alias("k")).agg(F.sum("n").alias("n")).collect():
        totals[own + r["k"]] = r["n"]
    symbols = own + endings % shared
    totals[:own] = n[:own]
    totals -= np.bincount(symbols[:own], n[:own], len(totals))
    symbols[:own] = np.arange(own)
    shares = np.log(n / totals[symbols]) if len(n) else n
    order = np.argsort(hashes)
    return Vocabulary(hashes[order], symbols[order], shares[order], own, shared, totals)


def _listed(words: np.ndarray, endings: np.ndarray, known: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbol of each word, whether it is listed, and the logarithm of its share in it or, if not, of 1 in all."""
    symbols = known.own + (endings % np.uint64(known.shared)).astype(np.int64)
    listed = np.zeros(len(words), bool)
    if len(known.hashes):
        at = np.minimum(np.searchsorted(known.hashes, words), len(known.hashes) - 1)
        listed = known.hashes[at] == words
        symbols = np.where(listed, known.symbols[at], symbols)
    with np.errstate(divide="ignore"):
        shares = -np.log(known.totals)[symbols]
    if len(known.hashes):
        shares = np.where(listed, known.shares[at], shares)
    return symbols, listed, shares


def _kind(known: Vocabulary) -> np.dtype:
    """The smallest integers that hold all symbols."""
    return np.min_scalar_type(known.outside)


def coded(docs: DataFrame, known: Vocabulary) -> DataFrame:
    """Of each row a number of its own, its symbols as bytes, the sum of the shares that
    `known` tells, and its other words with how often each stands there."""
    kind = _kind(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for part in steps(batches):
            words, endings, bounds = _hashed(part)
            symbols, listed, shares = _listed(words, endings, known)
            sums = np.concatenate([[0.0], np.cumsum(shares)])
            at = np.flatnonzero(~listed)
            doc, other = np.searchsorted(bounds, at, "right") - 1, words[at].view(np.int64)
            order = np.lexsort((other, doc))
            doc, other = doc[order], other[order]
            new = np.ones(len(at), bool)
            new[1:] = (other[1:] != other[:-1]) | (doc[1:] != doc[:-1])
            first = np.flatnonzero(new)
            ends = pa.array(np.searchsorted(doc[first], np.arange(part.num_rows + 1)), pa.int32())
            times = np.diff(np.append(first, len(at)))
            offsets = pa.py_buffer((bounds * kind.itemsize).astype(np.int32))
            yield pa.RecordBatch.from_pydict(
                {
                    "row": pa.array(row + np.arange(part.num_rows), pa.int64()),
                    "doc_id": part.column("doc_id"),
                    "symbols": pa.Array.from_buffers(pa.binary(), part.num_rows, [None, offsets, pa.py_buffer(symbols.astype(kind))]),
                    "shares": sums[bounds[1:]] - sums[bounds[:-1]],
                    "words": pa.ListArray.from_arrays(ends, pa.array(other[first], pa.int64())),
                    "times": pa.ListArray.from_arrays(ends, pa.array(times, pa.int64())),
                }
            )
            row += part.num_rows

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "row long, doc_id long, symbols binary, shares double, words array<long>, times array<long>")


def _decoded(batches: Iterator[pa.RecordBatch], kind: np.dtype) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for part in steps(batches, "symbols", CODED_WORDS * kind.itemsize):
        data, bounds = text_bytes(part.column("symbols"))
        yield part, data.view(kind), bounds // kind.itemsize


class _Windows:
    """The symbols around the words of some texts, with room beyond each text's ends."""

    def __init__(self, symbols: np.ndarray, bounds: np.ndarray, outside: int):
        self.place = np.arange(len(symbols)) + np.repeat(np.arange(1, len(bounds)) * WINDOW, np.diff(bounds))
        self.padded = np.full(len(symbols) + len(bounds) * WINDOW, outside, symbols.dtype)
        self.padded[self.place] = symbols

    def around(self, at: np.ndarray) -> np.ndarray:
        """Of each word the symbols on both sides, a column each."""
        return self.padded[self.place[at][:, None] + np.array(_PLACES)]


@dataclass
class _Pass:
    """What a batch of windows makes of the parameters, and the decisions towards its targets.

    A hidden row ends in 1, for the biases. Of the listed decisions: whose they are, which node
    and side, and the parameters and hidden values that meet there.
    """

    near: np.ndarray
    hidden: np.ndarray
    top: np.ndarray
    top_side: np.ndarray
    top_odds: np.ndarray
    has: np.ndarray
    first: np.ndarray
    nodes: np.ndarray
    side: np.ndarray
    own: np.ndarray
    read: np.ndarray
    odds: np.ndarray


def _forward(table: np.ndarray, tree: Tree, targets: np.ndarray, around: np.ndarray) -> _Pass:
    """Odds are logarithmic and for the target's side, 0 where its way does not pass."""
    n_symbols = len(tree.odds) + 2
    near = table.take(around.ravel(), 0).reshape(*around.shape, SIZE + 1)
    hidden = np.einsum("ijk,jk->ik", near, table[-2 * WINDOW :])
    np.tanh(hidden, out=hidden)
    hidden[:, SIZE] = 1
    top = table[n_symbols : n_symbols + min(tree.top.shape[1], len(tree.odds))]
    top_side = tree.top.take(targets, 0)[:, : len(top)].astype(np.float32)
    begin = tree.begins.take(targets)
    sizes = tree.begins.take(targets + 1) - begin
    has = np.flatnonzero(sizes)
    sizes = sizes[has]
    first = np.cumsum(sizes) - sizes
    at = np.arange(sizes.sum()) + np.repeat(begin[has] - first, sizes)
    nodes, side = tree.nodes.take(at) + n_symbols, tree.sides.take(at)
    own, read = table.take(nodes, 0), hidden.take(np.repeat(has, sizes), 0)
    return _Pass(near, hidden, top, top_side, top_side * (hidden @ top.T), has, first, nodes, side, own, read, side * np.einsum("ij,ij->i", own, read))


def log_chances(table: np.ndarray, tree: Tree, targets: np.ndarray, around: np.ndarray) -> np.ndarray:
    """Logarithm of each target's probability in its window."""
    made = _forward(table, tree, targets, around)
    # Of each decision 1 / chance; a way that does not pass brings 2.
    every = np.multiply.reduce(1 + np.exp(-made.top_odds), axis=1, dtype=np.float64)
    every *= 0.5 ** (made.top_side == 0).sum(1)
    if len(made.has):
        every[made.has] *= np.multiply.reduceat(1 + np.exp(-made.odds), made.first, dtype=np.float64)
    return -np.log(every)


class Learner:
    """A copy of the parameters that trains on masked words and their windows.

    Each row moves against the sum of its steps in a batch, at a rate by the steps it has had.
    """

    def __init__(self, table: np.ndarray, tree: Tree, rate: float = RATE):
        self.table, self.tree, self.rate = table.copy(), tree, rate
        self.speed, self.hits = np.ones(len(table), np.float32), np.zeros(len(table), np.int64)
        self.kind = np.min_scalar_type(len(table))

    def _move(self, rows, sums: np.ndarray, hits: np.ndarray) -> None:
        speed = self.speed[rows] + np.einsum("ij,ij->i", sums, sums) / np.float32(SIZE)
        self.speed[rows] = speed
        self.table[rows] -= sums * (self.rate / np.sqrt(speed))[:, None].astype(np.float32)
        self.hits[rows] += hits

    def _add(self, rows: np.ndarray, steps_: np.ndarray) -> None:
        order = np.argsort(rows.astype(self.kind), kind="stable")
        ordered = rows.take(order)
        edges = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        sums = np.add.reduceat(steps_.take(order, 0), edges)
        self._move(ordered.take(edges), sums, np.diff(np.append(edges, len(rows))))

    def train(self, targets: np.ndarray, around: np.ndarray) -> None:
        n_symbols = len(self.tree.odds) + 2
        for begin in range(0, len(targets), BATCH):
            some = around[begin : begin + BATCH]
            made = _forward(self.table, self.tree, targets[begin : begin + BATCH].astype(np.int64), some)
            error = -made.top_side / (1 + np.exp(made.top_odds))
            back, change = error @ made.top, error.T @ made.hidden
            scales = self.table[-2 * WINDOW :].copy()
            if len(made.has):
                listed = (-made.side / (1 + np.exp(made.odds)))[:, None]
                back[made.has] += np.add.reduceat(made.own * listed, made.first)
                self._add(made.nodes, made.read * listed)
            self._move(slice(n_symbols, n_symbols + len(made.top)), change, len(back))
            # The last hidden value is always 1, so nothing comes back through it.
            back *= 1 - made.hidden * made.hidden
            self._move(slice(len(self.table) - 2 * WINDOW, None), np.einsum("ijk,ik->jk", made.near, back), len(back))
            self._add(some.ravel().astype(np.int64), (back[:, None] * scales).reshape(-1, SIZE + 1))


def learn(docs: DataFrame, known: Vocabulary) -> np.ndarray:
    """The network's parameters after ROUNDS rounds over the corpus."""
    return _learned(stored(coded(docs, known)), known, huffman(known.totals))


def _learned(rows: DataFrame, known: Vocabulary, tree: Tree) -> np.ndarray:
    table = first_parameters(known, tree)
    for k in range(ROUNDS):
        table = _averaged(rows, table, known, tree, k)
    return table


def masked(rows: np.ndarray, bounds: np.ndarray, k: int) -> np.ndarray:
    """The words masked in round k; bounds are those of the rows' words."""
    sizes = np.diff(bounds)
    place = np.arange(bounds[-1]) - np.repeat(bounds[:-1], sizes)
    return np.flatnonzero(mixed(np.repeat(rows.astype(np.uint64) * _SALT, sizes) + place.astype(np.uint64)) % np.uint64(ROUNDS) == k)


_PARTS = "part long, salt long, sums binary"


def _sent(sums: dict[int, np.ndarray], salt: int) -> pa.RecordBatch:
    parts = [k for k, x in sums.items() if x[:, -1].any()]
    return pa.RecordBatch.from_pydict(
        {"part": pa.array(parts, pa.int64()), "salt": pa.array([salt] * len(parts), pa.int64()), "sums": pa.array([sums[k].tobytes() for k in parts], pa.binary())}
    )


def _averaged(coded_rows: DataFrame, start: np.ndarray, known: Vocabulary, tree: Tree, k: int) -> np.ndarray:
    """The rows' averages over the tasks, by the times each has trained them; the others stay."""
    spark, kind, outside = coded_rows.sparkSession, _kind(known), known.outside
    sent = spark.sparkContext.broadcast((start, tree))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner = Learner(*sent.value, RATE / (k + 1))
        for part, symbols, bounds in _decoded(batches, kind):
            at = masked(part.column("row").to_numpy(), bounds, k)
            if len(at):
                learner.train(symbols[at], _Windows(symbols, bounds, outside).around(at))
        hits = learner.hits[:, None].astype(np.float64)
        whole = np.concatenate([learner.table * hits, hits], 1)
        yield _sent({j: whole[j * ROWS : (j + 1) * ROWS] for j in range(-(-len(whole) // ROWS))}, TaskContext.get().partitionId() % 64)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of each part over the tasks that come here; a few rows, however many come in."""
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, values in zip(batch.column("part").to_pylist(), batch.column("sums").to_pylist()):
                own = np.frombuffer(values, np.float64).reshape(-1, SIZE + 2)
                sums[part] = sums[part] + own if part in sums else own
        yield _sent(sums, 0)

    # Two steps, so that no task reads what all tasks of a large corpus have made.
    parts = coded_rows.select("row", "symbols").mapInArrow(run, _PARTS).repartition("part", "salt").mapInArrow(added, _PARTS)
    out = start.copy()
    for r in parts.repartition("part").mapInArrow(added, _PARTS).collect():
        sums = np.frombuffer(r["sums"], np.float64).reshape(-1, SIZE + 2)
        trained = np.flatnonzero(sums[:, -1])
        out[r["part"] * ROWS + trained] = sums[trained, :-1] / sums[trained, -1:]
    sent.unpersist()
    return out


def score(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, log_likelihood and mean_log_likelihood of each row of docs (doc_id, text)."""
    counts = stored(word_counts(docs))
    known = vocabulary(counts)
    tree, kind, outside = huffman(known.totals), _kind(known), known.outside
    rows = stored(coded(docs, known))
    sent = docs.sparkSession.sparkContext.broadcast((_learned(rows, known, tree), tree))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, ways = sent.value
        for part, symbols, bounds in _decoded(batches, kind):
            windows, found = _Windows(symbols, bounds, outside), np.empty(len(symbols))
            for begin in range(0, len(symbols), 2048):
                at = np.arange(begin, min(begin + 2048, len(symbols)))
                found[at] = log_chances(table, ways, symbols[at].astype(np.int64), windows.around(at))
            sums = np.concatenate([[0.0], np.cumsum(found)])
            yield pa.RecordBatch.from_pydict(
                {
                    "row": part.column("row"),
                    "doc_id": part.column("doc_id"),
                    "n_words": np.diff(bounds),
                    "told": sums[bounds[1:]] - sums[bounds[:-1]] + part.column("shares").to_numpy(),
                }
            )

    told = rows.select("row", "doc_id", "symbols", "shares").mapInArrow(run, "row long, doc_id long, n_words long, told double")
    others = rows.select("row", F.explode(F.arrays_zip("words", "times")).alias("x")).select("row", F.col("x.words").alias("word"), F.col("x.times").alias("times"))
    own = others.join(counts.select("word", "n"), "word").groupBy("row").agg(F.sum(F.col("times") * F.log("n")).alias("own"))
    score_ = told.join(own, "row", "left").select("doc_id", "n_words", (F.col("told") + F.coalesce("own", F.lit(0.0))).alias("log_likelihood"))
    return score_.withColumn("mean_log_likelihood", F.col("log_likelihood") / F.greatest("n_words", F.lit(1)))
