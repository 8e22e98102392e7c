import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from revtide.llm import masked_lm as lm


@pytest.fixture(scope="module")
def corpus(spark):
    """Sentences of one grammar; the last documents have the same words in another order."""
    rng = random.Random(1)
    ways = [("the", "red", "cat", "sat", "on", "a", "mat"), ("one", "old", "dog", "ran", "to", "my", "house"), ("we", "saw", "two", "big", "birds", "up", "there")]
    rows = [(k, " ".join(" ".join(rng.choice(ways)) for _ in range(60))) for k in range(120)]
    rows += [(1000 + k, " ".join(rng.sample(t.split(), len(t.split())))) for k, t in rows[:10]]
    rows += [(5000, None), (5001, ""), (None, "the red cat"), (5002, "unseen words only")]
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n_words string").repartition(4, "doc_id")


def test_order_counts_and_empty_texts(corpus):
    made = {r.doc_id: r for r in lm.score(corpus).collect()}
    assert len(made) == 134
    ordered = [made[k].mean_log_likelihood for k in range(10)]
    mixed_up = [made[1000 + k].mean_log_likelihood for k in range(10)]
    assert max(mixed_up) < min(ordered)
    assert (made[5000].n_words, made[5000].log_likelihood) == (made[5001].n_words, made[5001].log_likelihood) == (0, 0.0)
    assert made[None].n_words == 3
    assert all(math.isfinite(r.log_likelihood) and r.log_likelihood <= 0 for r in made.values())


def test_counts_are_whole(corpus):
    words = Counter(w for r in corpus.collect() for w in (r.text or "").split())
    assert sorted(r.n for r in lm.word_counts(corpus).collect()) == sorted(words.values())


def chance_of(table, tree, known, near, target):
    """Down the tree, decision by decision."""
    n = known.outside + 1
    scale = table[-2 * lm.WINDOW :, : lm.SIZE].astype(float)
    hidden = np.tanh(sum(table[s, : lm.SIZE].astype(float) * scale[i] for i, s in enumerate(near)))
    out = 0.0
    listed = slice(tree.begins[target], tree.begins[target + 1])
    for node, side in [*enumerate(tree.top[target].tolist()), *zip(tree.nodes[listed].tolist(), tree.sides[listed].tolist())]:
        if side:
            row = table[n + node].astype(float)
            yes = 1 / (1 + math.exp(-(row[: lm.SIZE] @ hidden + row[lm.SIZE])))
            out += math.log(yes if side > 0 else 1 - yes)
    return out


def test_scores_as_word_by_word(corpus, monkeypatch):
    monkeypatch.setattr(lm, "TOP", 5)
    monkeypatch.setattr(lm, "LISTED", 10)
    monkeypatch.setattr(lm, "LEAST", 6)
    monkeypatch.setattr(lm, "BREADTH", 1.0)
    counts = lm.word_counts(corpus)
    known = lm.vocabulary(counts)
    tree = lm.huffman(known.totals)
    table = lm.learn(corpus, known)
    rng = np.random.default_rng(0)
    n, bounds = known.outside, np.array([0, 5, 5, 12])
    symbols = rng.integers(0, n, 12).astype(np.uint16)
    around = lm._Windows(symbols, bounds, n).around(np.arange(12))
    found = lm.log_chances(table, tree, symbols.astype(np.int64), around)
    for k in range(12):
        low, high = (0, 5) if k < 5 else (5, 12)
        near = [int(symbols[k + j]) if low <= k + j < high else n for j in range(-lm.WINDOW, lm.WINDOW + 1) if j]
        assert around[k].tolist() == near
        assert found[k] == pytest.approx(chance_of(table, tree, known, near, int(symbols[k])), abs=1e-4)
    # The chances of all symbols in one window add up to 1, and those of a symbol's words too.
    every = lm.log_chances(table, tree, np.arange(n), np.repeat(around[:1], n, 0))
    assert np.exp(every).sum() == pytest.approx(1, abs=1e-5)
    rows = counts.collect()
    words, endings = (np.array([r[c] for r in rows]).view(np.uint64) for c in ("word", "ending"))
    symbols, listed, shares = lm._listed(words, endings, known)
    shares = shares + np.where(listed, 0, np.log([r.n for r in rows]))
    assert listed.any() and not listed.all()
    assert np.bincount(symbols, np.exp(shares))[np.unique(symbols)] == pytest.approx(1)


def test_untrained_parameters_predict_frequencies(corpus):
    known = lm.vocabulary(lm.word_counts(corpus))
    tree = lm.huffman(known.totals)
    table = lm.first_parameters(known, tree)
    table[known.outside + 1 :, : lm.SIZE] = 0
    symbols = np.flatnonzero(known.totals > 0)
    found = lm.log_chances(table, tree, symbols, np.zeros((len(symbols), 2 * lm.WINDOW), np.int64))
    # Symbols that never occur take a small part.
    assert np.exp(found) == pytest.approx(known.totals[symbols] / known.totals.sum(), rel=0.05)
    ways = np.diff(tree.begins) + (tree.top != 0).sum(1)
    assert np.diff(tree.begins).any() and (2.0**-ways).sum() == pytest.approx(1)
    assert ways[known.totals.argmax()] == ways.min()


def test_training_moves_towards_the_gradient():
    """One step of one batch against differences of the log-likelihood."""
    known = lm.Vocabulary(np.empty(0), np.empty(0), np.empty(0), 5, 4, np.arange(9.0, 0, -1))
    tree = lm.huffman(known.totals)
    table = lm.first_parameters(known, tree)
    rng = np.random.default_rng(1)
    targets, around = rng.integers(0, 9, 40), rng.integers(0, 10, (40, 2 * lm.WINDOW))

    def loss(t):
        return -lm.log_chances(t.astype(np.float64), tree, targets, around).sum()

    learner = lm.Learner(table, tree, 1e-3)
    learner.train(targets, around)
    moved = (table - learner.table).astype(float)
    cells = [(k, j) for k in range(len(table)) for j in range(lm.SIZE + 1) if not (k <= 9 and j == lm.SIZE) and not (k >= len(table) - 2 * lm.WINDOW and j == lm.SIZE)]
    ratios = {}
    for k, j in cells:
        up, down = table.astype(np.float64), table.astype(np.float64)
        up[k, j] += 1e-4
        down[k, j] -= 1e-4
        slope = (loss(up) - loss(down)) / 2e-4
        if abs(slope) > 0.05:
            ratios.setdefault(k, []).append(moved[k, j] / slope)
    # A row moves along its slope, at a rate of its own.
    assert len(ratios) > 15
    for found in ratios.values():
        assert min(found) > 0 and max(found) < 1.1 * min(found)


def test_context_tells_more_than_frequency(spark):
    """Two languages of 3,000 words each, most of them rare: the words around tell which."""
    rng = random.Random(4)
    tongues = [["".join(rng.choice(letters) for _ in range(5)) + end for _ in range(3000)] for letters, end in (("abcdefgh", "ung"), ("mnopqrst", "ieux"))]
    docs = [(k, " ".join(rng.choice(tongues[k % 2]) for _ in range(150))) for k in range(400)]
    made = lm.score(spark.createDataFrame(docs, "doc_id long, text string").repartition(2)).collect()
    counts = Counter(w for _, t in docs for w in t.split())
    total = sum(counts.values())
    frequency = sum(n * math.log(n / total) for n in counts.values())
    assert sum(r.n_words for r in made) == total
    gain = (sum(r.log_likelihood for r in made) - frequency) / total
    assert 0.5 * math.log(2) < gain


def test_every_word_has_its_own_count(spark, monkeypatch):
    rng = random.Random(2)
    frequent = [f"f{k}" for k in range(60)]
    others = [f"x{k}" for k in range(400)]
    rows = [(k, " ".join(rng.choices(frequent, k=300) + rng.choices(others, [1 + j % 5 for j in range(400)], k=40))) for k in range(60)]
    counts = Counter(w for _, t in rows for w in t.split())
    rare = [w for w in others if counts[w]]
    # Texts of one word each, which the network tells apart by symbol only.
    rows += [(1000 + k, w) for k, w in enumerate(rare)] + [(5000, f"{rare[0]} {rare[0]} {rare[1]}")]
    counts.update(w for _, t in rows[60:] for w in t.split())
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4, "doc_id")
    whole = {r.doc_id: r.log_likelihood for r in lm.score(docs).collect()}
    monkeypatch.setattr(lm, "LISTED", 70)
    made = {r.doc_id: r.log_likelihood for r in lm.score(docs).collect()}
    assert made == pytest.approx(whole, abs=1e-3)
    known = lm.vocabulary(lm.word_counts(docs))
    groups = {}
    for k, w in enumerate(rare):
        words, endings, _ = lm._hashed(pa.RecordBatch.from_pydict({"text": [w]}))
        symbol = lm._listed(words, endings, known)[0][0]
        if symbol >= known.own:
            groups.setdefault(symbol, []).append((made[1000 + k], counts[w]))
    pairs = [(a, b) for g in groups.values() for a, b in zip(g, g[1:])]
    assert any(a[1] != b[1] for a, b in pairs)
    assert all(a[0] - b[0] == pytest.approx(math.log(a[1] / b[1]), abs=1e-3) for a, b in pairs)


def test_symbols_grow_with_the_corpus(spark):
    few, many = (spark.createDataFrame([(k, k, 1) for k in range(n)], "word long, ending long, n long") for n in (2_000, 32_000))
    a, b = lm.vocabulary(few), lm.vocabulary(many)
    assert b.own == b.shared == pytest.approx(4 * a.own, rel=0.02)


def test_very_long_text_and_repeated_rows(spark):
    rows = [(1, "a b c d " * 100_000), (2, "a b c d"), (2, "a b c d"), (3, "d c b a")]
    made = lm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.n_words for r in made) == [4, 4, 4, 400_000]
    assert len({r.log_likelihood for r in made if r.doc_id == 2}) == 1


def test_every_word_trains_once():
    rows, bounds = np.array([7, 1 << 40, 3, 4]), np.array([0, 5000, 5000, 5001, 9000])
    rounds = [lm.masked(rows, bounds, k) for k in range(lm.ROUNDS)]
    assert sorted(np.concatenate(rounds)) == list(range(9000))
    assert all(0.4 * 9000 < len(x) < 0.6 * 9000 for x in rounds)


def test_coded_rows_hold_every_word(corpus):
    known = lm.vocabulary(lm.word_counts(corpus))
    kind = lm._kind(known)
    rows = lm.coded(corpus, known).collect()
    assert len({r.row for r in rows}) == len(rows) == 134
    trained = sum(len(lm.masked(np.array([r.row]), np.array([0, len(r.symbols) // kind.itemsize]), k)) for r in rows for k in range(lm.ROUNDS))
    assert trained == sum(len((r.text or "").split()) for r in corpus.collect())


def test_empty_table(spark):
    assert lm.score(spark.createDataFrame([], "doc_id long, text string")).collect() == []
