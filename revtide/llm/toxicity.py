"""Toxicity: a learned lexicon met through Levenshtein automata, weighed by context.

The lexicon is learned from labelled documents: words, and stems of inflected words (ending
in *), that different toxic documents hold significantly more often than different clean
ones. Its trie is intersected with the Levenshtein automaton of every term; the product is
built as a deterministic automaton, state by state as texts need it. Spellings near a term
that clean training documents hold are words of their own and never match; a term whose
clean neighbours are so many that unseen ones must be expected matches exactly or not at all.
Each match is weighed by how much likelier its term is in toxic documents and by its window
of words: quotation marks and words of report lower it, address raises it, and so does what
the training windows teach. The sum of the matches, the largest of them and their share of
the words feed a logistic regression.

Defined results. Null or empty text: the regression's bias. Null id: a training row never,
a scored row as any other. Repeated rows: scored alike. No labels of one class: an empty
lexicon and a score of 0 for all. Empty table: no rows. Other columns stay as they are.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtide.llm.common import SMALL_STEP_BYTES, gram_hashes, mixed, steps, stored, text_bytes, training_rows, word_hashes, word_spans

#: Labelled documents learned from, at most.
TRAINING_ROWS = 12_000
#: A term stands in so many different toxic documents at least, is so many times likelier
#: there than in clean ones, and so unlikely by chance (a likelihood ratio statistic).
LEAST, LEAST_RATIO, LEAST_EVIDENCE = 5, 3, 40.0
#: Sightings of a form that one document counts for, at most.
SIGHTINGS = 3
#: Tasks that share the training texts; forms that one adds up before it sends them on.
TASKS, FORMS = 24, 100_000
#: Letters of a stem.
STEMS = range(3, 9)
#: Words on each side of a match that weigh it.
WINDOW = 4
#: Context words: windows of each label that one is taken to have besides its own, and the
#: standard errors by which its rates must differ.
SHRINK, SURE = 200, 4.0
#: Unseen clean spellings near a term that a clean document may be expected to hold.
UNSEEN = 0.001
#: Spellings a worker remembers; beyond that it forgets them all.
KNOWN = 300_000
#: What a misspelled match counts against an exact one.
MISSPELLED = 0.7

_TRIM = "\"'`.,;:!?()[]{}<>*_~-«»“”„‘’‚¿¡…|/\\"
_NOISE = "#$%&"
_QUOTES = tuple("\"'«»“”„‘’‚`")
_LOOKALIKE = str.maketrans("013457@$!", "oieastasi")
#: Cues of report and of address in the corpus's languages, with their weights.
CUES = {
    **dict.fromkeys("said says quoted quote wrote writes word words term called reported reports article headline".split(), -1.0),
    **dict.fromkeys("dit écrit cité citation mot mots terme rapporte".split(), -1.0),
    **dict.fromkeys("sagte sagt schrieb zitat zitiert wort begriff berichtet".split(), -1.0),
    **dict.fromkeys("dijo dice escribió cita palabra término informa".split(), -1.0),
    **dict.fromkeys("you your you're youre u tu toi vous du dich dein tú eres usted".split(), 0.5),
}


def allowed_edits(term: str) -> int:
    """Edits a match may need; those of a stem are within its own letters."""
    size = len(term.removesuffix("*"))
    return 0 if size < 5 else 1 if size < 10 else 2


class Automaton:
    """The trie of terms times their Levenshtein automata, made deterministic as it is used.

    A state is the set of (trie node, edits so far); number 0 is the empty set.
    """

    STATES = 50_000

    def __init__(self, terms: Iterable[str], exact: Iterable[str] = ()):
        """Matches of the terms in `exact` may need no edit."""
        none = frozenset(exact)
        self.edits = {t: 0 if t in none else allowed_edits(t) for t in terms}
        self.children: list[dict[str, int]] = [{}]
        self.term: dict[int, str] = {}
        self.reach = [0]  # edits that some term below a node allows
        self.stems: dict[int, str] = {}
        for term in terms:
            node = 0
            for c in term.removesuffix("*"):
                self.reach[node] = max(self.reach[node], self.edits[term])
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.reach.append(0)
                node = self.children[node][c]
            self.reach[node] = max(self.reach[node], self.edits[term])
            if term.endswith("*"):
                self.stems[node] = term
            else:
                self.term[node] = term
        self.restart()

    def restart(self) -> None:
        self.number: dict[frozenset, int] = {frozenset(): 0}
        self.states: list[frozenset] = [frozenset()]
        self.next: list[dict[str, int]] = [{}]
        self.stem: list[tuple[int, str] | None] = [None]  # the nearest stem that a state has read, and its edits
        self.start = self._state({(0, 0)})

    def _state(self, items: set[tuple[int, int]]) -> int:
        """Number of the state, after adding what skipped letters of terms reach."""
        todo = list(items)
        while todo:
            node, edits = todo.pop()
            if edits < self.reach[node]:
                for child in self.children[node].values():
                    if (child, edits + 1) not in items and edits < self.reach[child]:
                        items.add((child, edits + 1))
                        todo.append((child, edits + 1))
        key = frozenset(items)
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
            self.next.append({})
            read = [(edits, self.stems[node]) for node, edits in key if node in self.stems and edits <= self.edits[self.stems[node]]]
            self.stem.append(min(read, default=None))
        return self.number[key]

    def _step(self, state: int, c: str) -> int:
        items = set()
        for node, edits in self.states[state]:
            child = self.children[node].get(c)
            if child is not None:
                items.add((child, edits))
            if edits < self.reach[node]:
                items.add((node, edits + 1))
                items.update((x, edits + 1) for x in self.children[node].values() if edits < self.reach[x])
        self.next[state][c] = out = self._state(items) if items else 0
        return out

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term within its edits, and how many it took."""
        if len(self.states) > self.STATES:
            self.restart()
        state, best = self.start, None
        for c in word:
            after = self.next[state].get(c)
            state = self._step(state, c) if after is None else after
            near = self.stem[state]
            if near is not None and (best is None or near < best):
                best = near
                if not near[0]:
                    return near[1], 0
            if not state:
                break
        found = [(edits, self.term[node]) for node, edits in self.states[state] if node in self.term and edits <= self.edits[self.term[node]]]
        if best is not None:
            found.append(best)
        return (min(found)[1], min(found)[0]) if found else None


@dataclass
class Model:
    """All that scoring needs; small, so that it travels with the tasks."""

    #: What an exact match of each term counts, 0 to 1.
    terms: dict[str, float] = field(default_factory=dict)
    #: Terms that match without edits only.
    exact: frozenset[str] = frozenset()
    clean_forms: frozenset[str] = frozenset()
    context: dict[str, float] = field(default_factory=dict)
    #: Of the sum, of the largest match and of the matches' share of the words; the bias.
    weights: tuple[float, float, float, float] = (0.0, 0.0, 0.0, -40.0)

    def automaton(self) -> Automaton:
        return Automaton(self.terms, self.exact)


class _Spellings(dict):
    """What a space-separated word counts as a match."""

    def __init__(self, model: Model):
        self.model, self.automaton = model, model.automaton()

    def __missing__(self, raw: str) -> float:
        if len(self) > KNOWN:
            self.clear()
        word = plain(raw)
        near = self.automaton.match(word)
        out = 0.0
        if near and not near[1]:
            out = self.model.terms[near[0]]
        elif word not in self.model.clean_forms:
            near = near or self.automaton.match(word.translate(_LOOKALIKE))
            out = MISSPELLED * self.model.terms[near[0]] if near else 0.0
        self[raw] = out
        return out


def plain(raw: str) -> str:
    """The word without marks around it; a first $ may stand for a letter."""
    return raw.rstrip(_TRIM + _NOISE).lstrip(_TRIM + "#%&")


def matches(text: str, spellings: _Spellings) -> tuple[list[tuple[float, list[str], bool]], int]:
    """Of each match: what it counts, the words around it, whether it stands in quotation
    marks; and the number of words."""
    words = text.lower().split()
    counts = list(map(spellings.__getitem__, words))
    if not any(counts):
        return [], len(words)
    out = []
    for k in np.flatnonzero(counts).tolist():
        around = words[max(0, k - WINDOW) : k] + words[k + 1 : k + 1 + WINDOW]
        quoted = words[k].startswith(_QUOTES) or words[k].rstrip(".,;:!?").endswith(_QUOTES)
        out.append((counts[k], [plain(x) for x in around], quoted))
    return out, len(words)


def features(text: str | None, model: Model, spellings: _Spellings) -> tuple[float, float, float]:
    """Logarithm of the weighed matches' sum plus one, the largest of them, and their share of the words."""
    total = most = 0.0
    found, n_words = matches(text or "", spellings)
    for count, around, quoted in found:
        lean = sum(CUES.get(x, 0.0) + model.context.get(x, 0.0) for x in around) - 1.5 * quoted
        strength = count / (1 + math.exp(min(30.0, -2 - lean)))
        total, most = total + strength, max(most, strength)
    return math.log1p(total), most, min(1.0, 20 * total / (n_words + 10))


def _signatures(part: pa.RecordBatch) -> list[int]:
    """Of each text its smallest hash of four words in a row, which copies share; of shorter texts that of all."""
    data, offsets = text_bytes(part.column("text"))
    starts, ends, bounds = word_spans(data, offsets)
    words = word_hashes(data, starts, ends)
    grams = np.append(gram_hashes(words, 4), np.full(min(4, len(words) + 1), np.uint64(2**64 - 1)))
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        found = grams[a : b - 3].min() if b - a >= 4 else mixed(np.append(words[a:b], np.uint64(b - a))).sum()
        out.append(int(found.astype(np.int64)))
    return out


def _forms(word: str) -> list[str]:
    return [word, *(f"{word[:k]}*" for k in STEMS if len(word) > k)]


def _signed(rows: DataFrame) -> DataFrame:
    """Texts with their signatures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, size=SMALL_STEP_BYTES):
            yield pa.RecordBatch.from_pydict({"signature": pa.array(_signatures(part), pa.int64()), "text": part.column("text")})

    return rows.select("text").mapInArrow(run, "signature long, text string")


def _sightings(rows: DataFrame, wanted: frozenset[str] | None) -> DataFrame:
    """Forms (the wanted ones, or all) with the number of different texts that hold them, and
    their sightings there: one text counts for SIGHTINGS at most, its copies together as one.

    Copies meet as texts, which are far smaller than their forms; a task adds its forms up.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: Counter[str] = Counter()
        seen: Counter[str] = Counter()
        most: dict[str, int] = {}  # of the copies so far

        def summed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({"form": pa.array(texts.keys(), pa.string()), "texts": pa.array(texts.values(), pa.int64()), "seen": pa.array([seen[x] for x in texts], pa.int64())})
            texts.clear()
            seen.clear()
            return out

        last = None
        for part in steps(batches, size=SMALL_STEP_BYTES):
            for signature, text in zip(part.column("signature").to_pylist(), part.column("text").to_pylist()):
                if signature != last:
                    texts.update(most.keys())
                    seen.update(most)
                    last, most = signature, {}
                    if len(texts) > FORMS:
                        yield summed()
                found: Counter[str] = Counter()
                for word, n in Counter(map(plain, (text or "").lower().split())).items():
                    for form in _forms(word):
                        if wanted is None or form in wanted:
                            found[form] += n
                for form, n in found.items():
                    most[form] = max(most.get(form, 0), min(n, SIGHTINGS))
        texts.update(most.keys())
        seen.update(most)
        yield summed()

    dealt = _signed(rows).repartition(TASKS, "signature").sortWithinPartitions("signature")
    return dealt.mapInArrow(run, "form string, texts long, seen long").groupBy("form").agg(F.sum("texts").alias("texts"), F.sum("seen").alias("seen"))


def evidence(a: float, c: float, size_a: float, size_c: float) -> float:
    """Likelihood ratio statistic of a sightings in one class and c in the other, against equal rates."""
    common = (a + c) / (size_a + size_c)
    return 2 * sum(x * math.log(x / (size * common)) for x, size in ((a, size_a), (c, size_c)) if x)


def chosen(toxic: dict[str, int], clean: dict[str, int], sizes: dict[int, int]) -> dict[str, float]:
    """Terms and what their matches count, from the sightings of forms on both sides and the
    number of texts of each label; a stem only if it says more than each of its words and stems."""

    def ratio(form: str) -> float:
        return (toxic[form] / sizes[1]) / ((clean.get(form, 0) + 0.5) / sizes[0])

    told = {x: evidence(toxic[x], clean.get(x, 0), sizes[1], sizes[0]) for x in toxic if len(x) >= 3 and ratio(x) >= LEAST_RATIO}
    told = {x: e for x, e in told.items() if e >= LEAST_EVIDENCE}
    most: dict[str, float] = {}  # of each stem: of its best word
    for x, e in told.items():
        if not x.endswith("*"):
            for stem in _forms(x)[1:]:
                most[stem] = max(most.get(stem, 0.0), e)
    stems = [x for x in told if x.endswith("*") and told[x] >= 1.3 * most.get(x, 0.0)]
    taken: list[str] = []
    for stem in sorted(stems, key=lambda x: (-told[x], -len(x), x)):
        if not any(stem.startswith(t[:-1]) or t.startswith(stem[:-1]) for t in taken):
            taken.append(stem)
    words = [x for x in told if not x.endswith("*")]
    return {x: min(1.0, math.log(ratio(x)) / math.log(30)) for x in sorted([*taken, *words], key=lambda x: (-told[x], x))}


def learn(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, n: int = TRAINING_ROWS, label: str = "toxic") -> Model:
    """A model of at most n labelled documents whose crc32 modulo folds is not held_out.

    What the driver gathers is bounded by n: forms, spellings, context words and figures of those rows.
    """
    train = stored(training_rows(docs, labels, label, folds, held_out, n), n, per_file=200)
    sides = [train.where(F.col("label") == k).select("text") for k in (0, 1)]
    sizes = {k: _texts(rows) for k, rows in enumerate(sides)}
    if not sizes[0] or not sizes[1]:
        return Model()
    found = _sightings(sides[1], None).where(F.col("texts") >= LEAST).collect()
    toxic = {r["form"]: r["seen"] for r in found}
    clean = {r["form"]: r["seen"] for r in _sightings(sides[0], frozenset(toxic)).collect()}
    model = Model(chosen(toxic, clean, sizes))
    _set_apart(model, sides[0], sizes[0])
    model.context = _context(model, train)
    rows = [(x, y) for x, y in train.select(F.pandas_udf(_features_of(model), "array<double>")("text"), "label").collect()]
    model.weights = _regression(np.array([r[0] for r in rows]), np.array([r[1] for r in rows]))
    return model


def _texts(rows: DataFrame) -> int:
    """Number of different texts, copies taken as one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, size=SMALL_STEP_BYTES):
            yield pa.RecordBatch.from_pydict({"text": pa.array(_signatures(part), pa.int64())})

    return rows.mapInArrow(run, "text long").distinct().count()


def _set_apart(model: Model, clean: DataFrame, n_clean: int) -> None:
    """The clean spellings near the terms; and which terms match exactly only.

    Spellings that one clean text alone holds tell how many more there are that none of
    these texts holds (the Good-Turing estimate).
    """
    terms = list(model.terms)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(terms)
        for part in steps(batches, size=SMALL_STEP_BYTES):
            words, terms_, texts = [], [], []
            for text, signature in zip(part.column("text").to_pylist(), _signatures(part)):
                for word in set(map(plain, (text or "").lower().split())):
                    found = automaton.match(word) or automaton.match(word.translate(_LOOKALIKE))
                    if found:
                        words.append(word)
                        terms_.append(found[0])
                        texts.append(signature)
            yield pa.RecordBatch.from_pydict({"word": pa.array(words, pa.string()), "term": pa.array(terms_, pa.string()), "text": pa.array(texts, pa.int64())})

    spellings = clean.mapInArrow(near, "word string, term string, text long").groupBy("word", "term").agg(F.count_distinct("text").alias("texts")).collect()
    automaton = Automaton(terms)
    apart = [r for r in spellings if (automaton.match(r["word"]) or ("", 1))[1]]
    single = Counter(r["term"] for r in apart if r["texts"] == 1)
    model.exact = frozenset(t for t, k in single.items() if k > max(1, UNSEEN * n_clean))
    model.clean_forms = frozenset(r["word"] for r in apart)


def _context(model: Model, train: DataFrame) -> dict[str, float]:
    """What words around matches add, where their rates in toxic and clean rows surely differ."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spellings = _Spellings(model)
        for batch in batches:
            counts = (Counter(), Counter())
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                counts[label].update({x for _, around, _ in matches(text or "", spellings)[0] for x in around if x})
            words = [*counts[0].keys() | counts[1].keys()]
            yield pa.RecordBatch.from_pydict({"word": pa.array(words, pa.string()), "toxic": [counts[1][w] for w in words], "clean": [counts[0][w] for w in words]})

    seen = train.mapInArrow(windows, "word string, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    around = seen.where("toxic + clean >= 20").collect()
    hits = [sum(r[k] for r in around) or 1 for k in ("toxic", "clean")]
    out = {}
    for r in around:
        # Both rates are shrunk towards the word's common one.
        common = SHRINK * (r["toxic"] + r["clean"]) / sum(hits)
        a, c = r["toxic"] + common, r["clean"] + common
        lean = math.log(a / (hits[0] + SHRINK) * (hits[1] + SHRINK) / c)
        if abs(lean) >= SURE * math.sqrt(1 / a + 1 / c):
            out[r["word"]] = 0.5 * lean
    return out


def _regression(x: np.ndarray, y: np.ndarray, rounds: int = 3000) -> tuple[float, ...]:
    """Logistic regression by full gradients; weights of matches are not negative."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= 4.0 * (x.T @ (p - y) / len(y) + 1e-4 * w * (np.arange(len(w)) < len(w) - 1))
        w[:-1] = np.maximum(w[:-1], 0)
    return tuple(w.tolist())


def _features_of(model: Model):
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        spellings = _Spellings(model)
        for part in parts:
            yield pd.Series([list(features(text, model, spellings)) for text in part], dtype=object)

    return run


def score(text: Column, model: Model) -> Column:
    """Probability that a text is toxic."""

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        spellings = _Spellings(model)
        *weights, bias = model.weights
        for part in parts:
            x = np.array([features(t, model, spellings) for t in part]).reshape(-1, len(weights))
            yield pd.Series(1 / (1 + np.exp(-np.clip(x @ np.array(weights) + bias, -700, 700))))

    return F.pandas_udf(run, "double")(text)


def without_toxic(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The rows of docs whose score is below the limit."""
    return docs.withColumn("_toxicity", score(F.col("text"), model)).where(F.col("_toxicity") < limit).select(*docs.columns)
