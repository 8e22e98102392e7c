"""Quality classifier: hashed subword vectors averaged per document, softmax on top.

A word's vector is the mean of the vectors of its hash bucket and of the buckets of its
character n-grams, cut from its UTF-8 bytes with a blank on each side; a word in capitals
has one more. A document's vector is the mean over its words and over a token for each word
that repeats one of the few before it. Vectors and softmax are learned together by
stochastic gradient descent in numpy. As two classes differ by one direction, a trained
model keeps one number a bucket, and a score is a mean of such numbers.

Defined results. Null or empty text: the bias and the bucket of no word. Null id: never
trained on, scored as any other. Repeated rows: scored alike. No labels of one class: the
label there is, for all; 1 without any label. Empty table: no rows. Other columns stay as
they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtide.llm.common import byte_gram_hashes, steps, text_bytes, training_rows, word_hashes, word_spans

#: Labelled documents learned from, at most: the only bound, on training alone.
TRAINING_ROWS = 4_000
#: The last buckets stand for capitals, repeats and texts without words.
BUCKETS, SIZE = 1 << 16, 12
CAPITALS, AGAIN, NONE = BUCKETS, BUCKETS + 1, BUCKETS + 2
NGRAMS = (3, 4)
EPOCHS, RATE, SEED = 5, 0.15, 7
#: Words back to which a word counts as repeated.
BACK = 3


class Features:
    """Buckets of a slice of texts: of each word, of each n-gram by its first byte."""

    def __init__(self, part: pa.RecordBatch):
        data, offsets = text_bytes(part.column("text"))
        lengths = np.diff(offsets)
        padded = np.full(len(data) + len(lengths) + 1, 0x20, np.uint8)
        padded[np.arange(len(data)) + np.repeat(np.arange(1, len(lengths) + 1), lengths)] = data
        padded[(padded >= 0x09) & (padded <= 0x0D)] = 0x20
        begins = offsets + np.arange(len(offsets)) + 1
        begins[-1] = len(padded)
        self.starts, self.ends, self.bounds = word_spans(padded, begins)
        hashes = word_hashes(padded, self.starts, self.ends)
        self.words = (hashes % np.uint64(BUCKETS)).astype(np.int64)
        self.grams = {n: (byte_gram_hashes(padded, n) % np.uint64(BUCKETS)).astype(np.int64) for n in NGRAMS}
        upper, lower = (np.concatenate([[0], np.cumsum((padded >= x) & (padded < x + 26))]) for x in (0x41, 0x61))
        count = [x[self.ends] - x[self.starts] for x in (upper, lower)]
        self.capitals = (count[0] > 1) & (count[1] == 0)
        #: Of each n: how many n-grams a word has.
        self.counts = {n: np.maximum(self.ends - self.starts + 3 - n, 0) for n in NGRAMS}
        self.size = 1 + self.capitals + sum(self.counts.values())
        doc = np.repeat(np.arange(len(lengths)), np.diff(self.bounds))
        self.again = np.zeros(len(lengths), np.int64)
        for back in range(1, BACK + 1):
            same = (hashes[back:] == hashes[:-back]) & (doc[back:] == doc[:-back])
            self.again += np.bincount(doc[back:][same], minlength=len(lengths))

    def of_text(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of a text and what each weighs in its mean."""
        own = slice(self.bounds[k], self.bounds[k + 1])
        total = own.stop - own.start + self.again[k]
        if not total:
            return np.array([NONE]), np.ones(1, np.float32)
        each = 1 / (self.size[own] * total)
        buckets, weights = [self.words[own], np.full(self.capitals[own].sum(), CAPITALS), [AGAIN]], [each, each[self.capitals[own]], [self.again[k] / total]]
        for n in NGRAMS:
            count = self.counts[n][own]
            at = np.repeat(self.starts[own] - 1 - (np.cumsum(count) - count), count) + np.arange(count.sum())
            buckets.append(self.grams[n][at])
            weights.append(np.repeat(each, count))
        where, back = np.unique(np.concatenate(buckets).astype(np.int64), return_inverse=True)
        return where, np.bincount(back, np.concatenate(weights)).astype(np.float32)

    def means(self, margin: np.ndarray) -> np.ndarray:
        """Mean margin of each text."""
        value = margin[self.words] + margin[CAPITALS] * self.capitals
        for n in NGRAMS:
            sums = np.concatenate([[0], np.cumsum(margin[self.grams[n]])])
            value = value + sums[self.starts - 1 + self.counts[n]] - sums[self.starts - 1]
        sums = np.concatenate([[0], np.cumsum(value / self.size)])
        words = sums[self.bounds[1:]] - sums[self.bounds[:-1]] + self.again * margin[AGAIN]
        total = np.diff(self.bounds) + self.again
        return np.where(total > 0, words / np.maximum(total, 1), margin[NONE])


@dataclass
class Model:
    margin: np.ndarray  # of each bucket: what it adds to the log-odds of label 1
    bias: float


def fitted(texts: list[str | None], labels: list[int]) -> Model:
    """Stochastic gradient descent over the texts, one at a time, in a random order."""
    y = np.array(labels)
    if len(set(labels)) < 2:
        return Model(np.zeros(BUCKETS + 3), -30.0 if len(y) and y[0] == 0 else 30.0)
    rng = np.random.default_rng(SEED)
    rows = []
    for part in steps([pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})]):
        features = Features(part)
        rows += [features.of_text(k) for k in range(part.num_rows)]
    vectors = rng.uniform(-1 / SIZE, 1 / SIZE, (BUCKETS + 3, SIZE)).astype(np.float32)
    out, bias = np.zeros((SIZE, 2), np.float32), np.zeros(2, np.float32)
    total, done = EPOCHS * len(rows), 0
    # The rarer label counts for more, at most fourfold.
    counts = np.bincount(y, minlength=2)
    weight = np.minimum(4.0, counts.max() / counts)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            rate = RATE * (1 - done / total)
            done += 1
            where, each = rows[k]
            mean = each @ vectors[where]
            logits = mean @ out + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y[k]] -= 1
            p *= weight[y[k]]
            back = out @ p
            out -= rate * np.outer(mean, p)
            bias -= 0.1 * rate * p
            # Scaled so that the document's own vector moves by rate * back.
            vectors[where] -= (rate / (each @ each)) * each[:, None] * back[None, :]
    return Model((vectors @ (out[:, 1] - out[:, 0])).astype(np.float64), float(bias[1] - bias[0]))


def learn(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, n: int = TRAINING_ROWS, label: str = "quality") -> Model:
    """A model of at most n labelled documents whose crc32 modulo folds is not held_out."""
    rows = training_rows(docs, labels, label, folds, held_out, n).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"] or "", r["label"]))
    return fitted([r["text"] for r in rows], [r["label"] for r in rows])


def score(text: Column, model: Model) -> Column:
    """Probability of label 1."""

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            batch = pa.RecordBatch.from_pydict({"text": pa.array(part, pa.string())})
            odds = [Features(x).means(model.margin) + model.bias for x in steps([batch])]
            yield pd.Series(1 / (1 + np.exp(-np.clip(np.concatenate(odds), -700, 700))))

    return F.pandas_udf(run, "double")(text)
