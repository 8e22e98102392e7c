"""Packing documents into token windows by order-preserving dynamic programming.

Documents stay in the order of the table; each input split is a stream of its own, so no
text is shuffled. Windows may be cut at a document's end for nothing, at a sentence's end
for a small penalty and, in text without sentences, every few tokens for a larger one.
The cheapest cuts satisfy

    cost(j) = penalty(j) + size - at(j) + min { cost(i) + at(i) : at(j) - size <= at(i) < at(j) },

a sliding-window minimum, kept in a monotone queue. The stream is solved in chunks; the
last window of a chunk goes back into the next one, so the cuts are the cheapest of each chunk,
not of the whole stream, and they change with the input's splits.

Defined results. Null text: empty, so the end id alone. Null id: kept as null. Repeated
rows: each is packed. Empty table: no rows. Other columns are not read.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from revtide.llm.common import steps
from revtide.llm.token_counts import PIECE, Merges, byte_letters

SIZE = 1024
END_ID = 0
#: Cost in tokens of a cut at a sentence's end and of one inside a sentence.
SENTENCE, INSIDE = 4, 24
#: Inside a stretch without sentence ends a cut may be made every so many tokens.
STRETCH, EVERY = 64, 16
#: Tokens solved at once, at least.
CHUNK = 1 << 18
#: Known space-separated pieces of a worker; beyond that it forgets them all.
KNOWN = 400_000

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class _Pieces(dict):
    """Number of each piece of text, whose ids are appended to the encoder's list when it is new."""

    def __init__(self, encoder: Encoder, before: str):
        self.encoder, self.before = encoder, before

    def __missing__(self, piece: str) -> int:
        encoder = self.encoder
        if self.before and (not piece or piece[0].isspace()):
            number = 0  # blank runs reach over the piece's edge
        else:
            number = len(encoder.ends)
            encoder.ids.extend(encoder.fast.encode_ordinary(self.before + piece))
            encoder.ends.append(len(encoder.ids))
        self[piece] = number
        return number


class Encoder:
    """The ids that the tokenizer in a file gives, without special tokens added.

    A byte-level pre-tokenizer never joins characters across a space that stands between
    two other characters, but to the word after it; so the ids of a text are those of its
    pieces " word", of which most are known already. A text with runs of blanks or with
    a special token's string goes through whole.
    """

    def __init__(self, path: str):
        import tiktoken

        # Raises for any other kind of tokenizer than this one encodes.
        Merges(path)
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        letters = {letter: b for b, letter in enumerate(byte_letters())}
        self.special = [x["content"] for x in told["added_tokens"]]
        ranks = {bytes(letters[c] for c in word): k for word, k in told["model"]["vocab"].items() if word not in self.special}
        # This encoder merges by the rank of what a merge makes; the file's order must be the same.
        made = [told["model"]["vocab"]["".join(pair.split(" ") if isinstance(pair, str) else pair)] for pair in told["model"]["merges"]]
        if made != sorted(made):
            raise ValueError(f"{path}: merges are not in the order of the vocabulary")
        self.fast = tiktoken.Encoding("own", pat_str=PIECE, mergeable_ranks=ranks, special_tokens={})
        self.path, self.whole = path, None
        self.sentence_end = np.zeros(max(ranks.values()) + 1 + len(self.special), bool)
        for word, k in ranks.items():
            self.sentence_end[k] = word[-1:] in b".!?" or b"\n" in word
        self.forget()

    def forget(self) -> None:
        self.ids, self.ends = array("I"), array("q", [0])
        self.first, self.later = _Pieces(self, ""), _Pieces(self, " ")

    def _whole(self, text: str) -> list[int]:
        if not any(x in text for x in self.special):
            return self.fast.encode_ordinary(text)
        if self.whole is None:
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(self.path)
        return self.whole.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str | None], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by end_id, and how many each has."""
        if len(self.ends) > KNOWN:
            self.forget()
        numbers, whole, counts = array("q"), {}, np.ones(len(texts), np.int64)
        first, later = self.first.__getitem__, self.later.__getitem__
        pieces = np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            if not text:
                continue
            parts = text.split(" ")
            own = array("q", [first(parts[0])])
            own.extend(map(later, islice(parts, 1, None)))
            if 0 in own[1:] or any(x in text for x in self.special):
                whole[k] = self._whole(text)
                counts[k] += len(whole[k])
            else:
                numbers.extend(own)
                pieces[k] = len(own)
        numbers = np.frombuffer(numbers, np.int64)
        ids, ends = np.frombuffer(self.ids, np.uint32), np.frombuffer(self.ends, np.int64)
        begins, lengths = ends[numbers - 1], ends[numbers] - ends[numbers - 1]
        # A piece's number is 1 or more, as number 0 stands for blank runs.
        upto = np.concatenate([[0], np.cumsum(lengths)])
        known = ids[np.repeat(begins - upto[:-1], lengths) + np.arange(upto[-1])]
        of_text = np.concatenate([[0], np.cumsum(pieces)])
        here = upto[of_text]
        counts += np.diff(here)
        out = np.empty(counts.sum(), np.uint32)
        end = np.cumsum(counts)
        out[end - 1] = end_id
        inside = np.ones(len(out), bool)
        inside[end - 1] = False
        for k, own in whole.items():
            out[end[k] - counts[k] : end[k] - 1] = own
            inside[end[k] - counts[k] : end[k]] = False
        out[inside] = known
        return out, counts


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def candidates(ids: np.ndarray, doc_ends: np.ndarray, sentence_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where windows may be cut (0 first, the end last), and what a cut costs there."""
    cost = np.full(len(ids) + 1, -1, np.int64)
    cost[1:][sentence_end[ids]] = SENTENCE
    cost[doc_ends] = 0
    cost[[0, len(ids)]] = 0
    at = np.flatnonzero(cost >= 0)
    gaps = np.diff(at)
    for k in np.flatnonzero(gaps > STRETCH):
        inner = np.arange(at[k] + EVERY, at[k + 1], EVERY)
        cost[inner] = INSIDE
    at = np.flatnonzero(cost >= 0)
    return at, cost[at]


def best_cuts(at: np.ndarray, penalty: np.ndarray, size: int = SIZE) -> list[int]:
    """The cuts of least padding plus penalties, first and last position included."""
    where, fee = at.tolist(), penalty.tolist()
    before = [0] * len(where)
    queue: deque[tuple[int, int, int]] = deque([(0, 0, 0)])  # cost + position, position, index
    for j in range(1, len(where)):
        here = where[j]
        while queue[0][1] < here - size:
            queue.popleft()
        least, _, before[j] = queue[0]
        total = least + size + fee[j]  # the cost at j plus its position
        while queue and queue[-1][0] >= total:
            queue.pop()
        queue.append((total, here, j))
    cuts, j = [where[-1]], len(where) - 1
    while j:
        j = before[j]
        cuts.append(where[j])
    return cuts[::-1]


class _Stream:
    """Tokens that are not packed yet; the first document may have begun earlier."""

    def __init__(self, table: np.ndarray, size: int, partition: int):
        self.table, self.size = table, size
        self.sequence = partition << 33
        self.ids = [np.empty(0, np.uint32)]
        self.begins = [np.empty(0, np.int64)]
        self.counts = [np.empty(0, np.int64)]
        self.names: list[int | None] = []
        self.length = 0

    def add(self, names: list[int | None], ids: np.ndarray, counts: np.ndarray) -> None:
        self.names += names
        self.ids.append(ids)
        self.begins.append(self.length + np.cumsum(counts) - counts)
        self.counts.append(counts)
        self.length += len(ids)

    def packed(self, last: bool) -> pa.RecordBatch | None:
        """Pieces of all windows, but for the last one if more tokens follow."""
        ids, begins, counts = map(np.concatenate, (self.ids, self.begins, self.counts))
        ends = begins + counts
        cuts = np.array(best_cuts(*candidates(ids, ends, self.table), self.size))
        if not last:
            cuts = cuts[:-1]
        done = int(cuts[-1])
        edges = np.union1d(cuts, begins[(begins > 0) & (begins < done)])
        start, end = edges[:-1], edges[1:]
        doc = np.searchsorted(begins, start, "right") - 1
        window = np.searchsorted(cuts, start, "right") - 1
        data = memoryview(ids.astype("<u4").tobytes())
        out = pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array([self.names[k] for k in doc], pa.int64()),
                "start": start - begins[doc],
                "length": end - start,
                "ids_crc32": pa.array([zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(start.tolist(), end.tolist())], pa.int64()),
                "doc_tokens": counts[doc],
                "sequence_id": self.sequence + window,
                "offset": start - cuts[window],
            }
        )
        open_docs = ends > done
        self.names = [x for x, more in zip(self.names, open_docs) if more]
        self.ids, self.begins, self.counts = [ids[done:].copy()], [begins[open_docs] - done], [counts[open_docs]]
        self.length = len(ids) - done
        self.sequence += len(cuts) - 1
        return out


def pack(docs: DataFrame, path: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """One row a piece of a document: where it lies in its document and in its window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path)
        stream = _Stream(known.sentence_end, size, TaskContext.get().partitionId())
        for part in steps(batches):
            names = part.column("doc_id").cast(pa.int64()).to_pylist()
            stream.add(names, *known.encode(part.column("text").to_pylist(), end_id))
            if stream.length >= CHUNK:
                yield stream.packed(last=False)
        if stream.length:
            yield stream.packed(last=True)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
