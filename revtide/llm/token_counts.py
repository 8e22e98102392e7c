"""Token counts by byte-pair merging with a heap and a linked list.

A text is cut at the strings of added tokens, which are a token each, and then into the
pieces of the byte-level pre-tokenizer. A piece is a linked list of its bytes; a heap holds
its adjacent pairs that the vocabulary merges, by rank and then place. The lowest pair is
popped and merged until none is left, so a piece has as many tokens as bytes less merges,
and no token's id is ever made. A piece of n bytes takes n log n steps. Counts of pieces are remembered,
up to a bound, by every worker.

A single space between two other characters always begins a new piece, so a text's pieces
are those of its parts before each space; only a text in which a run of blanks reaches over
such an edge is cut as a whole.

Defined results. Null or empty text: 0 bytes and 0 tokens. Null id: kept as null. Repeated
rows: counted each. A very long text is one row of one task, in memory a few times its size.
Empty table: no rows. Other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.llm.common import steps

#: Pieces whose counts a worker remembers; beyond that it forgets them all.
KNOWN = 1_000_000

# The byte-level pre-tokenizer's pattern.
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class Merges:
    """Which adjacent symbols merge, at which rank and into what, read from a tokenizer's file.

    Symbols are numbered as they come: the bytes first, then what each merge makes.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model, before = told["model"], told.get("pre_tokenizer") or {}
        odd = [
            model.get("type", "BPE") != "BPE",
            any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")),
            before.get("type") != "ByteLevel" or before.get("add_prefix_space", True) or not before.get("use_regex", True),
            bool(told.get("normalizer") or told.get("truncation") or told.get("padding")),
            any(x[k] for x in told.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip")),
        ]
        if any(odd):
            raise ValueError(f"{path}: not a byte-level byte-pair tokenizer with its own pattern and plain added tokens")
        number = {letter: b for b, letter in enumerate(byte_letters())}
        if not number.keys() <= model["vocab"].keys():
            raise ValueError(f"{path}: the vocabulary lacks bytes")
        #: (left symbol << 32 | right symbol) to (rank, symbol made).
        self.made: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            made = number.setdefault(left + right, len(number))
            self.made[number[left] << 32 | number[right]] = (rank, made)
        special = sorted((x["content"] for x in told.get("added_tokens", [])), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.special_texts = special

    def tokens(self, piece: bytes) -> int:
        """Number of symbols left of a piece when no adjacent two can merge."""
        n = len(piece)
        if n < 2:
            return n
        made = self.made
        symbols = list(piece)
        heap = []
        for k in range(n - 1):
            found = made.get(symbols[k] << 32 | symbols[k + 1])
            if found:
                heap.append((found[0], k, symbols[k], symbols[k + 1], found[1]))
        if not heap:
            return n
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = 0
        while heap:
            _, k, left, right, into = heappop(heap)
            other = after[k]
            # Entries of symbols that have merged since are passed over.
            if symbols[k] != left or other >= n or symbols[other] != right:
                continue
            merges += 1
            symbols[k], symbols[other] = into, -1
            beyond = after[k] = after[other]
            if beyond < n:
                before[beyond] = k
                found = made.get(into << 32 | symbols[beyond])
                if found:
                    heappush(heap, (found[0], k, into, symbols[beyond], found[1]))
            ahead = before[k]
            if ahead >= 0:
                found = made.get(symbols[ahead] << 32 | into)
                if found:
                    heappush(heap, (found[0], ahead, symbols[ahead], into, found[1]))
        return n - merges


class _Known(dict):
    """Tokens of each part of a text, begun by the space before it; -1 if it is to be cut with its neighbours."""

    def __init__(self, counter: Counter, space: str):
        self.counter, self.space = counter, space

    def __missing__(self, part: str) -> int:
        if self.space and (not part or part[0].isspace()):
            found = -1
        else:
            found = self.counter.pieces(self.space + part)
        self[part] = found
        return found


class Counter:
    """Tokens of texts under the tokenizer in a file, with the pieces that are known."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.cut = regex.compile(PIECE).findall
        self.forget()

    def forget(self) -> None:
        self.first, self.later = _Known(self, ""), _Known(self, " ")

    def pieces(self, text: str) -> int:
        tokens = self.merges.tokens
        return sum(tokens(piece.encode()) for piece in self.cut(text))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if any(x in text for x in self.merges.special_texts):
            parts = self.merges.special.split(text)
            return len(parts) - 1 + sum(map(self._plain, parts))
        return self._plain(text)

    def _plain(self, text: str) -> int:
        if not text:
            return 0
        if len(self.first) + len(self.later) > KNOWN:
            self.forget()
        parts = text.split(" ")
        counts = list(map(self.later.__getitem__, islice(parts, 1, None)))
        if counts and min(counts) < 0:
            return self.pieces(text)
        return self.first[parts[0]] + sum(counts)


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_bytes and n_tokens of each row of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).count
        for part in steps(batches):
            found = np.fromiter(map(count, part.column("text").to_pylist()), np.int64, part.num_rows)
            yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "n_bytes": part.column("n_bytes"), "n_tokens": found})

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", size.alias("n_bytes"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
