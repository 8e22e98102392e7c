"""Repeated passages: FM-index shards that documents stream through.

A window of `length` words is dealt to a shard by the smallest hash of the short runs in
it (its minimizer), so equal windows meet and neighbours mostly travel together, as one
segment of text. Segments whose minimizer stands nowhere else are not sent. Each shard
indexes its segments and streams them through backward search; a window that matches in
full and starts earlier elsewhere is repeated. Words are compared as bytes; hashes only
route. Windows of a very frequent minimizer are dealt one by one, by their own hash, and
copies of a segment within a batch are settled before anything is sent.

Defined results. Null or empty text, or fewer words than a window: nothing repeated. Null
id: after all others. Rows of one id and text: one document, alike in result. Rows of one
id and different texts: documents in a fixed order. Empty table: no rows. Other columns
stay as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.llm.common import SMALL_STEP_BYTES, gram_hashes, grouped, steps, stored, text_bytes, within, word_hashes, word_spans
from revtide.llm.fm_index import FMIndex

#: Words of the runs of which the smallest hash routes a window.
RUN = 8
#: Windows of a segment, at most.
SEGMENT = 64
#: Words that a shard should index.
SHARD_WORDS = 300_000
#: Places of a minimizer from which on its windows are dealt one by one.
FREQUENT = 20_000
#: Windows searched at once.
QUERIES = 1 << 17
#: Stands for a null id, as it comes last.
_LAST = 2**63 - 1


def minimizers(words: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word of each window that lies in one text, its minimizer, and whether it has that twice."""
    runs = gram_hashes(words, RUN)
    width = length - RUN + 1
    least, have = runs, 1
    while have * 2 <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < width:
        least = np.minimum(least[: len(least) - (width - have)], least[width - have :])
    count = np.zeros(len(least), np.int8)
    for k in range(width):
        count += runs[k : k + len(least)] == least
    good = within(bounds, length)
    return np.flatnonzero(good), least[good].view(np.int64), count[good] > 1


def _words(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = text_bytes(part.column("text"))
    starts, ends, bounds = word_spans(data, offsets)
    return data, starts, ends, bounds, word_hashes(data, starts, ends)


def _routes(docs: DataFrame, length: int, with_doc: bool) -> DataFrame:
    """The minimizers of all windows: each with how often it starts a stretch, or once a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, size=SMALL_STEP_BYTES):
            _, _, _, bounds, words = _words(part)
            if len(words) < length:
                continue
            at, least, twice = minimizers(words, bounds, length)
            doc = np.searchsorted(bounds, at, "right") - 1
            new = np.ones(len(at), bool)
            new[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1]) | (at[1:] - at[:-1] > 1)
            # Equal windows of one stretch make it longer than a run can, or hold a run twice.
            edges = np.append(np.flatnonzero(new), len(at))
            places = 1 + (np.diff(edges) > length - RUN + 1)
            if len(at):
                places += np.maximum.reduceat(twice.astype(np.int64), edges[:-1])
            least, doc = least[new], doc[new]
            if with_doc:
                order = np.lexsort((least, doc))
                least, doc = least[order], doc[order]
                new = np.ones(len(least), bool)
                new[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])
                of = {c: part.column(c).to_numpy()[doc[new]] for c in ("doc", "digest")}
                yield pa.RecordBatch.from_pydict({"route": least[new], **of})
            else:
                values, back = np.unique(least, return_inverse=True)
                yield pa.RecordBatch.from_pydict({"route": values, "n": np.bincount(back, places).astype(np.int64)})

    if with_doc:
        return docs.select("doc", "digest", "text").mapInArrow(run, "route long, doc long, digest long")
    return docs.select("text").mapInArrow(run, "route long, n long")


def _first_copies(rows: list[tuple]) -> Iterator[tuple]:
    """Of equal segments the one that comes first; the others as repeated."""
    rows.sort(key=lambda r: (r[0], r[1:5]))
    first = None
    for row in rows:
        if first is None or row[0] != first[0]:
            first = row
            yield row
        elif row[1:4] != first[1:4]:
            yield (None, *row[1:])


def _segments(texts: DataFrame, length: int) -> DataFrame:
    """Segments with a route that others have too; those without text are repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, size=SMALL_STEP_BYTES):
            data, starts, ends, bounds, words = _words(part)
            docs, digests = part.column("doc").to_pylist(), part.column("digest").to_pylist()
            routes, often = part.column("routes").to_pylist(), part.column("often").to_pylist()
            raw = data.tobytes()
            at, least, _ = minimizers(words, bounds, length) if len(words) >= length else (np.empty(0, np.int64),) * 3
            own = gram_hashes(words, length).view(np.int64) if len(words) >= length else None
            doc = np.searchsorted(bounds, at, "right") - 1
            edges = np.searchsorted(doc, np.arange(len(docs) + 1))
            rows: list[tuple] = []
            for k in range(len(docs)):
                mine, where = least[edges[k] : edges[k + 1]], at[edges[k] : edges[k + 1]]
                known = dict(zip(routes[k], often[k]))
                keep = np.isin(mine, np.array(routes[k], np.int64))
                frequent = np.isin(mine, np.array([r for r, x in known.items() if x], np.int64))
                new = np.ones(len(mine), bool)
                new[1:] = (mine[1:] != mine[:-1]) | frequent[1:]
                begin = np.flatnonzero(new)
                for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(mine)]):
                    if keep[a]:
                        for c in range(a, b, SEGMENT):
                            d = min(b, c + SEGMENT)
                            i, j = int(where[c]), int(where[d - 1]) + length
                            route = int(own[i]) if frequent[a] else int(mine[a])
                            text = b" ".join(raw[starts[i] : ends[j - 1]].split())
                            rows.append((text, docs[k], digests[k], i - int(bounds[k]), d - c, route))
            text, doc_, digest, start, windows, route = zip(*_first_copies(rows)) if rows else ((),) * 6
            yield pa.RecordBatch.from_pydict(
                {
                    "words": pa.array(text, pa.binary()),
                    "doc": pa.array(doc_, pa.int64()),
                    "digest": pa.array(digest, pa.int64()),
                    "start": pa.array(start, pa.int32()),
                    "windows": pa.array(windows, pa.int32()),
                    "route": pa.array(route, pa.int64()),
                }
            )

    return texts.mapInArrow(run, "words binary, doc long, digest long, start int, windows int, route long")


def _searched(rows: pa.Table, length: int) -> pa.RecordBatch:
    """Runs of repeated windows of a shard; rows come by document and start."""
    doc, digest, start = (rows.column(c).to_numpy() for c in ("doc", "digest", "start"))
    again = np.zeros(len(doc), bool)
    again[1:] = (doc[1:] == doc[:-1]) & (digest[1:] == digest[:-1]) & (start[1:] == start[:-1])
    number: dict[bytes, int] = {}
    first: dict[bytes, int] = {}
    sequences, new, copies = [], [], []
    for k, words in enumerate(rows.column("words").to_pylist()):
        if not again[k]:
            # A segment equal to an earlier one is repeated as a whole; it need not be indexed.
            if first.setdefault(words, len(sequences)) < len(sequences):
                copies.append((k, first[words]))
            else:
                new.append(k)
                sequences.append([number.setdefault(w, len(number) + 1) for w in words.split(b" ")] + [0])
    copied, originals = np.array(copies, np.int64).reshape(-1, 2).T
    whole = doc[copied], digest[copied], start[copied]
    doc, digest, start = doc[new], digest[new], start[new]
    sizes = np.array([len(x) for x in sequences])
    text = np.concatenate([np.array(x, np.int64) for x in sequences])
    begins = np.cumsum(sizes) - sizes
    counts = sizes - length
    places = np.repeat(begins - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    index = FMIndex(text)
    repeated = []
    for k in range(0, len(places), QUERIES):
        part = places[k : k + QUERIES]
        reached, low, high = index.matches(text, part, length)
        full = reached == length
        part = part[full]
        repeated.append(part[index.first(low[full], high[full]) < part])
    found = np.concatenate(repeated)
    segment = np.searchsorted(begins, found, "right") - 1
    new = np.ones(len(found), bool)
    new[1:] = (np.diff(found) > 1) | (np.diff(segment) > 0)
    at = np.flatnonzero(new)
    segment = segment[at]
    return pa.RecordBatch.from_pydict(
        {
            "doc": np.concatenate([doc[segment], whole[0]]),
            "digest": np.concatenate([digest[segment], whole[1]]),
            "start": np.concatenate([start[segment] + found[at] - begins[segment], whole[2]]).astype(np.int32),
            "windows": np.concatenate([np.diff(np.append(at, len(found))), counts[originals]]).astype(np.int32),
        }
    )


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)), "digest": F.xxhash64("text")})


def repeated_windows(docs: DataFrame, length: int = 20) -> tuple[DataFrame, DataFrame]:
    """Runs of windows that start earlier elsewhere (doc, digest, start, windows), and the
    texts (doc, digest, text) that may hold some."""
    keyed = _keyed(docs.select("doc_id", "text")).select("doc", "digest", "text")
    routes = _routes(keyed, length, with_doc=False).groupBy("route").agg(F.sum("n").alias("n")).where("n > 1")
    shared = _routes(keyed, length, with_doc=True).join(routes, "route")
    # Sets, as rows of one id and text bring the same routes.
    lists = shared.groupBy("doc", "digest").agg(F.collect_set(F.struct("route", (F.col("n") > FREQUENT).alias("often"))).alias("x"))
    texts = stored(keyed.join(lists, ["doc", "digest"]).select("doc", "digest", "text", F.col("x.route").alias("routes"), F.col("x.often").alias("often")))
    segments = stored(_segments(texts, length))
    told = segments.where("words is null").select("doc", "digest", "start", "windows")
    sent = segments.where("words is not null")
    shards = max(1, (sent.agg(F.sum(F.col("windows") + length)).head()[0] or 0) // SHARD_WORDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["shard"]):
            yield _searched(group, length)

    dealt = sent.withColumn("shard", F.pmod(F.xxhash64("route"), F.lit(shards))).repartition("shard").sortWithinPartitions("shard", "doc", "digest", "start")
    searched = dealt.select("shard", "doc", "digest", "start", "words").mapInArrow(run, "doc long, digest long, start int, windows int")
    return told.union(searched), texts.select("doc", "digest", "text")


def _kept(text: str, runs: list[dict], length: int) -> tuple[int, int, bytes, bytes]:
    """Words, removed words, kept words by single spaces, and the text without the removed."""
    data = text.encode()
    starts, ends, _ = word_spans(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    step = np.zeros(len(starts) + 1, np.int64)
    for run in runs:
        step[run["start"]] += 1
        step[run["start"] + run["windows"] + length - 1] -= 1
    kept = np.cumsum(step[:-1]) == 0
    edge = np.diff(np.concatenate([[0], kept.astype(np.int8), [0]]))
    pieces = [data[starts[a] : ends[b - 1]] for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]
    return len(starts), int((~kept).sum()), b" ".join(b" ".join(pieces).split()), b" ".join(pieces)


def changed_texts(docs: DataFrame, length: int = 20) -> DataFrame:
    """doc, digest, n_removed, kept_sha256 and kept_text of texts that lose words."""
    windows, texts = repeated_windows(docs, length)
    runs = windows.groupBy("doc", "digest").agg(F.collect_list(F.struct("start", "windows")).alias("runs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, size=SMALL_STEP_BYTES):
            rows = [_kept(t, r, length) for t, r in zip(part.column("text").to_pylist(), part.column("runs").to_pylist())]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc": part.column("doc"),
                    "digest": part.column("digest"),
                    "n_removed": pa.array([r[1] for r in rows], pa.int64()),
                    "kept_sha256": pa.array([hashlib.sha256(r[2]).hexdigest() for r in rows], pa.string()),
                    "kept_text": pa.array([r[3].decode() for r in rows], pa.string()),
                }
            )

    out = texts.join(runs, ["doc", "digest"]).mapInArrow(run, "doc long, digest long, n_removed long, kept_sha256 string, kept_text string")
    return out.dropDuplicates(["doc", "digest"])


def removal_report(docs: DataFrame, length: int = 20) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, size=SMALL_STEP_BYTES):
            words = [(t or "").encode().split() for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column("doc_id"),
                    "doc": part.column("doc"),
                    "digest": part.column("digest"),
                    "n_words": pa.array([len(w) for w in words], pa.int64()),
                    "whole_sha256": pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in words], pa.string()),
                }
            )

    keyed = _keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).select("doc_id", "doc", "digest", "text")
    whole = keyed.mapInArrow(run, "doc_id long, doc long, digest long, n_words long, whole_sha256 string")
    changed = stored(changed_texts(docs, length).drop("kept_text"))
    return whole.join(changed, ["doc", "digest"], "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256")
    )


def without_repeats(docs: DataFrame, length: int = 20) -> DataFrame:
    """docs with repeated passages cut out of the text; a row that loses all words keeps an empty text."""
    changed = stored(changed_texts(docs, length).select("doc", "digest", "kept_text"))
    rows = docs.withColumns({"_doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)), "_digest": F.xxhash64("text")})
    cut = rows.join(changed.toDF("_doc", "_digest", "_kept"), ["_doc", "_digest"], "left")
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col("_kept").isNotNull(), F.length("_kept").cast("long")).otherwise(F.col("n_chars")))
    return cut.withColumn("text", F.coalesce("_kept", "text")).select(*docs.columns)
