"""What the training-data operators share: scratch tables, word spans and hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, in Java's, Python's and RE2's syntax alike.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that one numpy step works on; a longer text is a step of its own.
STEP_BYTES = 2 << 20
#: The same where little memory is left: numpy holds eight and more times as much, and each worker keeps its
#: largest step's share for good.
SMALL_STEP_BYTES = 1 << 19


def scratch_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share.

    Only where it is unset and Spark runs in local mode, as in tests, a new temporary
    folder is set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame, rows: int | None = None, per_file: int = 4096) -> DataFrame:
    """df written to the shared folder and read back: it survives lost executors.

    Where df is known to have no more than `rows`, the last stage runs in as many tasks as give
    each file `per_file` of them, or in fewer. A file has a cost of its own, whatever it holds: on a
    local file system without Hadoop's native library two processes are started for each.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // per_file)))
    path = f"{scratch_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n."""
    return F.crc32(doc_id.cast("string")) % n


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, n: int) -> DataFrame:
    """Id, text and label (0 or 1) of at most n labelled documents outside the held-out fold.

    Of the rows of one id, the one whose text has the smallest hash.
    """
    rows = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), folds) != held_out))
        .groupBy("doc_id")
        .agg(F.max(label).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(n)
    )
    # Of at most n rows, so it may be broadcast.
    found = docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id")
    once = found.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("r"))
    return once.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("r.text").alias("text"), "label")


# --- bytes of text in numpy -------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def lower_bytes(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z lower-cased."""
    return _LOWER[data]


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def random_odd(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1)


_BYTE = random_odd(1, 256)
_FACTOR = int(random_odd(2, 1)[0])
_INVERSE = pow(_FACTOR, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n + n // 4, SMALL_STEP_BYTES + (1 << 16)), base, np.uint64)
        known[0] = 1
        known = _powers[base] = np.cumprod(known)
    return known[:n]


def steps(batches: Iterable[pa.RecordBatch], column: str = "text", size: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in slices of about `size` bytes of text."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offsets = text_bytes(batch.column(column))
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[begin] + size, "right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, or the bytes of binary values, and where each begins; null is empty."""
    if column.type not in (pa.string(), pa.binary()):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the index of each text's first word (one more at the end)."""
    if not len(data):
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    edge = np.empty(len(data) + 1, bool)
    edge[0] = edge[-1] = True
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[offsets] = True
    at = np.flatnonzero(edge)
    word = inside[at[:-1]]
    starts, ends = at[:-1][word], at[1:][word]
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of each word's bytes, A-Z lower-cased on request."""
    if lower:
        data = _LOWER[data]
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[data] * _power(_FACTOR, len(data)), out=sums[1:])
    own = (sums[ends] - sums[starts]) * _power(_INVERSE, len(data) + 1)[starts]
    return mixed(own + (ends - starts).astype(np.uint64))


_PLACE = random_odd(3, 64)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive word hashes, by its first word; texts are not told apart."""
    count = max(len(words) - n + 1, 0)
    total = np.zeros(count, np.uint64)
    for k in range(n):
        total += words[k : k + count] * _PLACE[k]
    return mixed(total)


def byte_gram_hashes(data: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n bytes, by its first byte."""
    count = max(len(data) - n + 1, 0)
    letters = _BYTE[data]
    total = np.zeros(count, np.uint64)
    for k in range(n):
        total += letters[k : k + count] * _PLACE[k]
    return mixed(total)


def within(bounds: np.ndarray, n: int) -> np.ndarray:
    """For each run of n words, whether it lies in one text; bounds as from word_spans."""
    total = int(bounds[-1])
    good = np.zeros(max(total - n + 1, 0), bool)
    lengths = np.diff(bounds)
    for begin, length in zip(bounds[:-1][lengths >= n], lengths[lengths >= n]):
        good[begin : begin + length - n + 1] = True
    return good


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each group; the batches come sorted by keys."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for x in columns:
            change[1:] |= x[1:] != x[:-1]
        edges = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            key = tuple(x[a] for x in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)
