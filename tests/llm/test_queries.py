"""The registered queries over tables with odd rows: one folder, read as the driver reads it."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from test_toxicity import levenshtein_score
from tokenizers import Tokenizer

from revtide.llm import quality_model, toxicity
from revtide.llm.common import STEP_BYTES
from revtide.llm.queries import QUERIES

#: Longer than a step of the numpy work.
LONG = " ".join(f"word{k * k % 5003}" for k in range(300_000))
#: Doc id and text: null, empty, blank, ties, rows that repeat an id with and without its text.
ODD = [(None, None), (None, "no id here"), (-1, ""), (-1, ""), (-2, " \n\t"), (-3, LONG), (-4, "tie of two"), (-5, "tie of two"), (-6, "one text"), (-6, "another text"), (-7, None)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with odd rows, and with columns named like those that the operators make."""
    assert len(LONG) > STEP_BYTES
    out = tmp_path_factory.mktemp("odd")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame(ODD, "doc_id long, text string")
    docs.union(odd).selectExpr(
        "doc_id", "text", "'x' as label", "0.5D as score", "1 as quality", "1 as toxic", "7L as start", "'y' as node", "true as held_out", "3 as n_words", "'z' as own"
    ).write.parquet(f"{out}/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    labels.selectExpr("*", "'x' as text", "0.5D as score", "2 as label").write.parquet(f"{out}/labels.parquet")
    return str(out)


@pytest.fixture(scope="module")
def rows(spark, folder):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]


def texts_of(rows):
    """Texts of each id; only ids of one text tell which row is which."""
    out = defaultdict(set)
    for doc_id, text in rows:
        out[doc_id].add(text)
    return out


def one_text(rows):
    return {d: t.copy().pop() for d, t in texts_of(rows).items() if len(t) == 1}


def check_scores(made, rows, folds, fold, limit):
    assert Counter(r.doc_id for r in made) == Counter(d for d, _ in rows)
    for r in made:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % folds == fold)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= limit)
    by_id = {r.doc_id: r.score for r in made}
    assert by_id[-4] == by_id[-5]
    assert by_id[-1] == pytest.approx(by_id[-7])
    return by_id


def test_quality_of_odd_rows(spark, folder, rows):
    made = QUERIES["op4_quality_classifier"](spark, folder).collect()
    by_id = check_scores(made, rows, 4, 2, 0.7)
    tables = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_model.learn(*tables)
    for doc_id, text in one_text(rows).items():
        # Bucket by bucket, the text on its own.
        where, each = quality_model.Features(pa.RecordBatch.from_pydict({"text": pa.array([text], pa.string())})).of_text(0)
        odds = sum(model.margin[k] * x for k, x in zip(where.tolist(), each.tolist())) + model.bias
        assert by_id[doc_id] == pytest.approx(1 / (1 + math.exp(-odds)), abs=1e-4)


def test_toxicity_of_odd_rows(spark, folder, rows):
    made = QUERIES["op9_toxicity"](spark, folder).collect()
    by_id = check_scores(made, rows, 5, 0, 0.5)
    model = toxicity.learn(*(spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels")))
    assert model.terms
    short = {d: t for d, t in one_text(rows).items() if t is None or len(t) < 2000}
    for doc_id, text in sorted(short.items(), key=str)[:40]:
        assert by_id[doc_id] == pytest.approx(levenshtein_score(text or "", model), abs=1e-9), text


def test_language_model_of_odd_rows(spark, folder, rows):
    made = QUERIES["op1_masked_lm"](spark, folder).collect()
    assert Counter(r.doc_id for r in made) == Counter(d for d, _ in rows)
    values = defaultdict(set)
    for r in made:
        told = {k: v for k, v in r.asDict().items() if k != "doc_id"}
        assert all(v is None or math.isfinite(v) for v in told.values() if isinstance(v, (float, type(None))))
        values[r.doc_id].add(tuple(told.values()))
    assert values[-4] == values[-5]
    assert len(values[-1]) == 1 and values[-1] == values[-7] == values[-2]
    assert len(values[-6]) == 2


def test_packing_of_odd_rows(spark, folder, rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, windows = defaultdict(list), defaultdict(list)
    for p in QUERIES["op7_packing"](spark, folder).collect():
        pieces[p.doc_id].append(p)
        windows[p.sequence_id].append(p)
    for own in windows.values():
        edges = sorted((p.offset, p.offset + p.length) for p in own)
        assert [a for a, _ in edges] == [0, *(b for _, b in edges[:-1])] and edges[-1][1] <= 1024
    times = Counter(rows)
    for doc_id, text in one_text(rows).items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        assert sum(p.length for p in pieces[doc_id]) == len(ids) * times[doc_id, text]
        for p in pieces[doc_id]:
            assert p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
    assert max(len(own) for own in pieces.values()) > 300
