import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from revtide.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected_ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


TEXTS = [None, "", " ", "a", " a", "  a", "a  b", "a \nb", "a\n \nb", "x  y", "don't  stop!! \t\tnow", "<|endoftext|> b", "é ñ 漢字 😀  z", "a b ", "tail\n\n", "\n\nhead of it", "1 22 333 a1b2", "w" * 3000]


def test_ids_are_the_tokenizers():
    tokenizer, own = Tokenizer.from_file(PATH), packing.Encoder(PATH)
    rng = random.Random(1)
    made = TEXTS + ["".join(rng.choice("ab .,'\n\t é1! s") for _ in range(rng.randrange(40))) for _ in range(3000)]
    ids, counts = own.encode(made, 0)
    ends = np.cumsum(counts)
    for text, end, count in zip(made, ends, counts):
        assert ids[end - count : end].tolist() == expected_ids(tokenizer, text), repr(text)


def test_cuts_are_the_cheapest():
    rng = random.Random(2)
    for _ in range(200):
        at = np.cumsum([0, *(rng.randrange(1, 9) for _ in range(rng.randrange(1, 30)))])
        fee = np.array([0, *(rng.choice((0, 1, 4)) for _ in at[1:])])
        cost = [0.0] + [float("inf")] * (len(at) - 1)
        for j in range(1, len(at)):
            cost[j] = min(cost[i] + 10 - (at[j] - at[i]) for i in range(j) if at[j] - at[i] <= 10) + fee[j]
        cuts = packing.best_cuts(at, fee, 10)
        known = dict(zip(at.tolist(), fee.tolist()))
        assert sum(10 - (b - a) + known[b] for a, b in zip(cuts, cuts[1:])) == cost[-1]
        assert max(b - a for a, b in zip(cuts, cuts[1:])) <= 10


@pytest.mark.parametrize("chunk", [packing.CHUNK, 500])
def test_every_id_lies_in_one_piece(spark, monkeypatch, chunk):
    monkeypatch.setattr(packing, "CHUNK", chunk)
    tokenizer = Tokenizer.from_file(PATH)
    rng = random.Random(3)
    rows = [(k, text, "own") for k, text in enumerate(TEXTS)]
    rows += [(100 + k, " ".join(rng.choice(("one.", "two", "three")) for _ in range(rng.choice((3, 40, 900)))), "own") for k in range(60)]
    rows += [(None, "no id", None), (7, "the same id again with more ids in it", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(3, "text")
    pieces = packing.pack(docs, PATH, 64 if chunk == 500 else 1024).collect()
    size = 64 if chunk == 500 else 1024
    windows, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        windows[p.sequence_id].append(p)
        by_doc[p.doc_id].append(p)
    for own in windows.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= size
    for doc_id, text, _ in rows:
        ids = expected_ids(tokenizer, text)
        own = sorted((p for p in by_doc[doc_id] if p.doc_tokens == len(ids)), key=lambda p: p.start)
        at = 0
        for p in own:
            assert p.start == at
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pieces = packing.pack(docs, PATH).collect()
    windows = len({p.sequence_id for p in pieces})
    assert sum(p.length for p in pieces) > 0.985 * 1024 * windows


def test_other_tokenizers_are_refused(tmp_path):
    import json

    import public_tokenizers
    import pytest

    with pytest.raises(ValueError, match="not a byte-level"):
        packing.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        told = json.load(file)
    told["model"]["merges"][0], told["model"]["merges"][5] = told["model"]["merges"][5], told["model"]["merges"][0]
    (tmp_path / "other.json").write_text(json.dumps(told))
    with pytest.raises(ValueError, match="order"):
        packing.Encoder(str(tmp_path / "other.json"))
