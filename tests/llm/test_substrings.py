import hashlib
import random
import re

import numpy as np
import pytest

from revtide.llm import substrings
from revtide.llm.fm_index import FMIndex, suffix_array


def expected(rows, length=20):
    """Brute force: doc_id to (n_words, n_removed, kept_sha256)."""
    first, made = {}, {}
    for doc, text in sorted(rows):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for k in range(len(words) - length + 1):
            window = tuple(words[k : k + length])
            if first.setdefault(window, (doc, k)) < (doc, k):
                gone[k : k + length] = [True] * length
        kept = " ".join(w for w, x in zip(words, gone) if not x)
        made[doc] = (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return made


def report(df, length=20):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.removal_report(df, length).collect()}


def made_rows(seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(30)]
    passage = [rng.choice(words) for _ in range(70)]
    rows = [(0, None), (1, ""), (2, "a " * 20), (3, "b " * 21), (4, "c\n" * 200), (5, " ".join("xy"[k % 2] for k in range(60)))]
    for k in range(6, 120):
        text = [rng.choice(words) for _ in range(rng.randrange(0, 60))]
        if k % 3 == 0:
            text += passage[rng.randrange(30) : rng.randrange(40, 70)]
        text += [rng.choice(words) for _ in range(rng.randrange(0, 60))]
        rows.append((k, ("\n" if k % 2 else "  ").join(text)))
    return rows + [(k + 500, t) for k, t in rows[10:20]]


@pytest.mark.parametrize("frequent, shard", [(20_000, 300_000), (3, 300), (20_000, 200)])
def test_as_brute_force(spark, monkeypatch, frequent, shard):
    monkeypatch.setattr(substrings, "FREQUENT", frequent)
    monkeypatch.setattr(substrings, "SHARD_WORDS", shard)
    monkeypatch.setattr(substrings, "SEGMENT", 5)
    monkeypatch.setattr(substrings, "QUERIES", 50)
    rows = made_rows(frequent)
    df = spark.createDataFrame([(k, t, "clash", 1) for k, t in rows], "doc_id long, text string, route string, digest int").repartition(5)
    assert report(df) == expected(rows)


def test_documents_as_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert report(docs) == expected([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_nulls_and_repeated_rows(spark):
    text = " ".join(map(str, range(30)))
    df = spark.createDataFrame([(None, text), (5, text + " end"), (5, text + " end"), (3, "x " + text)], "doc_id long, text string")
    made = sorted(((r.doc_id, r.n_removed) for r in substrings.removal_report(df).collect()), key=str)
    assert made == sorted([(None, 30), (5, 30), (5, 30), (3, 0)], key=str)


def test_lists_of_a_text_are_its_own(spark, monkeypatch):
    texts = [" ".join(f"{k}_{j}" for j in range(40)) for k in range(30)]
    rows = [(None, t) for t in texts] + [(k, t) for k, t in enumerate(texts)] + [(None, texts[0])] * 20
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept, sizes = substrings.stored, []

    def stored(x):
        out = kept(x)
        if "routes" in out.columns:
            sizes.extend(len(r.routes) for r in out.collect())
        return out

    monkeypatch.setattr(substrings, "stored", stored)
    made = substrings.removal_report(df).collect()
    assert len(sizes) == 80 and max(sizes) <= 21
    assert sorted(r.n_removed for r in made) == [0] * 30 + [40] * 50


def test_texts_without_repeats_keep_columns(spark):
    text = " ".join(map(str, range(30)))
    df = spark.createDataFrame([(1, "a  b\n" + text, 9, "k"), (2, "c\td  " + text + "\ne f", 9, "k"), (3, text, 9, "k"), (4, None, None, None)], "doc_id long, text string, n_chars long, doc string")
    made = {r.doc_id: (r.text, r.n_chars, r.doc) for r in substrings.without_repeats(df).collect()}
    assert made == {1: ("a  b\n" + text, 9, "k"), 2: ("c\td e f", 7, "k"), 3: ("", 0, "k"), 4: (None, None, None)}


def test_empty_table(spark):
    assert substrings.removal_report(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_index_finds_what_is_there():
    rng = np.random.default_rng(4)
    text = rng.integers(1, 5, 400)
    text[rng.choice(400, 30, replace=False)] = 0
    text[-1] = 0
    index = FMIndex(text)
    starts = np.array([k for k in range(390) if 0 not in text[k : k + 4]])
    reached, low, high = index.matches(text, starts, 4)
    windows = [text[k : k + 4].tolist() for k in starts]
    for k, own in enumerate(windows):
        longest = max([0, *(n for n in range(1, 5) if sum(text[i : i + n].tolist() == own[4 - n :] for i in range(400 - n + 1)) > 1)])
        assert reached[k] == longest
    full = reached == 4
    first = index.first(low[full], high[full])
    assert first.tolist() == [next(s for s, w in zip(starts.tolist(), windows) if w == windows[k]) for k in np.flatnonzero(full)]


def test_suffix_order():
    text = np.array([2, 1, 2, 1, 0, 2, 1, 0])
    assert suffix_array(text).tolist() == [4, 7, 3, 6, 1, 2, 5, 0]
