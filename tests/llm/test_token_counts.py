import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from revtide.llm import token_counts as counts
from revtide.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def odd_texts():
    rng = random.Random(4)
    bits = ["the", "don't", "'s", " ", "  ", "\n", "\n\n", " \n", "\t", " ", "　", "\r\n", "é", "é", "日本", "🙂", "\U0001f469‍\U0001f4bb", "123", "4.5", "--", "$$$", "<|endoftext|>", "<|endof", "text|>", "\x00", "\x1f", "\x85", "A", "zzzz", "Straße", "...", "_", "İ", "ﬁ"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 40))) for _ in range(1500)]
    texts += [chr(k) * n for k in (0x20, 0x0A, 0x61, 0xE9, 0x4E2D) for n in (1, 2, 3, 17)]
    return [None, "", "<|endoftext|>", "<|endoftext|><|endoftext|> a", " <|endoftext|> ", *texts]


def test_as_the_library_counts(spark, library):
    texts = [*odd_texts(), "ab" * 30_000, "word " * 50_000, " " * 20_000, "x\n" * 20_000]
    rows = [(k if k % 9 else None, text, k, "s") for k, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long, n_bytes string").repartition(4)
    made = counts.token_counts(docs, PATH).collect()
    told = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in made)
    assert told == sorted((d is None, d or 0, len((t or "").encode()), library(t)) for d, t, _, _ in rows)


def test_lowest_rank_first(library):
    counter = counts.Counter(PATH)
    rng = random.Random(2)
    for _ in range(3000):
        piece = "".join(rng.choice("abcdehinorst") for _ in range(rng.randrange(1, 30)))
        assert counter.merges.tokens(piece.encode()) == library(piece), piece
    assert counter.merges.tokens(b"") == 0 and counter.merges.tokens(b"a") == 1


def test_pieces_that_are_forgotten_count_alike(monkeypatch, library):
    monkeypatch.setattr(counts, "KNOWN", 5)
    counter = counts.Counter(PATH)
    for text in odd_texts()[:300]:
        assert counter.count(text) == library(text)


def test_the_given_documents(spark, library, small):
    made = {r.doc_id: r for r in QUERIES["op13_token_counts"](spark, small).collect()}
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(made)
    for r in rows:
        n = library(r.text)
        assert (made[r.doc_id].n_tokens, made[r.doc_id].n_bytes, made[r.doc_id].over_limit) == (n, len(r.text.encode()), n > 1024)


def test_repeated_rows_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "one two"), (1, "one two"), (None, None)], "doc_id long, text string")
    assert sorted(r.n_tokens for r in counts.token_counts(docs, PATH).collect()) == [0, 2, 2]
    assert counts.token_counts(docs.limit(0), PATH).collect() == []


def test_other_tokenizers_are_refused(tmp_path):
    with pytest.raises(ValueError):
        counts.Merges(public_tokenizers.path("word_bpe_49k.json"))
