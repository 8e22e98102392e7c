import re
from collections import Counter

import pytest

from revtide.llm import quality_rules as rules


def figures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    covered = {i for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for i in (k, k + 1, k + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


TEXTS = [None, "", " \n", "a", "a b", "a b c", "a b c a b c", "x " * 60, "one two three four five six one two three\none two three", "l\nl\n\n l\nl", "é# 漢字 $$ %&|<>* x", "a b c d\n" * 30]


def test_figures_as_brute_force(spark):
    docs = spark.createDataFrame([(k, t, "clash") for k, t in enumerate(TEXTS)], "doc_id long, text string, lines string")
    made = {r.doc_id: tuple(r)[1:6] for r in rules.with_figures(docs).collect()}
    assert made == {k: figures(t) for k, t in enumerate(TEXTS)}


def test_documents_as_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    made = {r.doc_id: tuple(r)[1:6] for r in rules.with_figures(docs).collect()}
    assert made == {r.doc_id: figures(r.text) for r in docs.collect()}


FOR = dict.fromkeys(rules.NAMES, 1)


def votes(**others):
    return tuple({**FOR, **others}.values())


def p_good(spark, patterns, *asked):
    """The chance of being good of each pattern asked for, by the rates learned from the others."""
    shares, rates = rules.learned(patterns)
    rows = spark.createDataFrame([(k, *x) for k, x in enumerate(asked)], "k int, " + ", ".join(f"{n} int" for n in rules.NAMES))
    return [r.p for r in rows.select("k", rules.chance(shares, rates).alias("p")).orderBy("k").collect()], rates


def test_one_objection_of_a_strong_rule_that_is_seldom_wrong_is_enough(spark):
    patterns = [(votes(), 900), (votes(symbols=-1, symbol_share=-1), 60), (votes(symbols=0), 40)]
    (clear, strong, hint), rates = p_good(spark, patterns, votes(), votes(symbols=-1, symbol_share=-1), votes(symbols=0))
    assert clear > 0.99 and strong < 0.1 and hint > 0.9
    assert rates["good", "symbols", -1] < 0.01 < rates["noise", "symbols", -1]


def test_weak_objections_add_up(spark):
    """The weak rules of repetition object now and then to good documents, both at once to bad ones."""
    patterns = [
        (votes(), 8000),
        (votes(variety=-1), 150),
        (votes(some_repeats=-1), 150),
        (votes(some_repeats=-1, variety=-1), 300),
        (votes(some_repeats=-1, variety=-1, repeats=-1), 500),
    ]
    (one, other, both), rates = p_good(spark, patterns, votes(variety=-1), votes(some_repeats=-1), votes(some_repeats=-1, variety=-1))
    assert one > 0.5 and other > 0.5 > both
    # Rates that the rounds have found, far from where they began.
    assert rates["good", "variety", -1] < 0.03 < rules.ON_GOOD["weak"][0] < rates["repetition", "variety", -1]


def test_an_objection_of_a_rule_that_errs_is_outvoted(spark):
    """A strong rule that objects to a third of otherwise well documents loses its weight."""
    patterns = [(votes(word_length=-1), 3000), (votes(), 6000), (votes(word_length=-1, capitals=-1, some_capitals=-1), 300)]
    (kept, dropped), rates = p_good(spark, patterns, votes(word_length=-1), votes(word_length=-1, capitals=-1, some_capitals=-1))
    assert dropped < 0.5 < kept and rates["good", "word_length", -1] > 0.3


def test_abstentions_count(spark):
    patterns = [(votes(), 5000), (votes(symbols=-1, symbol_share=-1), 300), (votes(symbols=0, symbol_share=-1), 200)]
    (silent, outspoken), rates = p_good(spark, patterns, votes(symbols=0, symbol_share=-1), votes(symbol_share=-1))
    assert silent < outspoken


def test_labelled_documents_of_the_given_tables(spark):
    home = "/root/testdata/sf0.1"
    judged = rules.judged(spark.read.parquet(f"{home}/documents.parquet").select("doc_id", "text")).where("not base_failed")
    rows = judged.join(spark.read.parquet(f"{home}/labels.parquet"), "doc_id").groupBy("quality", "kept").count().collect()
    assert {(r.quality, r.kept): r["count"] for r in rows} == {(1, True): 3243, (0, False): 291}


def test_judged_rows(spark):
    clean = " ".join(f"word{k}." if k % 12 == 11 else f"word{k}" for k in range(200))
    rows = [(k, clean.replace("word", f"w{k}x"), "k") for k in range(60)] + [(100 + k, clean.replace(" ", " *** "), "k") for k in range(6)]
    rows += [(200, None, "k"), (None, clean, None), (201, "x " * 300, "k")]
    made = {r.doc_id: r.kept for r in rules.judged(spark.createDataFrame(rows, "doc_id long, text string, kept string")).collect()}
    assert all(made[k] for k in range(60)) and made[None]
    assert not any(made[k] for k in [*range(100, 106), 200, 201])


def test_empty_table(spark):
    assert rules.judged(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("name", ["op5_quality_rules", "op8_chat_formatting", "op10_mixing"])
def test_queries_against_their_sql(spark, small, name):
    from compare import assert_same, open_database

    from revtide.llm.oracle_sql import ORACLE_SQL
    from revtide.llm.queries import QUERIES

    assert_same(QUERIES[name](spark, small), open_database(small), ORACLE_SQL[name])
