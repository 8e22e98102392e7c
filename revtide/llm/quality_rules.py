"""Quality rules under weak supervision, in DataFrame functions only.

Rules on a document's figures vote for it (1), against it (-1) or abstain (0). Strong rules
object to clear cases, weak ones to hints of the same failing. How often each pattern of
votes occurs is all that expectation-maximisation needs. Documents are good, or bad by one of
the failings, as bad documents mostly show one and look well otherwise: it alternates
between the chance of each kind given a pattern and each rule's accuracy, that is how often
it casts each vote on each kind, abstentions included. Only a few pseudo-documents hold the
rates where nothing is seen. A document stays if the chance that it is good is high enough:
the votes of other rules can outweigh an objection, and objections of weak rules add up.

Defined results. Null or empty text: all figures 0, which fails the base rule. Null id and
repeated rows: judged like any other row. Equal trigrams are told by a 64-bit hash within
one text. Empty table: no rows. Other columns stay as they are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtide.llm.common import WORD, stored

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Name, failing, strength, figure, vote against from or up to, vote for up to or from; between
#: them a rule abstains. As SQL over the figures, so that both engines read the same rules.
RULES = (
    ("symbols", "noise", "strong", "n_symbols / greatest(n_words, 1)", "> 0.3", "< 0.1"),
    ("symbol_share", "noise", "weak", "n_symbols / greatest(word_chars, 1)", "> 0.015", "< 0.005"),
    ("lines", "repetition", "strong", "n_dup_lines / greatest(n_lines, 1)", "> 0.5", "< 0.35"),
    ("repeats", "repetition", "strong", "n_repeat_words / greatest(n_words, 1)", "> 0.45", "< 0.35"),
    ("some_repeats", "repetition", "weak", "n_repeat_words / greatest(n_words, 1)", "> 0.2", "< 0.1"),
    ("variety", "repetition", "weak", "n_distinct_words / greatest(n_words, 1)", "< 0.2", "> 0.4"),
    ("word_length", "shape", "strong", "word_chars / greatest(n_words, 1)", "> 12", "< 9"),
    ("capitals", "shape", "strong", "n_capitals / greatest(word_chars, 1)", "> 0.4", "< 0.2"),
    ("some_capitals", "shape", "weak", "n_capitals / greatest(word_chars, 1)", "> 0.15", "< 0.1"),
    ("sentences", "shape", "weak", "n_stops / greatest(n_words, 1)", "> 0.4", "between 0.01 and 0.3"),
)
NAMES = tuple(name for name, *_ in RULES)
KINDS = ("good", *dict.fromkeys(failing for _, failing, *_ in RULES))
ROUNDS = 15
VOTES = (-1, 0, 1)
#: Where the rounds start: how often a rule casts each vote on good documents, on documents
#: that are bad by its failing and on those that are bad by another.
ON_GOOD = {"strong": (0.005, 0.095, 0.9), "weak": (0.05, 0.15, 0.8)}
ON_OWN = {"strong": (0.7, 0.1, 0.2), "weak": (0.8, 0.1, 0.1)}
ON_OTHER = (0.1, 0.1, 0.8)
#: Documents of each kind that a rule is taken to have voted on so, besides the real ones.
PRIOR = 20
#: Share of good documents at the start.
GOOD = 0.8

Rates = dict[tuple[str, str, int], float]  # by kind, rule and vote


def _start() -> Rates:
    def of(kind: str, failing: str, strength: str) -> tuple[float, ...]:
        return ON_GOOD[strength] if kind == "good" else ON_OWN[strength] if kind == failing else ON_OTHER

    return {(kind, name, v): x for kind in KINDS for name, failing, strength, *_ in RULES for v, x in zip(VOTES, of(kind, failing, strength))}


def start_shares() -> dict[str, float]:
    return {kind: GOOD if kind == "good" else (1 - GOOD) / (len(KINDS) - 1) for kind in KINDS}


def _less(text: Column, characters: str) -> Column:
    """How many of the characters a text holds."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def _bound(value: Column, function) -> Column:
    """function(value) with value computed once, not once an element of an inner array."""
    return F.transform(F.array(value), function)[0]


def repeated_words(words: Column) -> Column:
    """Words in three-word windows that occur twice or more."""

    def starts(w: Column) -> Column:
        last = F.size(w) - 3
        windows = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("h"), i.alias("i")))
        # Both branches are typed alike; a text of fewer words has no windows.
        return F.when(last >= 0, windows).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))

    def twice(s: Column) -> Column:
        def kept(x: Column, k: Column) -> Column:
            return F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))

        return F.sort_array(F.transform(F.filter(s, kept), lambda x: x["i"]))

    def covered(s: Column) -> Column:
        each = F.transform(s, lambda x, k: F.when(k == 0, 3).otherwise(F.least(F.lit(3), x - F.get(s, k - 1))).cast("long"))
        return F.aggregate(each, F.lit(0).cast("long"), lambda a, x: a + x)

    return _bound(_bound(F.sort_array(_bound(words, starts)), twice), covered)


def with_figures(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) as doc_id and the figures that the rules read."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    read = docs.select(
        "doc_id",
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        _less(text, SYMBOLS).alias("n_symbols"),
        _less(text, CAPITALS).alias("n_capitals"),
        _less(text, ".!?").alias("n_stops"),
        lines.alias("lines"),
    )
    return read.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        "n_capitals",
        "n_stops",
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct_words"),
    )


def votes() -> dict[str, str]:
    """SQL of each rule's vote over the figures."""
    return {name: f"case when {figure} {against} then -1 when {figure} {for_} then 1 else 0 end" for name, _, _, figure, against, for_ in RULES}


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def learned(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[dict[str, float], Rates]:
    """Share of each kind and the rules' rates on it, from each pattern of votes and its count.

    There are 3 to the power of rules patterns at most, however many documents.
    """
    start = rates = _start()
    shares = start_shares()
    for _ in range(ROUNDS):
        total = dict.fromkeys(KINDS, 0.0)
        cast = dict.fromkeys(start, 0.0)
        for votes_, n in patterns:
            weight = {kind: shares[kind] * math.prod(rates[kind, name, v] for name, v in zip(NAMES, votes_)) for kind in KINDS}
            for kind, x in weight.items():
                x *= n / sum(weight.values())
                total[kind] += x
                for name, v in zip(NAMES, votes_):
                    cast[kind, name, v] += x
        every = sum(total.values()) + PRIOR
        shares = {kind: (total[kind] + PRIOR / len(KINDS)) / every for kind in KINDS}
        rates = {key: (cast[key] + PRIOR * start[key]) / (total[key[0]] + PRIOR) for key in start}
    return shares, rates


def chance(shares: dict[str, float], rates: Rates) -> Column:
    """The chance that a document with these votes is good."""
    weights = {}
    for kind in KINDS:
        weights[kind] = F.lit(shares[kind])
        for name in NAMES:
            against, none, for_ = (rates[kind, name, v] for v in VOTES)
            weights[kind] = weights[kind] * F.when(F.col(name) == -1, against).when(F.col(name) == 1, for_).otherwise(none)
    return weights["good"] / sum(weights.values())


def judged(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """doc_id, the figures, the votes, base_failed, p_good and kept of each row of docs."""
    voted = stored(with_figures(docs).withColumns({name: F.expr(x) for name, x in votes().items()}))
    counted = voted.where(~base_failed()).groupBy(*NAMES).agg(F.count("*").alias("n")).orderBy(*NAMES)
    shares, rates = learned([(tuple(r)[:-1], r["n"]) for r in counted.collect()])
    return voted.withColumns({"base_failed": base_failed(), "p_good": chance(shares, rates)}).withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= least))
