import math
import random

import pytest
from pyspark.sql import functions as F

from revtide.llm import toxicity as tox
from revtide.llm.common import remainder

TERMS = ["idiot", "moron", "worthless", "disgusting", "vequ*", "scum"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_automaton_as_edit_distances():
    rng = random.Random(3)
    automaton = tox.Automaton(TERMS)
    words = ["vequ", "vequder", "veque", "vqu", ""]
    for _ in range(4000):
        word = list(rng.choice(TERMS).rstrip("*"))
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(word) + 1)
            word[k : k + rng.randrange(2)] = rng.choice(["", "x", "o", "is"])
        words.append("".join(word))
    for word in words:
        near = {t: distance(word, t) for t in TERMS if not t.endswith("*")}
        good = {t for t, d in near.items() if d <= tox.allowed_edits(t)} | ({"vequ*"} if word.startswith("vequ") else set())
        found = automaton.match(word)
        assert (found is not None) == bool(good), word
        if found and not found[0].endswith("*"):
            assert found[0] in good and found[1] == near[found[0]]


def test_stems_within_their_edits():
    automaton = tox.Automaton(["vequado*", "vequados", "scum*"])
    for word, edits in {"vequadora": 0, "vequxdora": 1, "vquadora": 1, "veequadora": 1, "vequados": 0, "vequadxos": 1, "scummy": 0}.items():
        found = automaton.match(word)
        assert found and found[1] == edits, word
    assert not any(map(automaton.match, ["vxquxdora", "scxmmy", "scmmy", "vequ", "other"]))
    spellings = tox._Spellings(tox.Model({"vequado*": 1.0}, frozenset(), frozenset(["vequator"])))
    assert [spellings[x] for x in ("vequadora", "vequxdora", "vequator")] == [1.0, tox.MISSPELLED, 0.0]
    sizes = {0: 5000, 1: 100}
    assert set(tox.chosen({"vequado*": 60, "vequados": 18, "vequadora": 18}, {}, sizes)) == {"vequado*", "vequados", "vequadora"}
    # A term that is told to be exact takes no edit, the other ones do.
    automaton = tox.Automaton(["vequado*", "worthless"], ["vequado*"])
    assert automaton.match("vequxdora") is None and automaton.match("vequadora") and automaton.match("wrthless") == ("worthless", 1)


def test_all_likely_terms_are_taken():
    words = {f"{k:03d}xyzw": 9 for k in range(900)}
    assert set(tox.chosen(words, {}, {0: 5000, 1: 100})) == set(words)


def test_a_common_syllable_is_no_term():
    sizes = {0: 9000, 1: 1000}
    assert tox.chosen({"cion*": 700, "scum": 90}, {"cion*": 6300, "scum": 2}, sizes).keys() == {"scum"}
    # Words that are frequent on both sides, but far more so on one, count less.
    both = tox.chosen({"achlich*": 180, "scum": 90}, {"achlich*": 150}, sizes)
    assert 0 < both["achlich*"] < both["scum"] == 1
    assert tox.evidence(10, 90, 100, 900) == pytest.approx(0, abs=1e-9)


def levenshtein_score(text, model):
    """The score by edit distances to every term, word by word."""

    def nearest(word):
        found = []
        for term in model.terms:
            edits = 0 if term in model.exact else tox.allowed_edits(term)
            parts = [word[:k] for k in range(len(word) + 1)] if term.endswith("*") else [word]
            d = min(distance(x, term.removesuffix("*")) for x in parts)
            if d <= edits:
                found.append((d, term))
        return min(found, default=None)

    words = (text or "").lower().split()
    plain = [w.rstrip(tox._TRIM + "#$%&").lstrip(tox._TRIM + "#%&") for w in words]
    total = most = 0.0
    for k, word in enumerate(plain):
        near = nearest(word)
        if near and near[0] == 0:
            count = model.terms[near[1]]
        elif word in model.clean_forms:
            continue
        else:
            near = near or nearest(word.translate(tox._LOOKALIKE))
            if not near:
                continue
            count = tox.MISSPELLED * model.terms[near[1]]
        around = plain[max(0, k - 4) : k] + plain[k + 1 : k + 5]
        lean = sum(tox.CUES.get(x, 0) + model.context.get(x, 0) for x in around)
        if words[k][0] in tox._QUOTES or words[k].rstrip(".,;:!?")[-1:] in tox._QUOTES:
            lean -= 1.5
        total += count / (1 + math.exp(-2 - lean))
        most = max(most, count / (1 + math.exp(-2 - lean)))
    a, b, c, bias = model.weights
    return 1 / (1 + math.exp(-(a * math.log1p(total) + b * most + c * min(1, 20 * total / (len(words) + 10)) + bias)))


def test_scores_as_by_edit_distances(spark):
    rng = random.Random(8)
    terms = {"idiot": 1.0, "moron": 0.9, "worthless": 0.8, "vequado*": 0.7, "scum": 1.0, "lost*": 0.5, "bomente*": 0.6}
    model = tox.Model(terms, frozenset(["bomente*"]), frozenset(["idiom", "moton"]), {"near": 0.4, "the": -0.2}, (1.1, 0.7, 0.9, -2.0))
    others = ["the", "near", "you", "said", "idiom", "moton", "id1ot", "$cum", "sc\"um", '"scum"', "'idiot',", "lostra", "lst", "bomentes", "bomxntes", "", "WORTHLESS!!", "worthles###"]
    texts = [None, "", " ", "idiot " * 3000 + "x " * 3000]
    for _ in range(150):
        words = []
        for _ in range(rng.randrange(1, 30)):
            word = list(rng.choice([*others, *terms]).rstrip("*"))
            for _ in range(rng.choice([0, 0, 1, 2])):
                k = rng.randrange(len(word) + 1)
                word[k : k + rng.randrange(2)] = rng.choice(["", "x", "o", "is"])
            words.append("".join(word))
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = {r.doc_id: r.s for r in docs.select("doc_id", tox.score(docs["text"], model).alias("s")).collect()}
    for k, text in enumerate(texts):
        assert made[k] == pytest.approx(levenshtein_score(text, model), rel=1e-9), text


def test_quotation_weighs_less_than_abuse():
    model = tox.Model(terms=dict.fromkeys(TERMS, 1.0))
    spellings = tox._Spellings(model)
    said = tox.features('the article quoted the word "idiot" as reported', model, spellings)
    abuse = tox.features("you are an idiot and you know", model, spellings)
    misspelled = tox.features("you are an id1ot and you know", model, spellings)
    assert said[0] < 0.5 * misspelled[0] < misspelled[0] < abuse[0]
    assert tox.features(None, model, spellings) == tox.features("", model, spellings) == (0.0, 0.0, 0.0)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghijklm") for _ in range(rng.randrange(3, 9))) for _ in range(400)]
    rows = []
    for k in range(700):
        text = [rng.choice(words) for _ in range(60)]
        toxic = k % 7 == 0
        for _ in range(3 * toxic):
            text.insert(rng.randrange(60), rng.choice(["idiot", "worthless", "scum", "vequ" + rng.choice(words)]))
        rows.append((k, " ".join(text), int(toxic)))
    docs = spark.createDataFrame([(d, t, "x") for d, t, _ in rows], "doc_id long, text string, label string")
    labels = spark.createDataFrame([(d, y, 1) for d, _, y in rows] + [(None, 1, 1), (5, None, None)], "doc_id long, toxic int, text int")
    return docs, labels, rows, words


def test_held_out_accuracy_and_misspellings(spark, corpus):
    docs, labels, rows, words = corpus
    model = tox.learn(docs, labels)
    assert {"idiot", "worthless", "scum"} <= set(model.terms) and any("vequ".startswith(t[:-1]) or t.startswith("vequ") for t in model.terms if t.endswith("*"))
    made = {r.doc_id: r.score for r in docs.select("doc_id", tox.score(docs["text"], model).alias("score")).collect()}
    right = [(made[d] >= 0.5) == bool(y) for d, _, y in rows]
    assert sum(right) > 0.98 * len(right)
    plain = " ".join(words[:50])
    odd = spark.createDataFrame([(1, plain + " worthles wrthless worthlesss idiott"), (2, plain), (3, None), (4, "")], "doc_id long, text string")
    kept = {r.doc_id for r in tox.without_toxic(odd, model).collect()}
    assert kept == {2, 3, 4}


def test_clean_spellings_of_similar_texts_are_kept(spark, corpus):
    docs, labels, _, words = corpus
    common = " ".join(words[:300])
    more = spark.createDataFrame([(10_000 + k, common + (" idiom" if k == 17 else ""), "x") for k in range(20)], docs.schema)
    judged = spark.createDataFrame([(10_000 + k, 0, 1) for k in range(20)], labels.schema)
    model = tox.learn(docs.union(more), labels.union(judged))
    assert "idiot" in model.terms and "idiom" in model.clean_forms


def test_copies_count_as_one_text(spark, corpus):
    docs, labels, _, words = corpus
    text = " ".join(words[:40]) + " harmless once " + " ".join(words[40:80])
    more = spark.createDataFrame([(10_000 + k, text, "x") for k in range(60)], docs.schema)
    judged = spark.createDataFrame([(10_000 + k, 1, 1) for k in range(60)], labels.schema)
    assert not {"harmless", "once"} & set(tox.learn(docs.union(more), labels.union(judged)).terms)


def test_terms_with_many_clean_neighbours_match_exactly(spark, corpus):
    docs, labels, _, words = corpus
    more = spark.createDataFrame([(10_000 + k, f"{' '.join(words[k : k + 60])} worth{'abcdefghijklmnop'[k]}less", "x") for k in range(16)], docs.schema)
    judged = spark.createDataFrame([(10_000 + k, 0, 1) for k in range(16)], labels.schema)
    model = tox.learn(docs.union(more), labels.union(judged))
    assert "worthless" in model.exact and "idiot" not in model.exact
    assert model.automaton().match("worthqless") is None


def test_held_out_fifth_of_the_given_tables(spark):
    home = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{home}/{x}.parquet") for x in ("documents", "labels"))
    model = tox.learn(docs, labels)
    judged = docs.join(labels.where("toxic is not null").select("doc_id", "toxic"), "doc_id").where(remainder(F.col("doc_id"), 5) == 0)
    rows = judged.select("toxic", (tox.score(F.col("text"), model) >= 0.5).alias("flagged")).collect()
    for toxic, flagged in ((1, lambda share: share >= 0.9), (0, lambda share: share <= 0.015)):
        of = [r.flagged for r in rows if r.toxic == toxic]
        assert len(of) > 90 and flagged(sum(of) / len(of)), (toxic, sum(of), len(of))


def test_without_labels_or_rows(spark, corpus):
    docs, labels, _, _ = corpus
    model = tox.learn(docs, labels.limit(0))
    assert model.terms == {} and docs.select(tox.score(docs["text"], model).alias("s")).where("s > 0.001").count() == 0
    empty = docs.limit(0)
    assert tox.without_toxic(empty, tox.learn(empty, labels)).collect() == []
