from collections import defaultdict

import corpus_pipeline as pipeline
from test_near_duplicates import expected as near_expected
from test_substrings import expected as substring_expected

from revtide.llm import substrings, toxicity
from revtide.llm.common import stored


def test_stages_as_brute_force(spark, small):
    """Each stage on what the one before has kept, against a slow version of it."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "substrings", "mixing", "packing"]
    kept = [docs]
    for _, stage in pipeline.STAGES:
        kept.append(stored(stage(spark, kept[-1], small)))
        if len(kept) < 6:
            assert kept[-1].schema == docs.schema
    start, clean, unlike, cut, mix, pieces = ([r.asDict() for r in x.collect()] for x in kept)

    model = toxicity.learn(docs, spark.read.parquet(f"{small}/labels.parquet"))
    spellings = toxicity._Spellings(model)

    def odds(text):
        *weights, bias = model.weights
        return sum(x * w for x, w in zip(toxicity.features(text, model, spellings), weights, strict=True)) + bias

    assert {r["doc_id"] for r in clean} == {r["doc_id"] for r in start if odds(r["text"]) < 0}
    components = near_expected([(r["doc_id"], r["text"]) for r in clean], 80)
    assert {r["doc_id"] for r in unlike} == {d for d, (_, c) in components.items() if c == d}
    want = substring_expected([(r["doc_id"], r["text"]) for r in unlike])
    report = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.removal_report(kept[2]).collect()}
    assert report == want
    before = {r["doc_id"]: r["text"] for r in unlike}
    assert {r["doc_id"] for r in cut} == set(before)
    for r in cut:
        n_words, n_removed, _ = want[r["doc_id"]]
        assert len(r["text"].encode().split()) == n_words - n_removed
        assert n_removed or r["text"] == before[r["doc_id"]]
    sizes = {r["doc_id"]: len(r["text"].encode().split()) for r in cut}
    taken = defaultdict(int)
    for r in mix:
        taken[r["doc_id"]] += len(r["text"].encode().split())
    assert all(taken[d] <= 2 * n for d, n in sizes.items())
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= 30
    assert sorted(p["doc_id"] for p in pieces if not p["start"]) == sorted(r["doc_id"] for r in mix)


def test_empty_table(spark, small, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{small}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert pipeline.run(spark, str(tmp_path)).collect() == []


def test_nulls_and_clashing_columns(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(20)
    odd = spark.createDataFrame([(None, None, None, None, None), (-1, "", "en", None, 0), (None, "words " * 30, None, "a", None)], docs.schema)
    rows = docs.union(odd).union(odd).selectExpr("*", "1 as node", "'x' as digest", "2 as _size", "3 as component_id")
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{small}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    made = pipeline.run(spark, str(tmp_path)).collect()
    assert None in {p.doc_id for p in made}
