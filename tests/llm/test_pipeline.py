"""The stages one after another, each held against its operator or a brute-force version."""

import public_tokenizers
import pytest
from cases import ODD_TEXTS, SMALL, documents, words
from test_decontaminate import brute as hits
from test_decontaminate import windows
from test_jaccard import brute as classes

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from yearloom.llm import language, quality, queries
from yearloom.llm import tokens as tk
from yearloom.session import scratch_path


@pytest.fixture(scope="module")
def stages(spark):
    """Name to (input, output) of every stage."""
    docs, out = documents(spark), {}
    for name, stage in pipeline.STAGES:
        path = scratch_path(spark, f"test-{name}")
        stage(spark, docs, SMALL).write.parquet(path)
        out[name] = docs, spark.read.parquet(path)
        docs = out[name][1]
    return out


def rows(df):
    return sorted(df.collect())


def test_all_but_the_last_return_documents(spark, stages):
    assert [n for n, _ in pipeline.STAGES] == list(stages) == ["language", "quality", "jaccard", "decontamination", "packing"]
    for name, (_, out) in stages.items():
        if name != "packing":
            assert out.schema == documents(spark).schema


def test_language(spark, stages):
    before, after = stages["language"]
    model = language.fit(before.where(~language.learning_fold()))
    labelled = language.label(before.selectExpr("*", "false held_out"), model)
    kept = {r.doc_id for r in labelled.where("lang_pred <> 'und' and score >= 0.5").collect()}
    assert rows(after) == [r for r in rows(before) if r.doc_id in kept]


def test_quality(spark, stages):
    before, after = stages["quality"]
    judged = quality.classify(before, spark.read.parquet(f"{SMALL}/labels.parquet"))
    kept = {r.doc_id for r in judged.where("kept").collect()}
    assert rows(after) == [r for r in rows(before) if r.doc_id in kept] and after.count() < before.count()


def test_jaccard(stages):
    before, after = stages["jaccard"]
    firsts = {d for d, c, _ in classes([(r.doc_id, r.text) for r in before.collect()]) if d == c}
    assert rows(after) == [r for r in rows(before) if r.doc_id in firsts] and after.count() < before.count()


def test_decontamination(spark, stages):
    before, after = stages["decontamination"]
    found = windows([(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()], 10)
    left = {r.doc_id: r for r in after.collect()}
    for r in before.collect():
        n, hit, _ = hits(r.text, found)
        if not hit:
            assert left[r.doc_id] == r
        elif r.doc_id in left:
            assert hits(left[r.doc_id].text, found)[1] == 0 and 0 < len(words(left[r.doc_id].text)) <= n - hit
        else:
            assert hit == n


def test_packing(stages):
    before, after = stages["packing"]
    own = tk.load(public_tokenizers.path("byte_bpe_50k.json"))
    lengths = {r.doc_id: r.n for r in after.groupBy("doc_id").sum("length").withColumnRenamed("sum(length)", "n").collect()}
    assert lengths == {r.doc_id: len(own.encode(r.text, add_special_tokens=False).ids) + 1 for r in before.collect()}
    assert after.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0


def test_odd_documents_pass_all_stages(spark):
    odd = [(i, t, None if i % 2 else "en", "s", None) for i, t in enumerate(ODD_TEXTS[:-1])]
    docs = spark.createDataFrame(odd + odd[-3:] + [(None, "no id here", "en", None, 3)], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in pipeline.STAGES:
        path = scratch_path(spark, "test-odd")
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
    assert "sequence_id" in docs.columns
    empty = documents(spark).limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0


def test_queries_are_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(queries.QUERIES) <= set(entry.queries()) and entry.queries()["pipeline"] is pipeline.run
    assert set(queries.ORACLE) <= set(queries.QUERIES)
