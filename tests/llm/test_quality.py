import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from cases import ODD_TEXTS, SMALL, documents
from pyspark.sql import functions as F

from yearloom.llm import ngram_counts as nc
from yearloom.llm import quality as ql

ORDER = ql.ORDER


def symbols(text):
    return ["<"] * (ORDER - 1) + [("char", "0" if c in "0123456789" else c) for c in text or ""] + [">"]


class Brute:
    """The model's formulas over Python counters."""

    def __init__(self, texts):
        top = Counter()
        for t in texts:
            s = symbols(t)
            top.update(tuple(s[i - ORDER + 1:i + 1]) for i in range(ORDER - 1, len(s)))
        self.levels = {ORDER: top}
        for m in range(ORDER - 1, 0, -1):
            self.levels[m] = Counter(g[1:] for g in self.levels[m + 1])
        self.cuts, self.contexts = {}, {}
        for m, level in self.levels.items():
            self.cuts[m] = [0, *nc.discounts([sum(n == k for n in level.values()) for k in (1, 2, 3, 4)])]
            self.contexts[m] = defaultdict(lambda: [0, 0, 0, 0])
            for g, n in level.items():
                self.contexts[m][g[:-1]][0] += n
                self.contexts[m][g[:-1]][min(n, 3)] += 1

    def probability(self, gram):
        m = len(gram)
        if not m:
            return 1 / (len(self.levels[1]) + 1)
        own = self.contexts[m].get(gram[:-1])
        below = self.probability(gram[1:])
        if own is None:
            return below
        n = self.levels[m].get(gram, 0)
        spread = sum(d * k for d, k in zip(self.cuts[m][1:], own[1:], strict=True))
        return max(n - self.cuts[m][min(n, 3)], 0) / own[0] + spread / own[0] * below

    def score(self, text):
        s = symbols(text)
        return sum(math.log(self.probability(tuple(s[i - ORDER + 1:i + 1]))) for i in range(ORDER - 1, len(s)))


@pytest.fixture(scope="module")
def fitted(spark):
    docs = documents(spark)
    trusted = docs.where("doc_id < 60").select("doc_id")
    model = ql.fit(docs, trusted)
    return docs, model, Brute(r.text for r in docs.where("doc_id < 60").collect())


def test_scores_agree_with_the_formulas(spark, fitted, monkeypatch):
    docs, model, brute = fitted
    odd = spark.createDataFrame([(-i, t, None) for i, t in enumerate(ODD_TEXTS[:-1], 1)], "doc_id long, text string, lang string")
    some = docs.where("doc_id < 90 and doc_id >= 50").select("doc_id", "text", "lang").unionByName(odd)
    folder = ql.answers(some, model)
    got = {r.doc_id: r for r in ql.score(some, model, folder).collect()}
    assert len(got) == some.count()
    for row in some.collect():
        own = got[row.doc_id]
        if not row.text:
            assert (own.n_chars_scored, own.log_perplexity, own.surprise) == (0, None, None)
            continue
        total = brute.score(row.text)
        assert own.n_chars_scored == len(row.text)
        assert math.isclose(own.log_perplexity, -total / (len(row.text) + 1), rel_tol=1e-5)
        assert math.isclose(own.surprise, max(-total - ql.SLACK, 0) / (len(row.text) + 1), rel_tol=1e-4, abs_tol=1e-5)


def test_probabilities_sum_to_one(fitted):
    _, _, brute = fitted
    for context in (symbols("")[:ORDER - 1], symbols("the ")[-ORDER:-1], [("char", "☃")] * (ORDER - 1)):
        total = sum(brute.probability((*context, *g)) for g in brute.levels[1]) + brute.probability((*context, "?"))
        assert math.isclose(total, 1.0)


def test_blocks_without_answers_read_the_table(fitted, tmp_path):
    docs, model, _ = fitted
    some = docs.where("doc_id < 70")
    with_answers = ql.score(some, model, ql.answers(some, model)).collect()
    without = ql.score(some, model, f"file://{tmp_path}/none").collect()
    assert sorted(with_answers) == sorted(without)


def test_answers_are_found_by_their_block(fitted, monkeypatch):
    docs, model, _ = fitted
    folder = ql.answers(docs, model)
    texts = pa.array([r.text for r in docs.collect()], pa.string())
    monkeypatch.setattr(ql.Model, "answer", None)  # only the block's file may be read
    n, total = ql.block_scores(ql.Grams(texts), model, folder)
    assert len(n) == len(texts) and np.isfinite(total).all()


def test_numbering_is_the_same_dense_or_sorted():
    values = np.random.default_rng(0).integers(0, 50, 200)
    dense, sparse = ql._numbered(values, 50), ql._numbered(values, ql.DENSE + 1)
    assert all((a == b).all() for a, b in zip(dense, sparse, strict=True))


def test_good_texts_stay_and_bad_ones_go(spark):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    docs = documents(spark)
    judged = ql.classify(docs, labels)
    by_label = {(r.quality, r.kept): r["count"] for r in judged.join(labels, "doc_id").where("toxic = 0").groupBy("quality", "kept").count().collect()}
    assert by_label.get((1, False), 0) == 0
    assert by_label.get((0, False), 0) > 2 * by_label.get((0, True), 0)
    left = {r.doc_id for r in ql.keep_good(docs, labels).collect()}
    assert left == {r.doc_id for r in judged.where("kept").collect()}


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "en", 0), (2, "", None, 0), (3, "abc", None, 0), (3, "abc", None, 0), (None, "x", "en", 0)],
                                 "doc_id long, text string, lang string, kept int")
    labels = spark.createDataFrame([(3, 1, 0), (3, 1, None), (None, 1, 0), (1, 1, 0), (2, 1, 1)], "doc_id long, quality int, toxic int")
    got = sorted(((r.doc_id, r.kept, r.n_chars_scored) for r in ql.classify(docs, labels).collect()), key=str)
    assert got == [(1, False, 0), (2, False, 0), (3, True, 3), (3, True, 3), (None, True, 1)]
    assert sorted(ql.keep_good(docs, labels).collect(), key=str) == sorted(docs.where("text <> ''").collect(), key=str)
    assert ql.classify(docs.limit(0), labels).collect() == []
    none = ql.classify(docs, labels.limit(0)).collect()
    assert {(r.kept, r.threshold) for r in none if r.n_chars_scored} == {(True, None)}


def test_labels_that_disagree_are_not_trusted(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, 0), (3, 1, 1)], "doc_id long, quality int, toxic int")
    assert [r.doc_id for r in ql.trusted_documents(labels).collect()] == [2]


def test_clean_texts_the_model_has_not_seen_stay(spark):
    docs = documents(spark, SMALL.replace("0.001", "0.01"))
    labels = spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/labels.parquet")
    trusted = ql.trusted_documents(labels).where("pmod(xxhash64(doc_id, 7), 4) = 0")
    hidden = labels.join(trusted, "doc_id", "left_anti")
    judged = ql.classify(docs, hidden).join(trusted, "doc_id").where("n_chars_scored > 0")
    found = {r.lang: (r.n, r.kept) for r in judged.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.col("kept").cast("int")).alias("kept")).collect()}
    assert len(found) == 4 and all(kept >= 0.9 * n for n, kept in found.values()), found


def test_folds_share_no_text(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i % 10}", "en") for i in range(40)] + [(40, None, "en"), (41, "", "en")], "doc_id long, text string, lang string")
    trusted = docs.select("doc_id")
    learned, held = ({r.doc_id for r in f.collect()} for f in ql.folds(docs, trusted))
    assert learned | held == set(range(40)) and held and not {i % 10 for i in learned} & {i % 10 for i in held}
    monkeypatch.setattr(ql, "MOST_TRUSTED", 5)
    assert [f.count() for f in ql.folds(docs, trusted)] == [5, len(held)]
    assert [f.count() for f in ql.folds(docs, trusted.limit(0))] == [0, 0]


def test_a_few_bad_words_in_a_long_text_are_seen(spark):
    draw = np.random.default_rng(3)
    parts = "the an er ing ti on ha re st en ou at nd".split()

    def prose(n):
        return " ".join("".join(draw.choice(parts, draw.integers(1, 4))) for _ in range(n))

    rows = [(i, prose(int(draw.integers(30, 600))), "en") for i in range(400)]
    rows += [(400 + i, f"{prose(200)} kzqxwvj {prose(200)}", "en") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(300)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in ql.keep_good(docs, labels).collect()}
    assert not kept & set(range(400, 420)) and len(kept & set(range(300, 400))) >= 95 and len(kept & set(range(300))) >= 285


def test_worst_stretch():
    values = -np.array([1.0, 1, 9, 9, 1, 1, 1, 1, 1, 1, 1, 5, 8, 1])
    found = ql.worst_stretch(values, np.array([0, 11, 13, 14]))
    wanted = [24 / 8 - ql.DOUBLING * 2, 13 / 8, 1 / 8]
    assert ql.STRETCH == 8 and np.allclose(found, wanted) and len(ql.worst_stretch(np.zeros(0), np.zeros(1, int))) == 0


def test_files_of_answers(tmp_path):
    rng = np.random.default_rng(3)
    folder = f"file://{tmp_path}"
    blocks = {int(n): rng.random(int(n) % 7, np.float32) for n in rng.integers(-2**63, 2**63, 40)}
    for file in range(3):
        ql.write_answers(folder, 3, {n: x for n, x in blocks.items() if n % 3 == file})
    for name, values in blocks.items():
        assert ql.read_answers(folder, 3, name).tolist() == values.tolist()
    assert ql.read_answers(folder, 3, 5) is None and ql.read_answers(folder, 7, 6) is None


def test_division_of_work_does_not_matter(spark, monkeypatch):
    docs = documents(spark)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    want = sorted(tuple(r) for r in ql.classify(docs, labels).drop("lang").fillna(0.0).collect())
    for name, value in (("SHARD_GRAMS", 1_000), ("TASK_BYTES", 3_000), ("FILE_BYTES", 100_000)):
        monkeypatch.setattr(ql, name, value)
    model = ql.fit(docs, ql.folds(docs, ql.trusted_documents(labels))[0])
    assert model.shards > 16 and model.slices > 1 and model.files > 1
    assert sorted(tuple(r) for r in ql.classify(docs, labels).drop("lang").fillna(0.0).collect()) == want
