import numpy as np
import pytest
from cases import crc, documents

from yearloom.llm import language as lg


def test_best_path_equals_a_plain_search(monkeypatch):
    monkeypatch.setattr(lg, "STRETCH", 4)
    rng = np.random.default_rng(0)
    for _ in range(200):
        languages, sizes = rng.integers(1, 4), rng.integers(0, 13, 3)
        owner = np.concatenate([[0], np.cumsum(sizes)])
        scores = rng.normal(size=(owner[-1], languages)) * 6
        labels = lg.best_path(scores, owner, 8.0)
        for i in range(3):
            own = scores[owner[i]:owner[i + 1]]
            if len(own):
                best = own[0].copy()
                for row in own[1:]:
                    best = row + np.maximum(best, best.max() - 8.0)
                path = labels[owner[i]:owner[i + 1]]
                value = own[np.arange(len(own)), path].sum() - 8.0 * (path[1:] != path[:-1]).sum()
                assert abs(value - best.max()) < 1e-9


def test_held_out_accuracy(spark):
    docs = documents(spark)
    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = lg.fit_and_label(docs).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (crc(str(r.doc_id)) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97


@pytest.fixture(scope="module")
def model(spark):
    return lg.fit(documents(spark))


def test_learns_from_text_and_label_alone(spark, model):
    docs = documents(spark)
    again = lg.fit(docs.selectExpr("text", "lang", "-doc_id as doc_id"))
    assert again.languages == model.languages and np.allclose(again.weights, model.weights)
    half = docs.where("lang is not null").withColumnRenamed("source", "label")
    assert np.allclose(lg.fit(half.orderBy("text")).weights, model.weights)


def test_mixed_text_gets_spans(spark, model):
    text = ("Éçeau aianre leèvi aich aux aiètionier pour dans que les. The of and thintion ing ereding that with for this. "
            "Geau steinsch enerach und den schteer der die nicht mit sich")
    docs = spark.createDataFrame([(1, text, False, "zz")], "doc_id long, text string, held_out boolean, lang_pred string")
    row = lg.label(docs, model).first()
    assert [s.lang for s in row.spans] == ["fr", "en", "de"]
    assert row.spans[0].first == 0 and all(a.last == b.first for a, b in zip(row.spans, row.spans[1:]))
    assert row.score < 0.6


def test_odd_rows(spark, model):
    rows = [(1, None), (2, ""), (3, "123 ... —"), (4, "日本語 привет"), (5, "der die das und nicht"), (5, "der die das und nicht"), (None, "the of and"), (6, "é" * 5_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "false as held_out", "7 as score")
    got = sorted(lg.label(docs, model).collect(), key=str)
    assert [(r.doc_id, r.lang_pred, r.score, r.spans) for r in got if r.doc_id in (1, 2, 3)] == [(i, "und", 0.0, []) for i in (1, 2, 3)]
    assert {r.lang_pred for r in got if r.doc_id == 5} == {"de"} and len([r for r in got if r.doc_id == 5]) == 2
    assert all(r.lang_pred in (*model.languages, "und") for r in got)
    kept = lg.keep_identified(docs, model)
    assert kept.schema == docs.schema and not {1, 2, 3} & {r.doc_id for r in kept.collect()}
    assert lg.label(docs.limit(0), model).collect() == []


def test_no_language_learned(spark):
    docs = spark.createDataFrame([(1, "text", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in lg.fit_and_label(docs).collect()} == {("und", 0.0)}


def test_scripts_narrow_candidates(spark):
    rows = [("привет как дела", "ru"), ("hello how are you", "en"), ("γεια σου", "el")] * 3
    train = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(rows)], "doc_id long, text string, lang string")
    model = lg.fit(train)
    docs = spark.createDataFrame([(1, "xxxx zzzz"), (2, "щщщ"), (3, "ωωω")], "doc_id long, text string").selectExpr("*", "true as held_out")
    assert {r.doc_id: r.lang_pred for r in lg.label(docs, model).collect()} == {1: "en", 2: "ru", 3: "el"}




def test_many_stray_languages(spark):
    """More labels than a file holds, most of one text each; no label is left out and good ones still win."""
    rows = [(i, f"{'abcdefghij'[i % 10] * 3} {'klmnopqrst'[i // 10 % 10] * 4} zz{i}", f"stray {i:04d}") for i in range(1_300)]
    rows += [(5_000 + i, "the of and thintion ing ereding that with for this " * 3, "en") for i in range(20)]
    rows += [(6_000 + i, "der die das und nicht mit sich ein steinsch enerach den " * 3, "de") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = lg.fit(docs)
    assert len(model.languages) == 1_302 and model.weights.shape[0] == 1_302 and model.block_bytes() < lg.BLOCK_BYTES
    own = spark.createDataFrame([(1, "that ereding the of thintion", False), (2, "nicht die steinsch und das", False)],
                                "doc_id long, text string, held_out boolean")
    assert {r.doc_id: r.lang_pred for r in lg.label(own, model).collect()} == {1: "en", 2: "de"}


def test_learned_counts_against_a_plain_count(spark):
    """Shares of hashed n-grams from all words of a language, one by one."""
    docs = spark.createDataFrame([(1, "Ab abc. ÉA", "x"), (2, "b abc", "x"), (3, None, "x"), (4, "", "z"), (5, "q", None), (6, "éa 12 q", "y")],
                                 "doc_id long, text string, lang string").repartition(3)
    model = lg.fit(docs)
    assert model.languages == ["x", "y", "z"]
    words = {"x": ["ab", "abc", "éa", "b", "abc"], "y": ["éa", "q"], "z": []}
    for row, name in zip(model.weights, model.languages, strict=True):
        counts = np.full(1 << lg.TABLE_BITS, 0.5)
        for word in words[name]:
            raw = b"_" + word.encode() + b"_"
            for size in lg.ORDERS:
                for i in range(len(raw) - size + 1):
                    value = int.from_bytes(raw[i:i + size], "little") + (size << 56)
                    mixed = lg.tx.mix(np.array([value], np.uint64))
                    counts[int(mixed[0] >> np.uint64(64 - lg.TABLE_BITS))] += 1
        assert np.allclose(row, np.log(counts / counts.sum()) / len(lg.ORDERS), atol=1e-6)


def test_scores_against_a_plain_sum(spark, model):
    """Each word's score is the sum of its n-grams' weights, held to the cap below the best candidate."""
    words = lg.Words(lg.tx.Hasher(), __import__("pyarrow").array(["the enerach привет the", "là"]))
    got = lg.word_scores(words, model)
    for k, at in enumerate(words.sample):
        raw = b"_" + words.data[words.first[at]:words.last[at]].tobytes() + b"_"
        values = np.array([int.from_bytes(raw[i:i + n], "little") + (n << 56) for n in lg.ORDERS for i in range(len(raw) - n + 1)], np.uint64)
        sums = model.weights[:, (lg.tx.mix(values) >> np.uint64(64 - lg.TABLE_BITS)).astype(int)].sum(axis=1)
        allowed = model.scripts[words.scripts()[k]]
        want = np.where(allowed, np.maximum(sums - sums[allowed].max(), -lg.WORD_CAP), -2 * lg.WORD_CAP)
        assert np.allclose(got[k], want, atol=1e-4)
