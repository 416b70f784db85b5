import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from cases import NONSPACE, crc, documents, words

from yearloom.llm import ngram_counts as nc
from yearloom.llm import word_model as wm


class Brute:
    """The model's formulas over Python counters."""

    def __init__(self, texts):
        lists = [words(t, NONSPACE) + ["</s>"] for t in texts]
        self.count = Counter(w for ws in lists for w in ws)
        self.total, self.size = sum(self.count.values()), len(self.count)
        self.pairs = Counter(p for ws in lists for p in zip(["<s>"] + ws, ws))
        self.before = Counter(w for _, w in self.pairs)
        self.cuts = self.discounts(self.pairs)
        self.word_cuts = self.discounts(self.before)
        self.seen = defaultdict(lambda: [0, 0, 0])
        self.tokens = Counter()
        for (v, _), n in self.pairs.items():
            self.seen[v][min(n, 3) - 1] += 1
        for (v, _), n in self.pairs.items():
            self.tokens[v] += n

    @staticmethod
    def discounts(counts):
        return nc.discounts([sum(n == k for n in counts.values()) for k in (1, 2, 3, 4)])

    def word(self, w):
        n = sum(self.before.values())
        if not n:
            return 1 / (self.size + 1)
        of = [sum(min(x, 3) == k for x in self.before.values()) for k in (1, 2, 3)]
        spread = sum(d * m for d, m in zip(self.word_cuts, of, strict=True)) / n
        own = self.before[w]
        return max(own - [0, *self.word_cuts][min(own, 3)], 0) / n + spread / (self.size + 1)

    def pair(self, v, w):
        if not self.tokens[v]:
            return self.word(w)
        n = self.pairs[v, w]
        rest = sum(d * m for d, m in zip(self.cuts, self.seen[v], strict=True)) / self.tokens[v]
        return max(n - [0, *self.cuts][min(n, 3)], 0) / self.tokens[v] + rest * self.word(w)


def agree(got, brute, text):
    ws = words(text, NONSPACE) + ["</s>"]
    base = sum(math.log10((brute.count[w] + 0.5) / (brute.total + 0.5 * (brute.size + 1))) for w in ws)
    score = sum(math.log10(brute.pair(v, w)) for v, w in zip(["<s>"] + ws, ws))
    assert (got.n_tokens, got.n_known, got.train_tokens) == (len(ws), sum(w in brute.count for w in ws), brute.total)
    assert math.isclose(got.base_score, base, rel_tol=1e-9, abs_tol=1e-9)
    assert math.isclose(got.score, score, rel_tol=1e-9, abs_tol=1e-9)


def test_scores_agree_with_the_formulas(spark):
    docs = documents(spark)
    rows = {r.doc_id: r.text for r in docs.collect()}
    held = {d for d in rows if crc(str(d)) % 5 == 1}
    brute = Brute(t for d, t in rows.items() if d not in held)
    brute.word = {w: Brute.word(brute, w) for w in [*brute.count, "?"]}
    unknown = brute.word["?"]
    lookup = brute.word
    brute.word = lambda w: lookup.get(w, unknown)
    got = {r.doc_id: r for r in wm.fit_and_score(docs).collect()}
    assert set(got) == set(rows)
    for d, text in rows.items():
        assert got[d].held_out == (d in held)
        agree(got[d], brute, text)
    ahead = sum(got[d].score - got[d].base_score for d in held)
    assert ahead > 0


def test_probabilities_after_a_word_sum_to_one(spark):
    train = spark.createDataFrame([("a b a b c a a",), ("b a c",), ("the a the b the a",)], "text string")
    model = wm.fit(train)
    following = ["a", "b", "c", "the", "", "unknown"]
    for before in ("a", "the", "c", "nowhere"):
        docs = spark.createDataFrame([(i, f"{before} {w}".strip(), False) for i, w in enumerate(following)], "doc_id long, text string, held_out boolean")
        one = spark.createDataFrame([(0, before, False)], "doc_id long, text string, held_out boolean")
        scores = {r.doc_id: r.score for r in wm.score(docs, model).collect()}
        brute = Brute(r.text for r in train.collect())
        assert math.isclose(sum(brute.pair(before, w) for w in [*brute.count, "unknown"]), 1.0)
        for i, w in enumerate(following):
            chain = ["<s>", before, *([w] if w else []), "</s>"]
            want = sum(math.log10(brute.pair(v, x)) for v, x in zip(chain, chain[1:]))
            assert math.isclose(scores[i], want, rel_tol=1e-9)
        assert wm.score(one, model).count() == 1


def test_odd_rows(spark):
    rows = [(1, None, 1), (2, "", 2), (None, "a b", 3), (3, "a b a b", 4), (3, "a b a b", 4), (4, "A\tB\x0bx  x", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    brute = Brute(t for d, t, _ in rows if crc("" if d is None else str(d)) % 5 != 1)
    got = wm.fit_and_score(docs).collect()
    assert len(got) == 6
    for r in got:
        agree(r, brute, next(t for d, t, _ in rows if d == r.doc_id))
    assert wm.fit_and_score(docs.limit(0)).collect() == []


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "a b", True)], "doc_id long, text string, held_out boolean")
    got = wm.score(docs, wm.fit(docs.select("text").limit(0))).first()
    assert (got.n_tokens, got.n_known, got.train_tokens, got.base_score, got.score) == (3, 0, 0, 0.0, 0.0)


def test_counts_beyond_a_byte_and_many_shards(spark, monkeypatch):
    monkeypatch.setattr(nc, "shards_for", lambda total: 7)
    texts = ["x y " * 400, "x z", "y x"]
    docs = spark.createDataFrame([(i, t, False) for i, t in enumerate(texts)], "doc_id long, text string, held_out boolean")
    got = {r.doc_id: r for r in wm.score(docs, wm.fit(docs)).collect()}
    for i, t in enumerate(texts):
        agree(got[i], Brute(texts), t)


def test_short_keys_of_pairs_and_many_word_shards(spark, monkeypatch):
    """Keys with hardly any bits for the word before, many shards of words, and arrays that are closed again."""
    monkeypatch.setattr(wm, "KEY_BITS", 12)
    monkeypatch.setattr(wm, "SHARD_WORDS", 5)
    monkeypatch.setattr(nc, "shards_for", lambda total: 30)
    monkeypatch.setattr(wm, "MOST_OPEN", 2)
    rng = np.random.default_rng(1)
    texts = [" ".join(f"w{k}" for k in (rng.zipf(1.4, 40) % 90)) for _ in range(30)]
    docs = spark.createDataFrame([(i, t, i % 3 == 0) for i, t in enumerate([*texts, "w1 never seen w2", ""])], "doc_id long, text string, held_out boolean")
    model = wm.fit(docs.where("not held_out"))
    assert model.word_shards > 8 and model.pair_shards > 30 and 1 << model.before_bits < model.words
    brute = Brute(r.text for r in docs.where("not held_out").collect())
    got = {r.doc_id: r for r in wm.score(docs, model).collect()}
    for r in docs.collect():
        agree(got[r.doc_id], brute, r.text)
    scorer = wm.Scorer(model)
    scorer.texts(pa.array(texts))
    assert len(scorer.vocabulary.open) <= 2 and len(scorer.table.open) <= 2


def test_pair_keys_are_told_apart():
    """Of any two pairs in one shard the keys differ, and they name their words, whatever the number of words."""
    rng = np.random.default_rng(2)
    for words in (1, 50, 3_000, 1 << 33, 1 << 45):
        n = min(words, 3_000)
        counts = rng.integers(1, 9, n)
        first = words - n  # the last words of a vocabulary; those before them have one token each
        earlier = first + np.cumsum(counts) - counts
        model = wm.Model("", 10, 1, words, int(first + counts.sum())).sized()
        b = rng.integers(0, n, 20_000)
        w = rng.integers(0, words, 20_000)
        shard, keys = model.pair_keys(first + b, counts[b], earlier[b], w)
        assert len({*zip(shard.tolist(), keys.tolist())}) == len({*zip(b.tolist(), w.tolist())})
        for s in np.unique(shard)[:50].tolist():
            own = shard == s
            before, word = model.words_of(keys[own], int(first + b[own].min()))
            assert (before == first + b[own]).all() and (word == w[own]).all()


def test_blobs_round_trip():
    rng = np.random.default_rng(0)
    keys, counts = nc.tally(rng.integers(0, 2**63, 500, dtype=np.uint64) // np.uint64(2**40), rng.integers(1, 9, 500))
    shard = (keys >> np.uint64(21)).astype(np.int64)
    found = list(nc.merged(iter([nc.to_blobs(keys, counts, shard), nc.to_blobs(keys, counts, shard)])))
    assert np.concatenate([k for _, k, _ in found]).tolist() == keys.tolist()
    assert np.concatenate([c for _, _, c in found]).tolist() == (2 * counts).tolist()


