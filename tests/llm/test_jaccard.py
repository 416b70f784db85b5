import random
from collections import Counter

import numpy as np
import pytest
from cases import components, documents, words

from yearloom.llm import jaccard as jc


def grams(text, size=5):
    own = words(text)
    return frozenset(tuple(own[i:i + size]) for i in range(max(1, len(own) - size + 1))) if own else frozenset()


def brute(rows, threshold=0.8):
    """{row: (class, links)} from all pairs."""
    sets = [grams(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i)
             if sets[i] and sets[j] and min(len(sets[i]), len(sets[j])) >= threshold * max(len(sets[i]), len(sets[j]))
             and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= threshold]
    degree = Counter(x for pair in links for x in pair)
    top = components(range(len(rows)), links)
    least = {}
    for i, c in top.items():
        least[c] = min(least.get(c, rows[i][0]), rows[i][0])
    return sorted((rows[i][0], least[top[i]], degree[i]) for i in range(len(rows)))


def got(df):
    return sorted((r.doc_id, r.class_id, r.n_links) for r in df.collect())


def test_agrees_with_all_pairs(spark):
    docs = documents(spark)
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert got(jc.similar(docs)) == want
    assert any(n for _, _, n in want)
    left = jc.one_per_class(docs)
    assert left.schema == docs.schema
    assert sorted(r.doc_id for r in left.collect()) == sorted(d for d, c, _ in want if d == c)


@pytest.fixture(scope="module")
def group():
    """A large group of near copies with copies of its own, beside unrelated texts."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(90):
        own = list(base)
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    return rows + [(100 + i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(40))) for i in range(20)]


def test_large_group_is_compared_in_tiles(spark, group, monkeypatch):
    monkeypatch.setattr(jc, "TILE", 8)
    docs = spark.createDataFrame(group, "doc_id long, text string")
    assert got(jc.similar(docs)) == brute(group)


def test_threshold_is_met_exactly():
    """Ten 5-grams against eight of them: 0.8 is linked, seven of ten is not."""
    sets = [np.arange(n, dtype=np.uint64) for n in (10, 8, 7)]
    u, v = jc.linked(sets[:1], sets[1:], np.ones((1, 2), bool), 0.8)
    assert (u.tolist(), v.tolist()) == ([0], [0])
    u, v = jc.linked(sets[:1], sets[1:], np.array([[False, True]]), 0.8)
    assert len(u) == len(v) == 0


def test_odd_rows(spark):
    rows = [(1, None, 1), (2, "", 1), (3, "a b", 1), (4, "A b!", 1), (5, "x y z u v w", 2), (5, "x y z u v w", 2),
            (6, "x y z u v w q", 3), (7, "...", 1), (8, "b a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_links int")
    assert got(jc.similar(docs)) == [(1, 1, 0), (2, 2, 0), (3, 3, 1), (4, 3, 1), (5, 5, 1), (5, 5, 1), (6, 6, 0), (7, 7, 0), (8, 8, 0)]
    assert sorted(r.doc_id for r in jc.one_per_class(docs).collect()) == [1, 2, 3, 5, 6, 7, 8]
    assert jc.similar(docs.limit(0)).collect() == [] and jc.one_per_class(docs.limit(0)).collect() == []


def test_rows_of_one_id_with_different_texts(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "g h i j k l"), (2, "g h i j k l")], "doc_id long, text string")
    assert got(jc.similar(docs)) == [(1, 1, 0), (1, 1, 1), (2, 1, 1)]


def test_rows_without_id_link_and_take_the_class(spark):
    t, u = "a b c d e f", "g h i j k l"
    docs = spark.createDataFrame([(None, t), (3, t), (None, u), (None, u), (None, None)], "doc_id long, text string")
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in jc.similar(docs).collect()), key=str) == [
        (3, 3, 1), (None, 3, 1), (None, None, 0), (None, None, 1), (None, None, 1)]


def test_one_of_each_class_stays(spark):
    t, u, w = "a b c d e f", "g h i j k l", "m n o p q r"
    rows = [(3, t, 1), (3, u, 2), (1, u, 3), (None, t, 4), (5, w, 5), (5, w, 6), (5, None, 7), (5, None, 8), (None, "", 9), (6, "", 10), (2, w + " z", 11)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component int")
    left = [(r.doc_id, r.text) for r in jc.one_per_class(docs).collect()]
    assert sorted(left, key=str) == sorted([(3, t), (1, u), (5, w), (5, None), (None, ""), (6, ""), (2, w + " z")], key=str)
    assert jc.one_per_class(docs).columns == docs.columns


def test_one_of_each_class_stays_beside_columns_of_any_name(spark):
    """Columns may have the names used inside."""
    t = "a b c d e f"
    rows = [(i, t if i % 10 == 0 else f"own{i} " + " ".join(f"w{i}x{k}" for k in range(8)), i, -i, i % 3, "x") for i in range(200)]
    docs = spark.createDataFrame(rows + rows[5:7], "doc_id int, text string, _key int, _DOC_ID int, gone int, text_key string")
    left = jc.one_per_class(docs)
    assert left.schema == docs.schema
    assert sorted(map(tuple, left.collect())) == [r for r in rows if r[0] % 10 or r[0] == 0]


def test_a_chain_of_unlike_texts_is_not_compared_all_with_all(spark, monkeypatch, tmp_path):
    """Each text shares half of its words with the next: chance bands tie long chains, but only neighbours meet."""
    n, step = 700, 30
    stream = [f"c{i}" for i in range((n + 2) * step)]
    rows = [(i, " ".join(stream[i * step:(i + 2) * step])) for i in range(n)]
    rows += [(10_000 + i, " ".join(stream[i * step:(i + 2) * step]) + " end") for i in range(0, n, 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    pairs = spark.sparkContext.accumulator(0)
    compare = jc.linked

    def counted(first, second, met, threshold):
        pairs.add(int(met.sum()))
        return compare(first, second, met, threshold)

    monkeypatch.setattr(jc, "linked", counted)
    found = jc.similar(docs).collect()
    assert sum(r.n_links for r in found) == 2 * 14
    assert pairs.value < 3 * n  # all pairs would be 255,000


def test_cells_of_many_homes_miss_no_pair(spark, monkeypatch):
    monkeypatch.setattr(jc, "TILE", 3)
    rng = random.Random(9)
    rows = []
    for g in range(12):  # groups that overlap by a common half
        base = [f"h{i}" for i in range(40)] + [f"g{g // 2}-{i}" for i in range(80)]
        for k in range(10):
            own = list(base)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            rows.append((g * 100 + k, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(jc.similar(docs)) == brute(rows)


def test_banding_reaches_its_recall():
    n_bands, rows = jc.choose_bands()
    assert n_bands * rows <= jc.MOST_HASHES
    assert 1 - (1 - jc.THRESHOLD ** rows) ** n_bands >= jc.RECALL
    with pytest.raises(ValueError):
        jc.choose_bands(0.1, 0.999999, 5)


def test_minhash_meets_as_often_as_sets_overlap():
    rng = np.random.default_rng(2)
    common, hits, trials = 160, 0, 300
    for _ in range(trials):
        values = rng.integers(0, 2**63, common + 40, dtype=np.uint64)
        a, b = values[:common + 20], np.concatenate([values[:common], values[common + 20:]])
        signs = jc.bands(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 20, 1)
        hits += int((signs[0] == signs[1]).sum())
    assert abs(hits / (20 * trials) - common / (common + 40)) < 0.02


def test_overlaps_in_parts(monkeypatch):
    monkeypatch.setattr(jc, "COLUMNS", 7)
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 40)).astype(np.uint64) for _ in range(9)]
    want = [[len(np.intersect1d(a, b)) for b in sets[4:]] for a in sets[:4]]
    assert jc.overlaps(sets[:4], sets[4:]).tolist() == want
