import numpy as np
import pytest
from cases import components as brute_components

from yearloom.llm import components as cp
from yearloom.llm import vectors as vx


def brute(rows, threshold=0.95):
    good = [(i, np.array(v, float)) for i, v in rows if v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    unit = {i: (v / np.abs(v).max()) / np.linalg.norm(v / np.abs(v).max()) for i, v in good}
    links = [(a, b) for a in unit for b in unit if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold]
    top = brute_components([i for i, _ in rows], links)
    return sorted((i, sum(i in pair for pair in links), top[i], top[i] == i) for i, _ in rows)


def clustered(seed, n, size, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, size))
    return [(int(i), (centres[rng.integers(6)] + spread * rng.normal(size=size)).tolist() if rng.random() < 0.5 else rng.normal(size=size).tolist())
            for i in rng.permutation(n) * 3]


@pytest.mark.parametrize("n, size, spread, tile", [(300, 16, 0.2, 32), (400, 6, 0.25, 50), (150, 3, 0.3, 1_000)])
def test_agrees_with_all_pairs(spark, monkeypatch, n, size, spread, tile):
    monkeypatch.setattr(vx, "TILE", tile)
    rows = clustered(n, n, size, spread)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = sorted(tuple(r) for r in vx.near_duplicates(df).collect())
    assert got == brute(rows) and any(r[1] for r in got)


def test_table(spark):
    from cases import SMALL

    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    got = sorted(tuple(r) for r in vx.near_duplicates(df, 0.5).collect())
    assert got == brute([(r.vec_id, r.embedding) for r in df.collect()], 0.5)


def test_pairs_are_left_early_but_none_is_lost():
    rng = np.random.default_rng(7)
    for size in (1, 2, 9, 40):
        a, b = (vx.units(rng.normal(size=(60, size))) for _ in range(2))
        b[:20] = vx.units(a[:20] + 0.05 * rng.normal(size=(20, size)))
        for threshold in (-0.5, 0.3, 0.95, 0.999):
            got = set(zip(*(x.tolist() for x in vx.near_pairs(a, b, threshold)), strict=True))
            products = a @ b.T
            want = set(zip(*(x.tolist() for x in np.nonzero(products >= threshold)), strict=True))
            assert all(abs(products[p] - threshold) < 1e-12 for p in got ^ want)


def test_odd_rows(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0], 5), (2, [1.0, 0.0], 5), (3, [0.0, 0.0], 5), (4, None, 5), (5, [nan, 1.0], 5), (6, [None, 1.0], 5), (7, [], 5),
            (8, [1.0, 0.0, 0.0], 5), (9, [1.0, 0.01], 6), (9, [1.0, 0.01], 6), (None, [1.0, 0.0], 7), (10, [1e300, 0.0], 1), (11, [1e-300, 0.0], 1),
            (12, [float("inf"), 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links int")
    got = sorted((tuple(r) for r in vx.near_duplicates(df).collect()), key=str)
    linked = {1, 2, 9, 10, 11}
    want = [(i, 4 if i in linked else 0, 1 if i in linked else i, i not in linked - {1}) for i in range(1, 13)] + [(None, 0, None, True)]
    assert got == sorted(want, key=str)
    assert vx.near_duplicates(df.limit(0)).collect() == []
    assert vx.near_duplicates(df.where("vec_id = 4")).collect() == [(4, 0, 4, True)]


def test_different_vectors_of_one_id_are_linked_each(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0]), (5, [0.0, 1.0]), (6, [-1.0, 0.0]), (1, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in vx.near_duplicates(df).collect()) == [
        (1, 0, 1, True), (1, 1, 1, True), (1, 1, 1, True), (3, 1, 1, False), (5, 1, 1, False), (6, 0, 6, True)]


def test_tiles_out_of_reach_are_not_compared(spark, monkeypatch):
    monkeypatch.setattr(vx, "TILE", 20)
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(400, 4)))] + [(1000 + i, v.tolist()) for i, v in enumerate(rng.normal(size=(30, 2)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in vx.near_duplicates(df, 0.99).collect()) == brute(rows, 0.99)
    tiles = vx.Tiles.__new__(vx.Tiles)
    tiles.size, tiles.low, tiles.high = np.array([2, 2, 4, 4, 4]), np.array([0.0, 0.9, 0.0, 0.2, 0.9]), np.array([0.1, 1.0, 0.3, 0.8, 1.0])
    assert [tiles.reached(i, 0.1) for i in range(5)] == [1, 2, 4, 5, 5]


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = np.random.default_rng(seed)
    path = [(i, i + 1) for i in range(40)]
    pairs = path + [tuple(x) for x in rng.integers(50, 400, (200, 2)).tolist()] + [(900, 900 + i) for i in range(1, 30)] + [(7, 7)]
    df = spark.createDataFrame([(int(a), int(b)) for a, b in pairs], "a long, b long")
    want = brute_components({x for p in pairs for x in p}, pairs)
    got = {r.node: r.component for r in cp.components(df).collect()}
    assert got == {n: c for n, c in want.items() if n != c}
    assert cp.components(df.limit(0)).collect() == []


def test_local_roots():
    assert cp.local_roots(6, np.array([4, 3, 1]), np.array([3, 2, 5])).tolist() == [0, 1, 2, 2, 2, 1]
