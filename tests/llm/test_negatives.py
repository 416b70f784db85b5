import math

import numpy as np
import pytest

from yearloom.llm import negatives as ng


def brute(rows, every=100, positives=5, negatives=5):
    """All pairs, in Python's own whole numbers; ``rows``: (vec_id, label, vector)."""
    usable = []
    for i, label, v in rows:
        if None not in (i, label, v) and all(x is not None and math.isfinite(256 * x) for x in v):
            usable.append((i, label, tuple(math.floor(256 * x) for x in v)))
    usable = list(dict.fromkeys(usable))
    found = []
    for i, label, v in usable:
        if i % every:
            continue
        scored = sorted({(-sum(a * b for a, b in zip(v, w, strict=True)), j, other == label)
                         for j, other, w in usable if len(w) == len(v)})
        same = [(j, -s) for s, j, equal in scored if equal and j != i][:positives]
        for j, p in same:
            fits = [(k, -s) for s, k, equal in scored if not equal and 80 * p <= -100 * s <= 100 * p][:negatives]
            found += [(i, j, rank, k, p, n) for rank, (k, n) in enumerate(fits, 1)]
    return sorted(found)


def mined(spark, rows, **how):
    return sorted(tuple(r) for r in ng.mine(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"), **how).collect())


def clustered(n, size, seed, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, size))
    return [(i, int(rng.integers(labels)), (centres[rng.integers(6)] + 0.3 * rng.normal(size=size)).tolist()) for i in range(n)]


@pytest.mark.parametrize("tile", [16, ng.TILE])
def test_agrees_with_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(ng, "TILE", tile)
    monkeypatch.setattr(ng, "ROWS", 4 * tile)
    rows = clustered(400, 21, 1)
    want = brute(rows, every=10)
    assert len(want) > 200
    assert mined(spark, rows, every=10) == want


def test_ties_go_by_id_and_repeats_count_once(spark):
    rows = [(100 - i, i % 2, [1.0, 0.5]) for i in range(12)] + [(100, 0, [1.0, 0.5])] * 3 + [(7, 1, [0.9, 0.6])] * 40
    assert mined(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(0, 1, [1.0, 2.0]), (1, 1, [1.0, 1.5]), (2, 2, [1.0, 1.4]), (3, 2, None), (4, None, [1.0, 1.4]), (None, 2, [1.0, 1.4]),
            (5, 2, [None, 1.0]), (6, 2, [float("nan"), 1.0]), (8, 2, [float("inf"), 1.0]), (9, 2, [1e307, 1.0]), (10, 2, [1.0]),
            (100, 1, []), (11, 1, []), (12, 2, []), (200, 3, [1.0, 1.0]), (200, 1, [1.0, 2.0]), (13, 2, [0.0, 0.0])]
    assert mined(spark, rows) == brute(rows)
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert ng.mine(frame.limit(0)).collect() == []
    assert ng.mine(frame.where("vec_id = 1")).collect() == []
    named = frame.selectExpr("*", "7 as score", "8 as anchor", "9 as rank")
    assert sorted(tuple(r) for r in ng.mine(named).collect()) == brute(rows)


def test_scores_beyond_double_precision_are_exact():
    a, b = np.array([[2.0**40, 3.0]]), np.array([[2.0**30, 5.0], [2.0**40, -1.0]])
    assert ng.scores(a, b).tolist() == [[2**63 - 1, 2**63 - 1]]
    assert ng.scores(a, np.array([[2.0**20, 5.0]])).tolist() == [[2**60 + 15]]
    assert ng.scores(a, np.array([[2.0**20, 5.0]]), one_by_one=True).tolist() == [2**60 + 15]


def test_bounds_hold_and_leave_pairs_out():
    """Segments with means far apart: most pairs end at the coarse level, none that counts is lost."""
    rng = np.random.default_rng(4)
    level = rng.integers(-40, 41, (300, 4))
    rows = np.repeat(level, 16, axis=1) + rng.integers(-2, 3, (300, 64)).astype(float)
    told = ng.summary(rows)
    exact = rows[:40] @ rows.T
    for means, deviations in ng.levels(64):
        middle, room = told[:40, means] @ told[:, means].T, told[:40, deviations] @ told[:, deviations].T
        assert (np.abs(exact - middle) <= room + 1e-6).all()
    low, high = np.quantile(exact, 0.97, axis=1), np.quantile(exact, 0.99, axis=1)
    u, v, score = ng.survivors(rows[:40], told[:40], rows, told, np.ones((40, 300), bool), low, high)
    want = (exact >= low[:, None]) & (exact <= high[:, None])
    assert sorted(zip(u, v, strict=True)) == sorted(zip(*np.nonzero(want), strict=True)) and (score == exact[u, v]).all()
    means, deviations = ng.levels(64)[0]
    middle, room = told[:40, means] @ told[:, means].T, told[:40, deviations] @ told[:, deviations].T
    left = (middle + room >= low[:, None]) & (middle - room <= high[:, None])
    assert left.mean() < 0.1
