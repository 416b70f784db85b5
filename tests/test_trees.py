"""Histogram trees against plain loops, under any partitioning and either way of growing."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from yearloom.operators import trees
from yearloom.session import scratch_path

FEATURES = ["a", "b", "c", "d"]


def table(spark, n=600, seed=1):
    rng = np.random.default_rng(seed)
    a, b, c = rng.normal(size=n) * 40, rng.integers(0, 9, n), np.exp(rng.normal(size=n) * 3)
    y = np.where(a > 5, 30, 0) + 3 * b + rng.normal(size=n)
    z = np.where((b > 4) & (c < 1), -50, 7) + rng.normal(size=n)
    return spark.createDataFrame(
        [(i, float(a[i]), int(b[i]), float(c[i]), 1.0, float(y[i]), float(z[i])) for i in range(n)],
        "key long, a double, b int, c double, d double, y double, z double")


def prepared(frame):
    return trees.prepare(frame, FEATURES, ["y", "z"], F.xxhash64("key").bitwiseAND(F.lit((1 << 60) - 1)))


@pytest.fixture(scope="module")
def frame(spark):
    return table(spark).persist()


@pytest.fixture(scope="module")
def rows(frame):
    return prepared(frame)


def same(left, right):
    assert all((left.nodes[c] == right.nodes[c]).all() for c in left.nodes), "other trees"


# --- bins and draws ---------------------------------------------------------------

def test_grid_values():
    """Rounded down to 13 significant bits, also below zero."""
    def down(x):
        if x == 0:
            return 0.0
        scale = 2.0 ** (trees.CUT_BITS - math.floor(math.log2(abs(x))))
        return math.floor(x * scale) / scale

    from yearloom.session import local_session
    spark = local_session()
    values = [0.0, 1.0, 1961.0, 2013.5, 8.0, 2.0**40 + 1, -3.0000001, 1e-5, 123456.789, -0.1, 5e-324, 1e300]
    got = spark.createDataFrame([(v,) for v in values], "x double").select("x", trees.coarse(F.col("x"))).collect()
    assert [r[1] for r in got] == [down(v) if abs(v) > 1e-290 else 0.0 for v in values]


def test_edges_cut_into_parts_of_like_size(spark, frame):
    edges = trees.bin_edges(frame, FEATURES, bins=16)
    assert edges[1].tolist() == list(range(1, 9)) and len(edges[3]) == 0
    a = np.sort([r.a for r in frame.collect()])
    parts = np.diff(np.searchsorted(a, [-np.inf, *edges[0], np.inf]))
    assert len(parts) == 16 and parts.min() >= 36 and parts.max() <= 40
    assert [e.tolist() for e in trees.bin_edges(frame.repartition(7), FEATURES, bins=16)] == [e.tolist() for e in edges]


def test_bins_count_the_edges_below(frame):
    edges = trees.bin_edges(frame, FEATURES)
    for r in trees.binned(frame, FEATURES, edges).collect():
        assert [b + 128 for b in r.bins] == [int(np.searchsorted(e, r[c], side="right")) for e, c in zip(edges, FEATURES, strict=True)]


def test_weights_are_poisson(spark):
    draws = spark.range(20_000).select((F.xxhash64("id").bitwiseAND(F.lit((1 << 60) - 1)) % trees.MODULUS).alias("draw"))
    weights = trees.bootstrapped(draws, 42, [0, 1]).groupBy("i", "weight").count().collect()
    for i in (0, 1):
        counts = {r.weight: r["count"] for r in weights if r.i == i}
        for k in (1, 2, 3):
            assert counts[k] == pytest.approx(20_000 * math.exp(-1) / math.factorial(k), rel=0.1)
    both = trees.bootstrapped(draws, 42, [0, 1]).groupBy("draw").agg(F.count("*").alias("n")).where("n = 2").count()
    assert both == pytest.approx(20_000 * (1 - math.exp(-1)) ** 2, rel=0.05)


# --- growing ----------------------------------------------------------------------

def test_forest_is_the_same_under_any_split_of_the_work(spark, frame, rows):
    how = dict(trees=5, depth=4, least_rows=5, seed=42)
    here = trees.forest(rows, FEATURES, ["y", "z"], **how)
    for limit in (0, 40):
        for left, right in zip(here, trees.forest(rows, FEATURES, ["y", "z"], local_rows=limit, together=3, **how), strict=True):
            same(left, right)
    again = prepared(frame.repartition(11).sortWithinPartitions("y"))
    for left, right in zip(here, trees.forest(again, FEATURES, ["y", "z"], **how), strict=True):
        same(left, right)


def test_boosting_is_the_same_under_any_split_of_the_work(spark, frame, rows):
    how = dict(rounds=4, depth=3, rate=0.3, subsample=0.7, part=0.75, seed=42)
    here = trees.boost(rows, FEATURES, ["y", "z"], **how)
    for limit in (0, 60):
        for left, right in zip(here, trees.boost(rows, FEATURES, ["y", "z"], local_rows=limit, **how), strict=True):
            same(left, right)
    again = prepared(frame.repartition(11))
    for left, right in zip(here, trees.boost(again, FEATURES, ["y", "z"], **how), strict=True):
        same(left, right)


def plain_tree(x, y, weight, edges, features, depth, penalty, least_rows, least_gain):
    """Nested (feature, threshold, smaller, larger, gain) or value, by trying every cut."""
    def score(own):
        return (y[own] * weight[own]).sum() ** 2 / (weight[own].sum() + penalty)

    def build(own, level):
        value = (y[own] * weight[own]).sum() / (weight[own].sum() + penalty)
        best = (least_gain, None)
        for f in features if level < depth else ():
            for edge in edges[f]:
                low, high = own[x[own, f] < edge], own[x[own, f] >= edge]
                if min(len(low), len(high)) >= least_rows:
                    gain = score(low) + score(high) - score(own)
                    if gain > best[0] * (1 + 1e-9):
                        best = (gain, (f, edge, low, high))
        if best[1] is None:
            return value
        f, edge, low, high = best[1]
        return f, edge, build(low, level + 1), build(high, level + 1), best[0]

    return build(np.flatnonzero(weight > 0), 0)


def nested(model, tree, node=1):
    k = np.flatnonzero((model.nodes["tree"] == tree) & (model.nodes["node"] == node))[0]
    n = model.nodes
    if n["feature"][k] < 0:
        return float(n["value"][k])
    return int(n["feature"][k]), float(n["threshold"][k]), nested(model, tree, 2 * node), nested(model, tree, 2 * node + 1), float(n["gain"][k])


def alike(left, right, rate=1.0):
    if not isinstance(left, tuple):
        assert left == pytest.approx(rate * right, abs=1e-5)
        return
    assert left[:2] == right[:2] and left[4] == pytest.approx(right[4], rel=1e-5)
    alike(left[2], right[2], rate)
    alike(left[3], right[3], rate)


def walk(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] < tree[1] else tree[3]
    return tree


def at_hand(frame, rows):
    data = frame.select(*FEATURES, "y", "key", (F.xxhash64("key").bitwiseAND(F.lit((1 << 60) - 1)) % trees.MODULUS).alias("draw")).collect()
    x = np.array([[float(r[c]) for c in FEATURES] for r in data])
    return x, np.array([r.y for r in data]), np.array([r.draw for r in data]), rows.edges


def test_boosting_against_a_plain_loop(frame, rows):
    model = trees.boost(rows, FEATURES, ["y"], rounds=3, depth=3, rate=0.3, subsample=0.7, part=0.75, seed=42)[0]
    x, y, draw, edges = at_hand(frame, rows)
    p = np.full(len(y), y.mean())
    assert nested(model, 0) == pytest.approx(y.mean())
    for tree in (1, 2, 3):
        drawn = (trees.share(draw, trees.factor("round", 42, "y", tree)) < 0.7).astype(float)
        features = trees.drawn_features(42, "y", tree, 4, 0.75)
        assert len(features) == 3 and 0.6 < drawn.mean() < 0.8
        want = plain_tree(x, y - p, drawn, edges, features, 3, 1.0, 1, 1e-6)
        alike(nested(model, tree), want, 0.3)
        p += 0.3 * np.array([walk(want, r) for r in x])


def test_forest_against_a_plain_loop(frame, rows):
    model = trees.forest(rows, FEATURES, ["y"], trees=3, depth=3, least_rows=20, seed=42)[0]
    x, y, draw, edges = at_hand(frame, rows)
    for tree in range(3):
        weight = np.searchsorted(trees.POISSON, trees.share(draw, trees.factor("tree", 42, tree)), side="right").astype(float)
        alike(nested(model, tree + 1), plain_tree(x, y, weight, edges, range(4), 3, 0.0, 20, 1e-9))
    leaves = [c for c, f in zip(model.nodes["cover"], model.nodes["feature"], strict=True) if f < 0]
    assert min(leaves) >= 20


def test_more_rounds_fit_better(frame, rows):
    def error(model):
        return frame.select(F.avg((F.col("y") - model.column(FEATURES)) ** 2)).first()[0]

    errors = [error(trees.boost(rows, FEATURES, ["y"], rounds=n, depth=3, rate=0.3, subsample=1.0, part=1.0, seed=1)[0]) for n in (1, 5, 20)]
    assert errors[0] > 2 * errors[1] > 4 * errors[2]


# --- models -----------------------------------------------------------------------

def test_conditions_walks_and_stored_nodes_agree(spark, frame, rows, monkeypatch):
    for model in (trees.forest(rows, FEATURES, ["y"], trees=7, depth=5, least_rows=3, seed=3)[0],
                  trees.boost(rows, FEATURES, ["y"], rounds=9, depth=4, rate=0.1, subsample=0.7, part=0.5, seed=3)[0]):
        path = scratch_path(spark, "nodes")
        model.table(spark).write.parquet(path)
        again = trees.from_table(spark.read.parquet(path), model.kind, FEATURES)
        same(model, again)
        odd = frame.select("key", *FEATURES).unionByName(spark.createDataFrame(
            [(-1, None, 1, 2.0, 3.0), (-2, float("nan"), None, None, None)], "key long, a double, b int, c double, d double"))
        compiled = {r.key: r.p for r in odd.select("key", model.column(FEATURES).alias("p")).collect()}
        with monkeypatch.context() as m:
            m.setattr(trees, "COMPILED_SPLITS", 0)
            frame_udf = odd.select("key", model.column(FEATURES).alias("p"))
            assert "ArrowEvalPython" in frame_udf._jdf.queryExecution().toString()
            walked = {r.key: r.p for r in frame_udf.collect()}
        missing = {k for k in compiled if k < 0}
        assert {k: v for k, v in compiled.items() if k not in missing} == {k: v for k, v in walked.items() if k not in missing}
        assert compiled[-2] == walked[-2]


def test_importance_sums_the_nodes(spark, rows):
    boosted = trees.boost(rows, FEATURES, ["y"], rounds=5, depth=3, rate=0.3, subsample=0.7, part=0.75, seed=42)[0]
    forest = trees.forest(rows, FEATURES, ["y"], trees=5, depth=3, least_rows=20, seed=42)[0]
    mean = {r.feature: r.m for r in boosted.table(spark).where("feature is not null").groupBy("feature").agg(F.avg("gain").alias("m")).collect()}
    assert boosted.sizes() == pytest.approx([mean.get(c, 0.0) for c in FEATURES])
    nodes = forest.table(spark).where("feature is not null").collect()
    of_tree = {t: sum(r.gain for r in nodes if r.tree == t) for t in {r.tree for r in nodes}}
    assert forest.sizes() == pytest.approx([sum(r.gain / of_tree[r.tree] for r in nodes if r.feature == c) for c in FEATURES])
    assert forest.sizes()[FEATURES.index("d")] == 0 and sum(forest.sizes()) == pytest.approx(5)


def test_measured_trees_have_the_gains_they_were_grown_with(frame, rows):
    model = trees.forest(rows, FEATURES, ["y"], trees=1, depth=3, least_rows=20, seed=42)[0]
    fixed = trees.written_out("forest", FEATURES, [("a", 5.0, ("b", 4.0, 1.0, 2.0), 3.0)])
    got = trees.measured(fixed, frame, "y")
    data = frame.collect()
    means = [np.mean([r.y for r in data if r.a < 5 and r.b < 4]), np.mean([r.y for r in data if r.a >= 5])]
    by_node = dict(zip(got.nodes["node"].tolist(), got.nodes["value"].tolist(), strict=True))
    assert (by_node[4], by_node[3]) == pytest.approx(means)
    assert got.nodes["cover"][got.nodes["node"] == 1] == [600]
    assert all(g > 0 for g, f in zip(got.nodes["gain"], got.nodes["feature"], strict=True) if f >= 0)
    assert model.splits > 3


def test_constant_labels_and_features_do_not_split(spark):
    frame = spark.createDataFrame([(i, 1.0, 1, 1.0, 1.0, 5.0, float(i)) for i in range(50)],
                                  "key long, a double, b int, c double, d double, y double, z double")
    rows = prepared(frame)
    for limit in (0, 1000):
        for model in trees.forest(rows, FEATURES, ["y", "z"], 2, 3, 1, 1, local_rows=limit):
            assert model.splits == 0
        model = trees.boost(rows, FEATURES, ["y"], 2, 3, 0.3, 1.0, 1.0, 1, local_rows=limit)[0]
        assert model.splits == 0 and frame.select(model.column(FEATURES)).first()[0] == pytest.approx(5.0)
