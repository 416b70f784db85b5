import math
import random

import numpy as np
import pytest
from helpers import CORE_SCHEMA, rows

from yearloom.operators import evaluate, linear, modeling, split
from yearloom.session import scratch_path
from yearloom.spec import FEATURES

FEW = {
    "rf": dict(modeling.RF_PARAMS, n_estimators=8),
    "xgb": dict(modeling.XGB_PARAMS, n_estimators=40),
    "ridge": modeling.RIDGE_PARAMS,
}


@pytest.fixture(scope="module")
def training(spark):
    """A planted signal: imports follow their lag, the ratio its own."""
    rng = random.Random(42)
    data = []
    for k in range(1500):
        lags = [rng.uniform(0, 100) for _ in range(6)]
        data.append((
            f"a{k % 10}", f"i{k}", 2000 + k % 7, 2 * lags[0] + rng.gauss(0, 1), 1.0,
            0.5 * lags[3] + 0.1 * lags[4] + rng.gauss(0, 1),
            *lags[:3], lags[3], lags[4], sum(lags[:3]) / 3, lags[5], k % 10, k % 37,
        ))
    frame = spark.createDataFrame(data, CORE_SCHEMA + ", Import_Lag1 double, Import_Lag2 double, "
        "Import_Lag3 double, Dep_Lag1 double, Dep_Lag2 double, Import_RollingMean3 double, "
        "FoodSupply_Lag1 double, Area_enc int, Item_enc int")
    return split.assign_split(frame).persist()


def closed_form(train, label, alpha):
    data = train.select(*FEATURES, label).toPandas().to_numpy(float)
    x, y = data[:, :-1], data[:, -1]
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    return w, y.mean() - x.mean(0) @ w


@pytest.mark.parametrize("alpha", [1.0, 5000.0])
def test_ridge_is_the_closed_form(training, alpha):
    train = training.where("split = 'train'")
    fitted = modeling.fit(train, "ridge", "import", {"alpha": alpha})
    w, b = closed_form(train, "Import_Quantity", alpha)
    assert np.allclose(fitted.model.coefficients, w, rtol=1e-5, atol=1e-6)
    assert math.isclose(fitted.model.intercept, b, rel_tol=1e-5)


def test_ridge_fits_both_targets_from_two_aggregates(spark, training):
    train = training.where("split = 'train'")
    both = modeling.fit_algorithm(train, "ridge")
    for f in both:
        assert np.allclose(f.model.coefficients, modeling.fit(train, "ridge", f.target).model.coefficients, rtol=1e-7, atol=1e-12)
    rest = linear.residuals(train, {f.key: (modeling.TARGETS[f.target], f.model) for f in both}, FEATURES, 1.0).collect()
    assert len(rest) == 20 and all(abs(r.rest) < 1e-9 for r in rest)


def test_ridge_keeps_its_digits_far_from_zero(spark):
    """Features with large means and small spreads, one of them a copy of another."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3)) + [1e7, -5e6, 3.0]
    y = 2 * x[:, 0] - x[:, 1] + rng.normal(size=400)
    frame = spark.createDataFrame([(*map(float, r), float(r[2]), float(v)) for r, v in zip(x, y)], "a double, b double, c double, d double, y double")
    model = linear.ridge(frame, ["a", "b", "c", "d"], ["y"], 1.0)[0]
    wide = np.column_stack([x, x[:, 2]])
    centred = wide - wide.mean(0)
    want = np.linalg.solve(centred.T @ centred + np.eye(4), centred.T @ (y - y.mean()))
    assert np.allclose(model.coefficients, want, rtol=1e-6)
    free = linear.ridge(frame, ["a", "b", "c", "d"], ["y"], 0.0)[0]
    assert free.coefficients[:2] == pytest.approx((2, -1), abs=0.2)


def test_ridge_leaves_out_rows_with_gaps_and_needs_some(spark, training):
    train = training.where("split = 'train'")
    gaps = train.unionByName(train.limit(5).selectExpr(*[
        "cast(null as double) as Import_Quantity" if c == "Import_Quantity" else c for c in train.columns]))
    assert modeling.fit(gaps, "ridge", "import").model.coefficients == pytest.approx(
        modeling.fit(train, "ridge", "import").model.coefficients, rel=1e-9)
    with pytest.raises(ValueError, match="no rows"):
        modeling.fit(train.limit(0), "ridge", "import")
    with pytest.raises(ValueError, match="no rows"):
        modeling.fit(train.limit(0), "rf", "import")


def test_ridge_of_a_constant_label_is_its_value(training):
    model = modeling.fit(training.selectExpr(*FEATURES, "7.0D as Import_Quantity"), "ridge", "import").model
    assert model.intercept == pytest.approx(7.0) and np.allclose(model.coefficients, 0)


def test_all_models_fit_score_save_and_load(spark, training):
    train = training.where("split = 'train'")
    fitted = modeling.fit_all(train, params=FEW)
    assert [f.key for f in fitted] == [
        "rf_import", "rf_dep", "xgb_import", "xgb_dep", "ridge_import", "ridge_dep"]
    long = modeling.predictions_long(training, fitted)
    assert long.count() == 6 * training.count()
    metrics = {r["model"]: r for r in evaluate.evaluate(long).collect()}
    assert all(m["r2_test"] > 0.5 for m in metrics.values())
    assert metrics["ridge_import"]["r2_test"] > 0.99

    per_model = {}
    for r in modeling.importances(spark, fitted).collect():
        per_model.setdefault(r["model"], []).append(r)
    for listed in per_model.values():
        assert sum(r["importance"] for r in listed) == pytest.approx(1, abs=1e-3)
        listed.sort(key=lambda r: r["importance_rank"])
        keys = [(-r["importance"], FEATURES.index(r["feature"])) for r in listed]
        assert keys == sorted(keys)

    folder = scratch_path(spark, "models")
    modeling.save_models(fitted, folder)
    again = modeling.load_models(folder)
    assert rows(modeling.predictions_long(training, again)) == rows(long)


def test_fits_repeat_under_the_same_seed(spark, training):
    train = training.where("split = 'train'")
    for algo in ("rf", "xgb"):
        a, b = (modeling.fit(train, algo, "dep", FEW[algo]) for _ in range(2))
        assert rows(modeling.importances(spark, [a])) == rows(modeling.importances(spark, [b]))


def test_codes_above_the_bins_are_plain_numbers(spark):
    data = [(i, float(i), i % 5) for i in range(2000)]
    frame = spark.createDataFrame(data, "Item_enc int, Import_Quantity double, z int").selectExpr(
        "*", *[f"cast(z as double) as {c}" for c in FEATURES if c != "Item_enc"])
    sizes = modeling.fit(frame, "rf", "import", FEW["rf"]).model.sizes()
    assert sizes[FEATURES.index("Item_enc")] / sum(sizes) > 0.9


def predictions(spark, entries):
    return spark.createDataFrame(entries, "model string, target string, split string, y double, p double")


def test_metrics_golden(spark):
    got = evaluate.evaluate(predictions(spark, [
        ("m", "t", "train", 1.0, 1.0), ("m", "t", "train", 2.0, 2.0), ("m", "t", "train", 3.0, 2.0),
        ("m", "t", "test", 0.0, 1.0), ("m", "t", "test", 2.0, 1.0), ("m", "t", "test", 4.0, 4.0),
    ])).first()
    assert (got["r2_train"], got["r2_test"]) == (0.5, 0.75)
    assert (got["mae"], got["rmse"], got["mape"]) == (0.6667, 0.8165, 25.0)


def test_metric_edges(spark):
    got = {r["model"]: r for r in evaluate.evaluate(predictions(spark, [
        ("same", "t", "test", 5.0, 5.0), ("same", "t", "test", 5.0, 5.0),
        ("flat", "t", "test", 5.0, 4.0), ("flat", "t", "test", 5.0, 5.0),
        ("one", "t", "test", 5.0, 4.0), ("zero", "t", "test", 0.0, 4.0), ("zero", "t", "test", 1e-9, 4.0),
    ])).collect()}
    assert (got["same"]["r2_test"], got["flat"]["r2_test"], got["one"]["r2_test"]) == (1.0, 0.0, None)
    assert got["zero"]["mape"] is None


def table(spark):
    """The published scores, with a tie added on the second target."""
    return spark.createDataFrame([
        ("rf_import", "import", 0, 0.957065, 3.0, 692.40, 9.0),
        ("rf_dep", "dep", 1, 0.882435, 2.0, 31.97, 8.0),
        ("xgb_import", "import", 2, 0.930589, 4.0, 880.38, 7.0),
        ("xgb_dep", "dep", 3, 0.882435, 2.0, 31.98, 6.0),
        ("ridge_import", "import", 4, 0.992663, 5.0, 286.23, None),
        ("ridge_dep", "dep", 5, 0.877552, 6.0, 32.62, 6.0),
    ], "model string, target string, position int, r2_test double, mae double, rmse double, mape double")


def test_best_takes_the_later_of_equals(spark):
    assert rows(evaluate.best_model(table(spark)).select("target", "model")) == [
        ("dep", "xgb_dep"), ("import", "ridge_import")]


def test_flags_mark_all_ties(spark):
    got = {r["model"]: r for r in evaluate.best_flags(table(spark)).collect()}
    assert [m for m in got if got[m]["best_r2_test"]] == ["ridge_import"]
    assert sorted(m for m in got if got[m]["best_mae"]) == ["rf_dep", "xgb_dep"]
    assert sorted(m for m in got if got[m]["best_mape"]) == ["ridge_dep", "xgb_dep"]


def test_cap_and_frames(spark):
    assert [r[0] for r in rows(evaluate.over_cap(table(spark)))] == ["rf_import", "ridge_import", "xgb_import"]
    assert evaluate.for_target(table(spark), "dep").count() == 3
    assert evaluate.error_frame(table(spark)).columns == ["model", "target", "mae", "rmse"]


def test_shares_of_equal_and_zero_sizes(spark):
    df = spark.createDataFrame(
        [("a", i, f"f{i}", s) for i, s in enumerate([-1.0, 2.0, 1.0, 0.0])] + [("z", i, f"f{i}", 0.0) for i in range(2)],
        "model string, position int, feature string, size double")
    got = rows(modeling.ranked_shares(df))
    assert got == [("a", "f0", 0.25, 2), ("a", "f1", 0.5, 1), ("a", "f2", 0.25, 3), ("a", "f3", 0.0, 4), ("z", "f0", 0.0, 1), ("z", "f1", 0.0, 2)]
