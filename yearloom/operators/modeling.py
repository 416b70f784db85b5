"""Fitting and scoring the three regressors on both targets."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from yearloom.functions.columns import round_to
from yearloom.operators import linear, trees
from yearloom.operators.split import row_draw
from yearloom.spec import (
    FEATURES, IMPORTS, PANEL, RATIO, RF_PARAMS, RIDGE_PARAMS, XGB_PARAMS, PanelSpec,
)

TARGETS = {"import": IMPORTS, "dep": RATIO}
ALGORITHMS = ["rf", "xgb", "ridge"]
ALGORITHM_NAMES = {"rf": "RandomForest", "xgb": "XGBoost", "ridge": "Ridge Regression"}
TREE_KINDS = {"rf": "forest", "xgb": "boosted"}
PARAMS = {"rf": RF_PARAMS, "xgb": XGB_PARAMS, "ridge": RIDGE_PARAMS}

Model = linear.Linear | trees.Trees


@dataclass(frozen=True)
class Fitted:
    algo: str
    target: str
    model: Model
    seconds: float

    @property
    def key(self) -> str:
        return f"{self.algo}_{self.target}"


def key_draw(train: DataFrame, spec: PanelSpec = PANEL) -> Column:
    """A draw from each row's key, or from all its values where the key is not there."""
    if {*spec.keys, spec.time} <= set(train.columns):
        return row_draw(spec=spec)
    return F.xxhash64(*sorted(train.columns)).bitwiseAND(F.lit((1 << 60) - 1))


def fit_algorithm(
    train: DataFrame, algo: str, targets: Sequence[str] = tuple(TARGETS), params: dict | None = None, spec: PanelSpec = PANEL,
    prepared: trees.Prepared | None = None, **growth: int,
) -> list[Fitted]:
    """One algorithm on the targets, fitted together; the seconds are shared out among them.

    ``prepared`` are the rows in bins, where a caller fits several tree models on them.
    """
    settings = params or PARAMS[algo]
    labels = [TARGETS[t] for t in targets]
    started = time.time()
    if algo == "ridge":
        models = linear.ridge(train, spec.features, labels, settings["alpha"])
    elif algo in TREE_KINDS:
        rows = prepared or prepare(train, targets, spec)
        if algo == "rf":
            models = trees.forest(
                rows, FEATURES, labels, trees=settings["n_estimators"], depth=settings["max_depth"],
                least_rows=settings["min_samples_leaf"], seed=settings["random_state"], **growth)
        else:
            models = trees.boost(
                rows, FEATURES, labels, rounds=settings["n_estimators"], depth=settings["max_depth"],
                rate=settings["learning_rate"], subsample=settings["subsample"], part=settings["colsample_bytree"],
                seed=settings["random_state"], **growth)
    else:
        raise ValueError(f"unknown algorithm {algo!r}")
    seconds = (time.time() - started) / len(targets)
    return [Fitted(algo, t, m, seconds) for t, m in zip(targets, models, strict=True)]


def prepare(train: DataFrame, targets: Sequence[str] = tuple(TARGETS), spec: PanelSpec = PANEL) -> trees.Prepared:
    return trees.prepare(train, spec.features, [TARGETS[t] for t in targets], key_draw(train, spec))


def fit(train: DataFrame, algo: str, target: str, params: dict | None = None, spec: PanelSpec = PANEL, **growth: int) -> Fitted:
    return fit_algorithm(train, algo, [target], params, spec, **growth)[0]


def fit_all(
    train: DataFrame, algorithms: Sequence[str] = ALGORITHMS, params: dict[str, dict] = PARAMS,
    parallelism: int = 2, spec: PanelSpec = PANEL,
) -> list[Fitted]:
    """Every algorithm on both targets, ``parallelism`` at a time: boosting is a long
    chain of short jobs, so another fit runs beside it."""
    prepared = prepare(train, spec=spec) if set(algorithms) & set(TREE_KINDS) else None
    work = inheritable_thread_target(train.sparkSession)(
        lambda algo: fit_algorithm(train, algo, params=params.get(algo), spec=spec, prepared=prepared)
    )
    with ThreadPool(parallelism) as pool:
        found = pool.map(work, algorithms, chunksize=1)
    return [f for part in found for f in part]


def predict(rows: DataFrame, fitted: list[Fitted], spec: PanelSpec = PANEL) -> DataFrame:
    """All models over the rows in one pass, one column ``p_<key>`` each."""
    return rows.withColumns({f"p_{f.key}": f.model.column(spec.features) for f in fitted})


def predictions_long(
    rows: DataFrame, fitted: list[Fitted], spec: PanelSpec = PANEL
) -> DataFrame:
    """Key, split, model, target, y, p: one row per input row and model."""
    scores = F.array(*[
        F.struct(
            F.lit(f.key).alias("model"), F.lit(f.target).alias("target"),
            F.col(TARGETS[f.target]).alias("y"), F.col(f"p_{f.key}").alias("p"),
        )
        for f in fitted
    ])
    return predict(rows, fitted, spec).select(*spec.keys, spec.time, "split", F.inline(scores))


def ranked_shares(sizes: DataFrame) -> DataFrame:
    """Importances of any models from (model, position, feature, size): the shares of
    the absolute sizes at 4 digits, ranked; equal shares keep the order of the
    features.  A model whose sizes are all 0 has shares of 0."""
    model = Window.partitionBy("model")
    total = F.sum(F.abs("size")).over(model)
    share = round_to(F.abs("size") / F.when(total == 0, 1.0).otherwise(total), 4)
    rank = F.row_number().over(model.orderBy(F.desc("importance"), "position"))
    return sizes.select("model", "position", "feature", share.alias("importance")).select(
        "model", "feature", "importance", rank.alias("importance_rank"))


def importances(spark: SparkSession, fitted: list[Fitted]) -> DataFrame:
    """Importance per model and feature: of trees by the gains of their splits, of linear models
    by their coefficients; one row per feature of each model, whatever the data."""
    rows = [
        (f.key, i, name, float(v)) for f in fitted
        for i, (name, v) in enumerate(zip(
            FEATURES, f.model.coefficients if f.algo == "ridge" else f.model.sizes(), strict=True))
    ]
    return ranked_shares(spark.createDataFrame(rows, "model string, position int, feature string, size double"))


def slopes(train: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    """(model, position, feature, size): the slope of each target on each feature alone,
    under the model names ``slope_<target>``; both targets in one pass."""
    pairs = [(t, y, i, c) for t, y in TARGETS.items() for i, c in enumerate(spec.features)]
    sums = train.agg(*[
        F.try_divide(F.covar_pop(F.col(c).cast("double"), F.col(y).cast("double")), F.var_pop(F.col(c).cast("double"))).alias(f"s{k}")
        for k, (_, y, _, c) in enumerate(pairs)
    ])
    return sums.select(F.inline(F.array(*[
        F.struct(F.lit(f"slope_{t}").alias("model"), F.lit(i).alias("position"), F.lit(FEATURES[i]).alias("feature"),
                 F.coalesce(f"s{k}", F.lit(0.0)).alias("size"))
        for k, (t, _, i, _) in enumerate(pairs)
    ])))


def model_table(spark: SparkSession, fitted: list[Fitted]) -> DataFrame:
    """Model key, algorithm, target, order and training seconds."""
    rows = [
        (f.key, ALGORITHM_NAMES[f.algo], f.target, i, round(f.seconds, 2))
        for i, f in enumerate(fitted)
    ]
    return spark.createDataFrame(
        rows, "model string, algorithm string, target string, position int, train_time_sec double"
    )


_COEFFICIENTS = "model string, position int, feature string, value double"


def save_models(fitted: list[Fitted], folder: str) -> None:
    """Tree models as one node table, linear ones as one table of coefficients (position -1: the intercept)."""
    spark = SparkSession.active()
    nodes = [f.model.table(spark).select(F.lit(f.key).alias("model"), "*") for f in fitted if f.algo in TREE_KINDS]
    if nodes:
        reduce(DataFrame.unionByName, nodes).coalesce(1).sortWithinPartitions("model", "tree", "node").write.mode(
            "overwrite").parquet(f"{folder}/nodes")
    weights = [(f.key, i - 1, name, value) for f in fitted if f.algo == "ridge"
               for i, (name, value) in enumerate([(None, f.model.intercept), *zip(FEATURES, f.model.coefficients, strict=True)])]
    spark.createDataFrame(weights, _COEFFICIENTS).coalesce(1).write.mode("overwrite").parquet(f"{folder}/coefficients")
    keys = [(i, f.algo, f.target) for i, f in enumerate(fitted)]
    spark.createDataFrame(keys, "position int, algo string, target string").coalesce(1).write.mode("overwrite").parquet(f"{folder}/keys")


def load_models(folder: str, algorithms: Sequence[str] = ALGORITHMS) -> list[Fitted]:
    """The stored models of these algorithms, in the order they were stored."""
    spark = SparkSession.active()
    found = []
    for _, algo, target in sorted(spark.read.parquet(f"{folder}/keys").collect()):
        if algo not in algorithms:
            continue
        own = F.col("model") == f"{algo}_{target}"
        if algo == "ridge":
            values = [r.value for r in spark.read.parquet(f"{folder}/coefficients").where(own).orderBy("position").collect()]
            model = linear.Linear(values[0], tuple(values[1:]))
        else:
            model = trees.from_table(spark.read.parquet(f"{folder}/nodes").where(own), TREE_KINDS[algo], FEATURES)
        found.append(Fitted(algo, target, model, 0.0))
    return found
