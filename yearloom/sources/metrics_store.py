"""The metrics document: dataset facts, models, best models, parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearloom.spec import FEATURES, RF_PARAMS, RIDGE_PARAMS, XGB_PARAMS

PARAMS = {"rf": RF_PARAMS, "xgb": XGB_PARAMS, "ridge": RIDGE_PARAMS}
PARAM_NAMES = {"rf": "random_forest", "xgb": "xgboost", "ridge": "ridge"}

SCHEMA = """
dataset_info struct<
  total_rows: bigint, training_rows: bigint, train_rows: bigint, test_rows: bigint,
  n_countries: bigint, n_items: bigint, year_min: int, year_max: int,
  features: array<string>, n_features: bigint, lag_rows_dropped: bigint>,
models map<string, struct<
  r2_train: double, r2_test: double, mae: double, rmse: double, mape: double,
  feature_importance: map<string, double>, train_time_sec: double>>,
best_model map<string, string>,
hyperparameters map<string, map<string, double>>
"""

TARGET_NAMES = {"import": "import_quantity", "dep": "dependency_pct"}


def hyperparameter_rows(document: DataFrame) -> DataFrame:
    return document.select(F.explode("hyperparameters").alias("algorithm", "p")).select(
        "algorithm", F.explode("p").alias("parameter", "value")
    )


def metrics_document(
    info: DataFrame, metrics: DataFrame, importances: DataFrame, best: DataFrame,
    params: dict[str, dict] = PARAMS,
) -> DataFrame:
    """One nested row from the flat tables; each holds one row per model at most."""
    weights = importances.groupBy("model").agg(
        F.map_from_entries(F.collect_list(F.struct("feature", "importance"))).alias("feature_importance")
    )
    body = F.struct(
        "r2_train", "r2_test", "mae", "rmse", "mape", "feature_importance", "train_time_sec"
    )
    models = metrics.join(weights, "model").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("model"), body))).alias("m")
    )
    target = F.when(F.col("target") == "import", TARGET_NAMES["import"]).otherwise(TARGET_NAMES["dep"])
    winners = best.agg(F.map_from_entries(F.collect_list(F.struct(target, F.col("model")))).alias("w"))
    recorded = F.create_map(*[
        part for algo, settings in params.items()
        for part in (
            F.lit(PARAM_NAMES[algo]),
            F.create_map(*[x for n, v in settings.items() for x in (F.lit(n), F.lit(float(v)))]),
        )
    ])
    facts = F.struct(
        "total_rows", "training_rows", "train_rows", "test_rows", "n_countries", "n_items",
        "year_min", "year_max", F.array(*map(F.lit, FEATURES)).alias("features"),
        "n_features", "lag_rows_dropped",
    )
    return info.select(
        facts.alias("dataset_info"), models.scalar().alias("models"),
        winners.scalar().alias("best_model"), recorded.alias("hyperparameters"),
    )


def write_metrics(
    path: str, info: DataFrame, metrics: DataFrame, importances: DataFrame, best: DataFrame,
    params: dict[str, dict] = PARAMS,
) -> None:
    metrics_document(info, metrics, importances, best, params).write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).json(path)


def model_rows(document: DataFrame) -> DataFrame:
    """The models of a document as flat rows again."""
    return document.select(F.explode("models").alias("model", "m")).select(
        "model",
        F.when(F.col("model").endswith("_import"), "import").otherwise("dep").alias("target"),
        "m.r2_train", "m.r2_test", "m.mae", "m.rmse", "m.mape", "m.train_time_sec",
    )


def importance_rows(document: DataFrame) -> DataFrame:
    """Importances of a document, ranked per model; equal values keep the order
    of the feature list."""
    position = F.array_position(F.array(*map(F.lit, FEATURES)), F.col("feature"))
    return (
        document.select(F.explode("models").alias("model", "m"))
        .select("model", F.explode("m.feature_importance").alias("feature", "importance"))
        .orderBy("model", F.desc("importance"), position)
    )
