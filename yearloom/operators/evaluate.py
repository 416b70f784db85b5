"""Scores of predictions and comparisons between models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yearloom.functions.columns import round_to
from yearloom.spec import R2_CAP

METRICS = ["r2_train", "r2_test", "mae", "rmse", "mape"]


def r2(y: Column, p: Column) -> Column:
    """Coefficient of determination; constant y gives 1 or 0, one row gives NULL."""
    squares = F.sum((y - p) * (y - p))
    spread, n = F.var_pop(y), F.count(y)
    return (
        F.when(n < 2, F.lit(None).cast("double"))
        .when(spread == 0, F.when(squares == 0, 1.0).otherwise(0.0))
        .otherwise(1 - F.try_divide(squares, spread * n))
    )


def evaluate(predictions: DataFrame) -> DataFrame:
    """One row of metrics per (model, target).

    ``predictions`` is long: model, target, split, y, p.  All models are scored in
    one aggregation with map-side combining, whatever their number.
    """
    y, p = F.col("y"), F.col("p")
    test = F.col("split") == "test"
    train_y = F.when(F.col("split") == "train", y)
    test_y = F.when(test, y)
    error = F.when(test, F.abs(y - p))
    share = F.when(test & (F.abs(y) > 1e-8), F.abs(F.try_divide(y - p, y)))
    return predictions.groupBy("model", "target").agg(
        round_to(r2(train_y, p), 6).alias("r2_train"),
        round_to(r2(test_y, p), 6).alias("r2_test"),
        round_to(F.avg(error), 4).alias("mae"),
        round_to(F.sqrt(F.avg(error * error)), 4).alias("rmse"),
        round_to(F.avg(share) * 100, 2).alias("mape"),
    )


def best_model(metrics: DataFrame) -> DataFrame:
    """Per target the model with the highest test score; of equals the last one
    in ``position`` order."""
    best = Window.partitionBy("target").orderBy(F.desc_nulls_last("r2_test"), F.desc("position"))
    return (
        metrics.withColumn("_r", F.row_number().over(best))
        .where("_r = 1").select("target", "model", "r2_test")
    )


def best_flags(metrics: DataFrame) -> DataFrame:
    """Flags for the best value of each column over all models, ties included."""
    best = metrics.agg(F.struct(
        F.max("r2_test").alias("r2_test"),
        *[F.min(c).alias(c) for c in ("mae", "rmse", "mape")],
    ).alias("b")).scalar()
    flagged = metrics.withColumn("_b", best)
    return flagged.withColumns({
        f"best_{c}": F.col(c).eqNullSafe(F.col(f"_b.{c}")) & F.col(c).isNotNull()
        for c in ("r2_test", "mae", "rmse", "mape")
    }).drop("_b")


def over_cap(metrics: DataFrame, cap: float = R2_CAP) -> DataFrame:
    """Models whose test score looks too good."""
    return metrics.where(F.col("r2_test") > cap).select("model", "target", "r2_test")


def for_target(metrics: DataFrame, target: str) -> DataFrame:
    return metrics.where(F.col("target") == target)


def score_frame(metrics: DataFrame) -> DataFrame:
    return metrics.select("model", "target", "r2_train", "r2_test")


def error_frame(metrics: DataFrame) -> DataFrame:
    return metrics.select("model", "target", "mae", "rmse")


def naive_predictions(training: DataFrame) -> DataFrame:
    """Three rules that need no fitting, long form: last value, value two rows
    back (straight-line step for imports), recent mean (mean of two for the
    ratio).  They score the evaluation path on its own."""
    rules = [
        ("last", "import", "Import_Quantity", F.col("Import_Lag1")),
        ("last", "dep", "Dependency_Pct", F.col("Dep_Lag1")),
        ("step", "import", "Import_Quantity", 2 * F.col("Import_Lag1") - F.col("Import_Lag2")),
        ("step", "dep", "Dependency_Pct", 2 * F.col("Dep_Lag1") - F.col("Dep_Lag2")),
        ("mean", "import", "Import_Quantity", F.col("Import_RollingMean3")),
        ("mean", "dep", "Dependency_Pct", (F.col("Dep_Lag1") + F.col("Dep_Lag2")) / 2),
    ]
    rows = F.array(*[
        F.struct(
            F.lit(f"{rule}_{target}").alias("model"), F.lit(target).alias("target"),
            F.lit(i).alias("position"), F.col(y).alias("y"), p.alias("p"),
        )
        for i, (rule, target, y, p) in enumerate(rules)
    ])
    return training.select("split", F.inline(rows))
