"""Profiles of the panel: counts, exact quantiles, histograms, histories."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from yearloom.functions.columns import clip_upper, round_to
from yearloom.functions.order_stats import GATHERED, exact_quantiles
from yearloom.spec import ENGINEERED, FEATURES, IMPORTS, PANEL, RATIO, PanelSpec

INFO_SCHEMA = (
    "total_rows long, training_rows long, train_rows long, test_rows long, n_countries long, n_items long, "
    "year_min int, year_max int, n_features long, lag_rows_dropped long")


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each named stage."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("stage"), "row_count", F.lit(len(df.columns)).alias("column_count")
        )
        for name, df in stages.items()
    ]
    return reduce(DataFrame.unionByName, counts)


class Watched:
    """Row counts of stages, taken while other work passes them: no job of their own.

    A stage that is recomputed after a lost executor may count rows twice before a shuffle;
    watch what is written (the last stage of a job counts each task once).
    """

    def __init__(self):
        self.seen: dict[str, tuple[Observation, int]] = {}

    def watch(self, name: str, df: DataFrame, **more: Column) -> DataFrame:
        """The same rows; once they have been computed, `values` knows their number and ``more`` aggregates."""
        observation = Observation(f"{name}-{uuid.uuid4().hex}")
        self.seen[name] = (observation, len(df.columns))
        return df.observe(observation, F.count(F.lit(1)).alias("row_count"), *[c.alias(n) for n, c in more.items()])

    def values(self, name: str) -> dict:
        return self.seen[name][0].get

    def table(self, spark: SparkSession) -> DataFrame:
        """As `stage_counts`, in the order the stages were watched."""
        rows = [(name, self.values(name)["row_count"], columns) for name, (_, columns) in self.seen.items()]
        return spark.createDataFrame(rows, "stage string, row_count long, column_count int")


def observed_info(spark: SparkSession, core: dict, features: dict, areas: dict, items: dict) -> DataFrame:
    """`dataset_info` from what was seen while the core panel, the split features and the codes were written."""
    row = (core["row_count"], features["row_count"], features["train_rows"], features["row_count"] - features["train_rows"],
           areas["row_count"], items["row_count"], core["year_min"], core["year_max"], len(FEATURES),
           core["row_count"] - features["row_count"])
    return spark.createDataFrame([row], INFO_SCHEMA)


def dataset_info(core: DataFrame, training: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    """One row on the core panel and on the split feature panel (column ``split``)."""
    area, item = spec.keys
    pairs = core.groupBy(area, item).agg(
        F.count("*").alias("n"), F.min(spec.time).alias("first"), F.max(spec.time).alias("last"))
    before = pairs.agg(  # distinct counts over one row per series, not over the panel
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count_distinct(area).alias("n_countries"),
        F.count_distinct(item).alias("n_items"),
        F.min("first").alias("year_min"),
        F.max("last").alias("year_max"),
    )
    after = training.agg(
        F.struct(
            F.count("*").alias("training_rows"),
            F.count_if(F.col("split") == "train").alias("train_rows"),
            F.count_if(F.col("split") == "test").alias("test_rows"),
        ).alias("s")
    ).scalar()
    return before.withColumn("_s", after).select(
        "total_rows", "_s.*", "n_countries", "n_items", "year_min", "year_max",
        F.lit(len(FEATURES)).cast("long").alias("n_features"),
        (F.col("total_rows") - F.col("_s.training_rows")).alias("lag_rows_dropped"),
    )


def measure_stats(core: DataFrame, gathered: int = GATHERED) -> DataFrame:
    """Mean, exact median and maximum of imports and of the ratio."""
    columns = [IMPORTS, RATIO]
    medians = exact_quantiles(core, {c: [0.5] for c in columns}, gathered)
    stats = core.agg(*[
        f(c).alias(f"{name}_{c}") for c in columns for name, f in (("mean", F.avg), ("max", F.max))
    ])
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("measure"),
            round_to(F.col(f"mean_{c}"), 4).alias("mean"),
            round_to(F.lit(medians[c][0]).cast("double"), 4).alias("median"),
            round_to(F.col(f"max_{c}"), 4).alias("max"),
        )
        for c in columns
    ])
    return stats.select(F.inline(rows))


def feature_non_null(frame: DataFrame, columns: list[str] = ENGINEERED) -> DataFrame:
    """Non-missing rows per engineered column, from one pass."""
    counts = frame.agg(*[F.count(c).alias(c) for c in columns])
    return counts.unpivot([], columns, "feature", "non_null")


def lag_drop_counts(frame: DataFrame, columns: list[str] = ENGINEERED) -> DataFrame:
    """Rows of the engineered frame before and after the warm-up drop."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return frame.agg(
        F.count("*").alias("rows_before"), F.count_if(complete).alias("rows_after")
    ).withColumn("rows_dropped", F.col("rows_before") - F.col("rows_after"))


def code_ranges(features: DataFrame) -> DataFrame:
    """Largest code still present after the warm-up drop."""
    return features.agg(
        F.max("Area_enc").alias("max_area_code"), F.max("Item_enc").alias("max_item_code")
    )


def upper_quantile(df: DataFrame, column: str, probability: float, gathered: int = GATHERED):
    return exact_quantiles(df, {column: [probability]}, gathered)[column][0]


def histogram(
    df: DataFrame, column: str, bins: int = 50, upper: float | None = None
) -> DataFrame:
    """Equal-width counts over [min, max], last bin closed, empty bins left out.

    ``upper`` first clips the values.  A constant column gives one bin.  The
    bounds are a scalar subquery; the counts combine on the map side.
    """
    x = F.col(column) if upper is None else clip_upper(F.col(column), F.lit(upper))
    values = df.select(x.alias("x")).dropna()
    bounds = values.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi")).alias("b"))
    counts = (
        values.withColumn("b", bounds.scalar())
        .withColumn("w", (F.col("b.hi") - F.col("b.lo")) / bins)
        .select(
            "b", "w",
            F.when(F.col("w") == 0, F.lit(0))
            .otherwise(F.least(F.floor(F.try_divide(F.col("x") - F.col("b.lo"), "w")), F.lit(bins - 1)))
            .cast("int").alias("bin"),
        )
        .groupBy("bin")
        .agg(F.count("*").alias("row_count"), F.any_value("b").alias("b"), F.any_value("w").alias("w"))
    )
    return counts.select(
        "bin",
        (F.col("b.lo") + F.col("bin") * F.col("w")).alias("lo"),
        F.when(F.col("bin") == bins - 1, F.col("b.hi"))
        .otherwise(F.col("b.lo") + (F.col("bin") + 1) * F.col("w")).alias("hi"),
        "row_count",
    )


def winsor_histogram(
    core: DataFrame, column: str = IMPORTS, probability: float = 0.95, bins: int = 50
) -> DataFrame:
    return histogram(core, column, bins, upper_quantile(core, column, probability))


def labels(core: DataFrame, column: str) -> DataFrame:
    return core.select(column).distinct().orderBy(column)


def history_tail(core: DataFrame, rows: int = 10, spec: PanelSpec = PANEL) -> DataFrame:
    """The latest rows of every series, values at 2 digits."""
    latest = Window.partitionBy(*spec.keys).orderBy(F.desc(spec.time))
    return (
        core.withColumn("_r", F.row_number().over(latest))
        .where(F.col("_r") <= rows)
        .select(
            *spec.keys, spec.time,
            round_to(F.col(IMPORTS), 2).alias(IMPORTS), round_to(F.col(RATIO), 2).alias(RATIO),
        )
    )
