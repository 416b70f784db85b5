"""Raw wide table to stored panel, models and metrics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearloom.operators import encode, evaluate, features, modeling, profile, series, sketches, split
from yearloom.session import run_folder, scratch_path
from yearloom.sources import metrics_store, panel_store
from yearloom.spec import ELEMENTS, ENGINEERED, PANEL, PanelSpec


def core(wide: DataFrame, spec: PanelSpec = PANEL, elements=ELEMENTS) -> DataFrame:
    """Raw wide rows to the core panel; one exchange."""
    return series.core_rows(series.histories(wide, spec, elements), spec)


def engineered_rows(wide: DataFrame, spec: PanelSpec = PANEL, elements=ELEMENTS) -> DataFrame:
    """Raw wide rows to complete feature rows without codes; the same exchange."""
    return series.lagged_rows(series.histories(wide, spec, elements), spec)


@dataclass(frozen=True)
class Prepared:
    core: DataFrame
    areas: encode.Vocabulary
    items: encode.Vocabulary
    features: DataFrame


def prepare(core_panel: DataFrame, spec: PanelSpec = PANEL) -> Prepared:
    """Vocabularies over all core rows, then features; from a stored core panel."""
    area, item = spec.keys
    areas = encode.vocabulary(core_panel, area)
    items = encode.vocabulary(core_panel, item)
    return Prepared(core_panel, areas, items, features.feature_panel(core_panel, areas, items, spec))


def prepare_wide(wide: DataFrame, spec: PanelSpec = PANEL, elements=ELEMENTS) -> Prepared:
    """As `prepare`, straight from wide rows.  The histories (one row per key) are
    stored in the shared folder: core, vocabularies and features all start from
    them, and nothing stays in memory.  Keys left without a core row get no code;
    the condition stands above the stored rows, where it is a cheap look at one
    array."""
    spec = spec.numbered(wide.columns)
    path = scratch_path(wide.sparkSession, "histories")
    series.histories(wide, spec, elements).write.parquet(path)
    hist = wide.sparkSession.read.parquet(path).where(F.size("history") > 0)
    area, item = spec.keys
    areas = encode.vocabulary(hist, area)
    items = encode.vocabulary(hist, item)
    coded = features.with_codes(hist, areas, items, spec)
    rows = series.lagged_rows(coded, PanelSpec(
        keys=(*spec.keys, "Area_enc", "Item_enc"), kind=spec.kind, time=spec.time, value=spec.value,
    ))
    return Prepared(
        series.core_rows(hist, spec), areas, items,
        rows.select(*spec.core, *ENGINEERED, "Area_enc", "Item_enc"),
    )


def model_rows(features_df: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    """Split feature rows, persisted: every fit and the scoring read them, and the
    caller lets go of them.  Rows that are split already stay so."""
    assigned = features_df if "split" in features_df.columns else split.assign_split(features_df, spec=spec)
    return assigned.persist(StorageLevel.MEMORY_AND_DISK)


def score(rows: DataFrame, fitted: list[modeling.Fitted], spec: PanelSpec = PANEL) -> DataFrame:
    """Metrics of all models from one pass over the rows.

    The result has one row per model; it is taken once, so that no later use
    scores the rows again.
    """
    spark = rows.sparkSession
    metrics = evaluate.evaluate(modeling.predictions_long(rows, fitted, spec))
    scored = metrics.join(modeling.model_table(spark, fitted), ["model", "target"]).select(
        "model", "algorithm", "target", "position", *evaluate.METRICS, "train_time_sec"
    )
    return spark.createDataFrame(scored.collect(), scored.schema)


def fit_and_score(
    features_df: DataFrame, algorithms: list[str] = modeling.ALGORITHMS, spec: PanelSpec = PANEL,
    params: dict[str, dict] = modeling.PARAMS,
) -> tuple[list[modeling.Fitted], DataFrame]:
    """Fit every model on the training rows, then score them on all rows."""
    rows = model_rows(features_df, spec)
    fitted = modeling.fit_all(rows.where("split = 'train'"), algorithms, params, spec=spec)
    metrics = score(rows, fitted, spec)
    rows.unpersist()
    return fitted, metrics


def train(
    wide: DataFrame, folder: str, spec: PanelSpec = PANEL, elements=ELEMENTS,
    params: dict[str, dict] = modeling.PARAMS, algorithms: list[str] = modeling.ALGORITHMS,
) -> DataFrame:
    """The whole run: store the core panel, its sketches per area, vocabularies, models, metrics and
    the rows of each stage under ``folder``; returns the metrics.

    Stages are counted while they are written; scratch tables are gone at the end.
    """
    spark: SparkSession = wide.sparkSession
    spec = spec.numbered(wide.columns)
    seen = profile.Watched()
    with run_folder(spark):
        prepared = prepare_wide(seen.watch("raw", wide), spec, elements)
        panel_store.write_core(
            seen.watch("core", prepared.core, year_min=F.min(spec.time), year_max=F.max(spec.time)), f"{folder}/core", spec=spec)
        stored = panel_store.read_core(spark, f"{folder}/core", spec=spec)
        sketches.write_sketches(sketches.area_sketches(stored, spec), f"{folder}/sketches")
        for name, vocab in (("area", prepared.areas), ("item", prepared.items)):
            seen.watch(f"{name} codes", vocab.table).write.mode("overwrite").parquet(f"{folder}/{name}_codes")
        path = scratch_path(spark, "features")
        seen.watch("features", prepared.features).write.parquet(path)
        rows = spark.read.parquet(path)
        assigned = split.assign_split(rows, spec=spec, total=seen.values("features")["row_count"])
        seen.watch("split", assigned, train_rows=F.count_if(F.col("split") == "train")).write.mode("overwrite").parquet(
            f"{folder}/features")
        fitted, metrics = fit_and_score(spark.read.parquet(f"{folder}/features"), algorithms, spec=spec, params=params)
        modeling.save_models(fitted, f"{folder}/models")
        info = profile.observed_info(spark, *[seen.values(n) for n in ("core", "split", "area codes", "item codes")])
        seen.table(spark).coalesce(1).write.mode("overwrite").parquet(f"{folder}/stages")
        metrics_store.write_metrics(
            f"{folder}/metrics", info, metrics, modeling.importances(spark, fitted),
            evaluate.best_model(metrics), params,
        )
    return metrics
