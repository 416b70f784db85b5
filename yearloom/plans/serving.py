"""Stored panel and models to forecasts and dashboard tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from yearloom.operators import encode, features, forecast, modeling
from yearloom.sources import metrics_store, panel_store
from yearloom.spec import DASHBOARD_YEARS, PANEL, PREDICTOR_YEARS, PanelSpec


@dataclass(frozen=True)
class Loaded:
    core: DataFrame
    areas: encode.Vocabulary
    items: encode.Vocabulary
    fitted: list[modeling.Fitted]
    metrics: DataFrame


def load(spark: SparkSession, folder: str, cache: bool = False, spec: PanelSpec = PANEL) -> Loaded:
    """Everything `training.train` stored.  ``cache`` keeps the core panel in memory
    until the caller unpersists it."""
    core = panel_store.read_core(spark, f"{folder}/core", spec=spec)
    if cache:
        core = core.cache()
    return Loaded(
        core,
        encode.stored_vocabulary(spark, f"{folder}/area_codes"),
        encode.stored_vocabulary(spark, f"{folder}/item_codes"),
        modeling.load_models(f"{folder}/models"),
        metrics_store.read_metrics(spark, f"{folder}/metrics"),
    )


def coded_state(
    core: DataFrame, areas: encode.Vocabulary, items: encode.Vocabulary, years: list[int],
    requests: DataFrame | None = None, spec: PanelSpec = PANEL,
) -> DataFrame:
    """Series states with codes; an unknown label is an error, a known pair
    without history is forecast from zeros."""
    state = forecast.series_state(core, years, requests, spec)
    return features.with_codes(state, areas, items, spec)


def predict(
    loaded: Loaded, years: list[int] = PREDICTOR_YEARS, algo: str | None = None,
    requests: DataFrame | None = None, spec: PanelSpec = PANEL,
) -> DataFrame:
    """Forecast of the requested series (all when None) by one algorithm or all.

    A one-year list is a point forecast: nothing is fed back through the gap.
    """
    chosen = forecast.scorers(loaded.fitted)
    if algo is not None:
        chosen = {algo: chosen[algo]}
    state = coded_state(loaded.core, loaded.areas, loaded.items, years, requests, spec)
    return forecast.forecast(state, years, chosen, spec)


def compare(
    loaded: Loaded, years: list[int] = DASHBOARD_YEARS,
    requests: DataFrame | None = None, spec: PanelSpec = PANEL,
) -> DataFrame:
    """All algorithms side by side."""
    state = coded_state(loaded.core, loaded.areas, loaded.items, years, requests, spec)
    return forecast.forecast_compare(state, years, forecast.scorers(loaded.fitted), spec)


def trends(
    loaded: Loaded, years: list[int] = PREDICTOR_YEARS, algo: str | None = None,
    spec: PanelSpec = PANEL,
) -> DataFrame:
    return forecast.trend_series(loaded.core, predict(loaded, years, algo, spec=spec), spec)
