"""Forecasts of every requested series at once, fed back year by year.

The loop runs over the years of the horizon on the driver and only adds columns;
all series move through each step together.  History enters once, as one
aggregated row per series with the few years that lags can reach.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearloom.functions.columns import round_to
from yearloom.operators.modeling import ALGORITHMS, Fitted, Model
from yearloom.operators.profile import history_tail
from yearloom.session import cut_lineage
from yearloom.spec import FEATURES, IMPORTS, PANEL, RATIO, ROLLING, SUPPLY, PanelSpec

# Gets a frame with the feature columns, returns it with `_imp` and `_dep`.
Scorer = Callable[[DataFrame], DataFrame]

STEPS_PER_CHECKPOINT = 5


@dataclass(frozen=True)
class LinearScorer:
    """Two linear formulas over the features, evaluated as plain expressions."""

    imports: tuple[float, list[float]]
    ratio: tuple[float, list[float]]

    def __call__(self, df: DataFrame) -> DataFrame:
        def formula(part: tuple[float, list[float]]) -> Column:
            total = F.lit(part[0])
            for weight, name in zip(part[1], FEATURES, strict=True):
                total = total + F.lit(weight) * F.col(name)
            return total

        return df.withColumns({"_imp": formula(self.imports), "_dep": formula(self.ratio)})


@dataclass(frozen=True)
class ModelScorer:
    """A pair of models for the two targets, as expressions over the features."""

    imports: Model
    ratio: Model

    def __call__(self, df: DataFrame) -> DataFrame:
        return df.withColumns({"_imp": self.imports.column(FEATURES), "_dep": self.ratio.column(FEATURES)})


def scorers(fitted: list[Fitted]) -> dict[str, Scorer]:
    """One scorer per algorithm that has both targets fitted."""
    by_key = {f.key: f.model for f in fitted}
    pairs = {algo: (by_key.get(f"{algo}_import"), by_key.get(f"{algo}_dep")) for algo in ALGORITHMS}
    return {algo: ModelScorer(*pair) for algo, pair in pairs.items() if None not in pair}


def series_state(
    core: DataFrame, years: list[int], requests: DataFrame | None = None, spec: PanelSpec = PANEL
) -> DataFrame:
    """One row per series: the history values that lags of ``years`` can reach,
    the latest year and its supply.  Requested keys without history get NULLs."""
    reached = sorted({y - k for y in years for k in (1, 2, 3)})
    at = F.col(spec.time)
    state = core.groupBy(*spec.keys).agg(
        *[
            F.max(F.when(at == y, F.col(c))).alias(f"{short}_{y}")
            for y in reached for short, c in (("imp", IMPORTS), ("dep", RATIO), ("fs", SUPPLY))
        ],
        F.max(at).alias("last_year"),
        F.max_by(SUPPLY, spec.time).alias("last_supply"),
    )
    if requests is None:
        return state
    wanted = requests.select(*spec.keys).distinct()
    return wanted.join(state, list(spec.keys), "left")


class _Series:
    """Which column holds a series' value for a year: history or a prediction."""

    def __init__(self, short: str):
        self.short = short
        self.predicted: dict[int, str] = {}

    def value(self, year: int) -> Column:
        return F.col(self.predicted.get(year, f"{self.short}_{year}"))


def _supply(fs: _Series, year: int) -> Column:
    """Supply of the year before, else of the latest known year (which may be a
    later one, or one already predicted), else 0."""
    latest = F.col("last_supply")
    if fs.predicted:
        newest = max(fs.predicted)
        latest = F.when(F.col("last_year") > newest, latest).otherwise(F.col(fs.predicted[newest]))
    return F.coalesce(fs.value(year - 1), latest, F.lit(0.0))


def lag_columns(imp: _Series, dep: _Series, fs: _Series, year: int) -> dict[str, Column]:
    """Serving features of one year: calendar lags, absent ones 0.0."""
    def known(series: _Series, k: int) -> Column:
        return F.coalesce(series.value(year - k), F.lit(0.0))

    imports = [known(imp, k) for k in (1, 2, 3)]
    return {
        "Year": F.lit(year),
        "Import_Lag1": imports[0], "Import_Lag2": imports[1], "Import_Lag3": imports[2],
        "Dep_Lag1": known(dep, 1), "Dep_Lag2": known(dep, 2),
        ROLLING: (imports[0] + imports[1] + imports[2]) / 3,
        "FoodSupply_Lag1": _supply(fs, year),
    }


def calendar_lags(
    core: DataFrame, year: int, requests: DataFrame | None = None, spec: PanelSpec = PANEL
) -> DataFrame:
    """The serving features of every requested series for one year."""
    state = series_state(core, [year], requests, spec)
    columns = lag_columns(_Series("imp"), _Series("dep"), _Series("fs"), year)
    return state.select(
        *spec.keys, *[c.alias(spec.time if name == "Year" else name) for name, c in columns.items()])


def forecast_wide(
    state: DataFrame, years: list[int], by_algo: dict[str, Scorer],
    spec: PanelSpec = PANEL, steps_per_checkpoint: int = STEPS_PER_CHECKPOINT,
) -> DataFrame:
    """``state`` with codes, in; per series, algorithm and year the columns
    ``<algo>_imp_<i>`` and ``<algo>_dep_<i>`` out.  A narrow plan: no shuffle.

    Predictions are rounded to 2 digits and the rounded values become lags.  Years
    need not be contiguous: a lag that no earlier step produced comes from the
    history.  Long horizons are cut by a reliable checkpoint.
    """
    frame = state
    for algo, scorer in by_algo.items():
        imp, dep, fs = _Series("imp"), _Series("dep"), _Series("fs")
        for i, year in enumerate(years):
            scored = scorer(frame.withColumns(lag_columns(imp, dep, fs, year)))
            names = {short: f"{algo}_{short}_{i}" for short in ("imp", "dep", "fs")}
            frame = scored.withColumns({
                names["imp"]: round_to(F.col("_imp"), 2),
                names["dep"]: round_to(F.col("_dep"), 2),
                names["fs"]: F.col("FoodSupply_Lag1"),
            }).select(*frame.columns, *names.values())
            for series in (imp, dep, fs):
                series.predicted[year] = names[series.short]
            if steps_per_checkpoint and (i + 1) % steps_per_checkpoint == 0 and i + 1 < len(years):
                frame = cut_lineage(frame)
    return frame


def forecast(
    state: DataFrame, years: list[int], by_algo: dict[str, Scorer], spec: PanelSpec = PANEL
) -> DataFrame:
    """Long form: key, algo, year, imp, dep."""
    wide = forecast_wide(state, years, by_algo, spec)
    rows = F.array(*[
        F.struct(
            F.lit(algo).alias("algo"), F.lit(year).alias(spec.time),
            F.col(f"{algo}_imp_{i}").alias("imp"), F.col(f"{algo}_dep_{i}").alias("dep"),
        )
        for algo in by_algo for i, year in enumerate(years)
    ])
    return wide.select(*spec.keys, F.inline(rows))


def forecast_compare(
    state: DataFrame, years: list[int], by_algo: dict[str, Scorer], spec: PanelSpec = PANEL
) -> DataFrame:
    """Side by side: key, year, one import and one ratio column per algorithm."""
    wide = forecast_wide(state, years, by_algo, spec)
    rows = F.array(*[
        F.struct(
            F.lit(year).alias(spec.time),
            *[F.col(f"{a}_imp_{i}").alias(f"{a}_import") for a in by_algo],
            *[F.col(f"{a}_dep_{i}").alias(f"{a}_dep") for a in by_algo],
        )
        for i, year in enumerate(years)
    ])
    return wide.select(*spec.keys, F.inline(rows))


def trend_series(core: DataFrame, forecasts: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    """Recent history and forecasts as one labelled series."""
    past = history_tail(core, spec=spec).select(
        *spec.keys, spec.time, F.lit("Historical").alias("kind"),
        F.col(IMPORTS).alias("imp"), F.col(RATIO).alias("dep"),
    )
    future = forecasts.select(
        *spec.keys, spec.time, F.concat(F.col("algo"), F.lit(" forecast")).alias("kind"),
        "imp", "dep",
    )
    return past.unionByName(future)
