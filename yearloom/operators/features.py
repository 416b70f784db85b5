"""Autoregressive features: positional for training, by calendar for serving."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yearloom.operators.encode import Vocabulary, encode
from yearloom.spec import (
    ENGINEERED, IMPORTS, LAGS, PANEL, ROLLING, SUPPLY, PanelSpec,
)


def _by_time(spec: PanelSpec):
    """A core panel has one row per key and year, so a partition of this window
    is at most as long as the list of years."""
    return Window.partitionBy(*spec.keys).orderBy(spec.time)


def rolling_mean(core: DataFrame, spec: PanelSpec = PANEL, width: int = 3) -> DataFrame:
    """Mean of up to ``width`` earlier rows; NULL on the first row only."""
    window = _by_time(spec).rowsBetween(-width, -1)
    return core.withColumn(ROLLING, F.avg(IMPORTS).over(window))


def lag_features(core: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    """Values k rows back (not k years: a series may have holes)."""
    window = _by_time(spec)
    return core.withColumns({
        name: F.lag(column, k).over(window) for name, (column, k) in LAGS.items()
    })


def engineered(core: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    """All seven engineered columns; the windows share one exchange and sort."""
    frame = rolling_mean(lag_features(core, spec), spec)
    return frame.select(*core.columns, *ENGINEERED)


def feature_panel(
    core: DataFrame, areas: Vocabulary, items: Vocabulary, spec: PanelSpec = PANEL
) -> DataFrame:
    """Features with codes, warm-up rows of each series dropped."""
    frame = engineered(core, spec).dropna(subset=ENGINEERED)
    return with_codes(frame, areas, items, spec).select(
        *core.columns, *ENGINEERED, "Area_enc", "Item_enc"
    )


def with_codes(
    frame: DataFrame, areas: Vocabulary, items: Vocabulary, spec: PanelSpec = PANEL
) -> DataFrame:
    area, item = spec.keys
    return encode(encode(frame, areas, area, "Area_enc"), items, item, "Item_enc")


def calendar_lag(column: str, years: int, spec: PanelSpec = PANEL) -> Column:
    """The value exactly ``years`` earlier or NULL, on a window already sorted."""
    window = _by_time(spec).rangeBetween(-years, -years)
    return F.max(column).over(window)


def calendar_panel(core: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    """Serving-time features of every core row: calendar lags, 0.0 where absent."""
    latest = Window.partitionBy(*spec.keys).orderBy(spec.time).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    lags = core.withColumns({
        **{
            name: F.coalesce(calendar_lag(column, k, spec), F.lit(0.0))
            for name, (column, k) in LAGS.items() if column != SUPPLY
        },
        "FoodSupply_Lag1": F.coalesce(
            calendar_lag(SUPPLY, 1, spec), F.last(SUPPLY).over(latest), F.lit(0.0)
        ),
    })
    return lags.withColumn(
        ROLLING, (F.col("Import_Lag1") + F.col("Import_Lag2") + F.col("Import_Lag3")) / 3
    ).select(*core.columns, *ENGINEERED)
