"""Column names, fixed values and parameters shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass, replace

# --- fixed values: names and numbers that results must agree on -------------
IMPORTS = "Import_Quantity"
SUPPLY = "Food_Supply"
RATIO = "Dependency_Pct"

ELEMENTS = ("Import Quantity", "Food supply quantity (kg/capita/yr)")
RATIO_CAP = 200.0
R2_CAP = 0.89

LAGS = {
    "Import_Lag1": (IMPORTS, 1),
    "Import_Lag2": (IMPORTS, 2),
    "Import_Lag3": (IMPORTS, 3),
    "Dep_Lag1": (RATIO, 1),
    "Dep_Lag2": (RATIO, 2),
    "FoodSupply_Lag1": (SUPPLY, 1),
}
ROLLING = "Import_RollingMean3"
ENGINEERED = [
    "Import_Lag1", "Import_Lag2", "Import_Lag3",
    "Dep_Lag1", "Dep_Lag2",
    "Import_RollingMean3", "FoodSupply_Lag1",
]
FEATURES = ["Area_enc", "Item_enc", "Year", *ENGINEERED]

RF_PARAMS = {"n_estimators": 80, "max_depth": 8, "min_samples_leaf": 20, "random_state": 42}
XGB_PARAMS = {
    "n_estimators": 80, "max_depth": 5, "learning_rate": 0.05,
    "subsample": 0.7, "colsample_bytree": 0.7, "random_state": 42,
}
RIDGE_PARAMS = {"alpha": 1.0}

TEST_FRACTION = 0.2
SPLIT_SEED = 42
PREDICTOR_YEARS = list(range(2014, 2019))
DASHBOARD_YEARS = list(range(2014, 2017))
# -----------------------------------------------------------------------------

# Name under which scans number the source rows.
ORDINAL = "src_row"


@dataclass(frozen=True)
class PanelSpec:
    """Names of the panel's parts; the defaults are the food-balance names.

    ``ordinal`` numbers source rows.  It is needed only where a series may occur
    in several source rows; ``None`` states that (series, time) is unique, and a
    repeated one is an error.
    """

    keys: tuple[str, ...] = ("Area", "Item")
    kind: str = "Element"
    time: str = "Year"
    value: str = "Value"
    ordinal: str | None = None

    def numbered(self, columns: list[str]) -> PanelSpec:
        """This spec with the scan's row numbers as ordinal, if it names none and they are there."""
        if self.ordinal is None and ORDINAL in columns:
            return replace(self, ordinal=ORDINAL)
        return self

    @property
    def series(self) -> list[str]:
        return [*self.keys, self.kind]

    @property
    def core(self) -> list[str]:
        """Columns of the core panel."""
        return [*self.keys, self.time, IMPORTS, SUPPLY, RATIO]

    @property
    def features(self) -> list[str]:
        """The model's features in their fixed order, the time under this panel's name."""
        return [self.time if c == "Year" else c for c in FEATURES]

    @property
    def ordering(self) -> list[str]:
        return [self.time] if self.ordinal is None else [self.time, self.ordinal]


PANEL = PanelSpec()
