"""The core panel: both measures present, positive supply, capped ratio."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.functions.columns import clip_upper, ratio_pct
from yearloom.spec import IMPORTS, PANEL, RATIO, RATIO_CAP, SUPPLY, PanelSpec


def core_panel(measures: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    ratio = ratio_pct(F.col(IMPORTS), F.col(SUPPLY))
    return (
        measures.dropna(how="any", subset=[IMPORTS, SUPPLY])
        .where(F.col(SUPPLY) > 0)
        .select(
            *spec.keys, spec.time, IMPORTS, SUPPLY,
            clip_upper(ratio, F.lit(RATIO_CAP)).alias(RATIO),
        )
    )
