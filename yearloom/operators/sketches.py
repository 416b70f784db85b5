"""Mergeable profiles: one small row per area, from which any set of areas is profiled without its rows.

Distinct items are HyperLogLog sketches, values KLL quantile sketches.  The exact profiles
(`profile`) read all rows; these read a few kilobytes an area, can be stored beside the panel
and take in new parts by merging.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.spec import IMPORTS, PANEL, RATIO, PanelSpec

#: Sizes of the sketches.
HLL_BITS, KLL_SIZE = 14, 400
#: What estimates may be off: distinct counts as a share, quantiles in rank; each some four standard errors.
DISTINCT_ERROR, RANK_ERROR = 0.035, 0.02

VALUES = (IMPORTS, RATIO)


def area_sketches(core: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    """One row per area: rows, first and last year, sketches of its items and values; one aggregate."""
    area, item = spec.keys
    return core.groupBy(area).agg(
        F.count("*").alias("row_count"), F.min(spec.time).alias("year_min"), F.max(spec.time).alias("year_max"),
        F.hll_sketch_agg(item, F.lit(HLL_BITS)).alias("items"),
        *[F.kll_sketch_agg_double(c, F.lit(KLL_SIZE)).alias(c) for c in VALUES])


def write_sketches(sketches: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Stores sketches; ``append`` adds those of a new part of the panel."""
    sketches.write.mode(mode).parquet(path)


def merged(sketches: DataFrame, *by: str) -> DataFrame:
    """The sketches of all areas together, or of each group of ``by``; areas may occur several times."""
    return sketches.groupBy(*by).agg(
        F.sum("row_count").alias("row_count"), F.min("year_min").alias("year_min"), F.max("year_max").alias("year_max"),
        F.hll_union_agg("items").alias("items"), *[F.kll_merge_agg_double(c).alias(c) for c in VALUES])


def distinct_items(sketches: DataFrame) -> DataFrame:
    """The sketches' rows with ``n_items``, the estimated number of different items."""
    return sketches.withColumn("n_items", F.hll_sketch_estimate("items"))


def quantiles(sketches: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """Estimated quantiles, long: the other columns, measure, probability, value."""
    others = [c for c in sketches.columns if c not in ("items", *VALUES)]
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    rows = F.array(*[
        F.struct(F.lit(c).alias("measure"), F.arrays_zip(
            wanted.alias("probability"), F.kll_sketch_get_quantile_double(c, wanted).alias("value")).alias("at"))
        for c in VALUES
    ])
    found = sketches.select(*others, F.inline(rows))
    return found.select(*others, "measure", F.explode("at").alias("at")).select(*others, "measure", "at.probability", "at.value")
