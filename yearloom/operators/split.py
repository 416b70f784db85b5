"""Pooled random split of rows, exact in size, the same on every run."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearloom.functions.order_stats import GATHERED, order_statistics
from yearloom.spec import PANEL, SPLIT_SEED, TEST_FRACTION, PanelSpec


def row_draw(seed: int = SPLIT_SEED, spec: PanelSpec = PANEL) -> Column:
    """A 60-bit draw from the row's key: independent of partitioning and order.
    Each field is written with its length, so no two keys share a text."""
    parts = [F.concat(F.length(F.col(k).cast("string")).cast("string"), F.lit(":"), F.col(k).cast("string")) for k in (*spec.keys, spec.time)]
    text = F.concat_ws("|", F.lit(str(seed)), *parts)
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def assign_split(
    features: DataFrame, test_fraction: float = TEST_FRACTION, seed: int = SPLIT_SEED,
    spec: PanelSpec = PANEL, gathered: int = GATHERED, total: int | None = None,
) -> DataFrame:
    """Append ``split``: the ceil(fraction * n) smallest draws are the test rows; n is
    counted unless ``total`` says it.

    The threshold is an exact order statistic of the draws, so no sort and no
    limit gathers the test rows in one place.
    """
    draws = features.select(row_draw(seed, spec).alias("draw"))
    total = draws.count() if total is None else total
    if total == 0:
        return features.withColumn("split", F.lit("train"))
    size = math.ceil(test_fraction * total)
    bound = order_statistics(draws, [("draw", size - 1)], {"draw": total}, gathered)[0]
    return features.withColumn(
        "split", F.when(row_draw(seed, spec) <= bound, "test").otherwise("train")
    )


def split_counts(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("split").agg(F.count("*").alias("row_count"))
