import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from yearloom.functions.columns import (
    MISSING_TOKENS, clip_upper, missing_to_null, nan_to_null, round_to, to_number,
)
from yearloom.functions.order_stats import exact_quantiles, order_statistics


def column(spark, values, kind):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def mapped(spark, values, kind, expression):
    df = column(spark, values, kind).select("i", expression(F.col("x")).alias("y"))
    return [r["y"] for r in sorted(df.collect())]


def test_to_number_takes_plain_decimals_only(spark):
    texts = ["1", " 12 ", "1e3", "+5", "-.5", "7.", "1d", "1.5f", "1_000", "1,000", "0x10",
             "nan", "inf", "1e999", "", "abc", None]
    expected = [1.0, 12.0, 1000.0, 5.0, -0.5, 7.0] + [None] * 11
    assert mapped(spark, texts, "string", to_number) == expected


def test_missing_tokens(spark):
    texts = [*MISSING_TOKENS, "Namibia", " NA", None]
    assert mapped(spark, texts, "string", missing_to_null) == (
        [None] * len(MISSING_TOKENS) + ["Namibia", " NA", None]
    )


def test_nan_is_null(spark):
    assert mapped(spark, [1.0, float("nan"), None], "double", nan_to_null) == [1.0, None, None]


def test_round_to_agrees_with_numpy(spark):
    rng = random.Random(1)
    values = [0.125, 2.675, 1.005, -0.125, 1e17, 0.0] + [rng.uniform(-1e4, 1e4) for _ in range(500)]
    assert mapped(spark, values, "double", lambda c: round_to(c, 2)) == list(np.round(values, 2))


def test_clip_keeps_null(spark):
    assert mapped(spark, [250.0, 3.0, None], "double", lambda c: clip_upper(c, F.lit(200.0))) == [
        200.0, 3.0, None]


@pytest.mark.parametrize("hot", [0.0, 0.4, 0.9])
def test_order_statistic_by_bracketing(spark, hot):
    """Tiny bounds force many passes; a repeated value must not stall them."""
    rng = random.Random(7)
    values = [5.0 if rng.random() < hot else round(rng.gauss(0, 10), 3) for _ in range(4000)]
    df = column(spark, values, "double").repartition(5)
    ordered = sorted(values)
    ranks = [0, 1, 1999, 2000, 3998, 3999]
    found = order_statistics(df, [("x", r) for r in ranks], {"x": 4000}, gathered=20, accuracy=50)
    assert found == [ordered[r] for r in ranks]


def test_order_statistic_two_values(spark):
    df = column(spark, [1.0, 2.0] * 500 + [None], "double")
    assert order_statistics(df, [("x", 499), ("x", 500)], {"x": 1000}, gathered=10, accuracy=10) == [1.0, 2.0]
    with pytest.raises(ValueError):
        order_statistics(df, [("x", 1000)], {"x": 1000})


def test_order_statistics_take_few_jobs(spark):
    """All columns and ranks share the jobs of a pass: two a pass, one at the end."""
    df = spark.range(20_000).selectExpr("cast(hash(id) as double) x", "cast(id % 7 as double) y", "cast(-id as double) z").repartition(4)
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    totals = dict.fromkeys("xyz", 20_000)
    found = order_statistics(df, [(c, r) for c in "xyz" for r in (10, 9_999, 19_000)], totals, gathered=500, accuracy=1_000)
    assert found[3:6] == [0.0, 3.0, 6.0] and found[6:] == [-19_989.0, -10_000.0, -999.0]
    jobs = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - set(before)
    assert len(jobs) <= 9  # two aggregates of the one pass and the last, each three jobs with its shuffles


@pytest.mark.parametrize("gathered", [10, 100_000])
def test_exact_quantiles_match_numpy(spark, gathered):
    rng = random.Random(3)
    values = [rng.expovariate(0.1) for _ in range(3001)]
    probabilities = [0.0, 0.25, 0.5, 0.95, 1.0]
    found = exact_quantiles(column(spark, values, "double"), {"x": probabilities}, gathered)["x"]
    assert np.allclose(found, np.quantile(values, probabilities), rtol=1e-12)


def test_exact_quantiles_of_nothing(spark):
    assert exact_quantiles(column(spark, [None], "double"), {"x": [0.5]})["x"] == [None]
