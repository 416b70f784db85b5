"""Reshape, fill, pivot, core panel: goldens, pandas, and the two paths."""

import numpy as np
import pandas as pd
import pytest
from helpers import IMPORT, SUPPLY, random_series, rows, wide
from pyspark.sql import functions as F

from yearloom.operators import features, impute, panel, reshape, series
from yearloom.sources import wide as wide_scan
from yearloom.spec import ENGINEERED, PanelSpec

REPEATED = PanelSpec(ordinal="src_row")


def fill(spark, values, years=None):
    years = years or list(range(1, len(values) + 1))
    frame = wide(spark, [("a", "i", IMPORT, values)], years)
    filled = impute.interpolate_linear(reshape.unpivot_years(frame))
    return [r["Value"] for r in filled.orderBy("Year").collect()]


def long_core(frame, spec):
    long = reshape.unpivot_years(frame, spec)
    clean = impute.clean_long(impute.interpolate_linear(long, spec), spec)
    return panel.core_panel(reshape.pivot_measures(clean, spec), spec)


def test_year_columns_skip_flags():
    assert wide_scan.year_columns(["Area", "Y1961", "Y1961F", "Unit", "Y1962"]) == ["Y1961", "Y1962"]


def test_unpivot_keeps_empty_cells_and_parses_text(spark):
    frame = spark.createDataFrame([("a", "i", IMPORT, "3", "x")], "Area string, Item string, Element string, Y1961 string, Y1962 string")
    assert rows(reshape.unpivot_years(frame)) == [
        ("a", "i", IMPORT, 1961, 3.0), ("a", "i", IMPORT, 1962, None)]


def test_filling_goldens(spark):
    n = None
    assert fill(spark, [n, 2, n, n, 5, n, -1, n]) == [2, 2, 3, 4, 5, 2, -1, -1]
    assert fill(spark, [n, n]) == [n, n]
    # by position, not by distance between years
    assert fill(spark, [1, n, 4], [1, 2, 5]) == [1, 2.5, 4]


def test_repeated_source_rows_interleave(spark):
    frame = wide(spark, [
        ("a", "i", IMPORT, [1, None, 9], 0), ("a", "i", IMPORT, [10, None, None], 1),
    ], [1, 2, 3], ordinal=True)
    filled = impute.interpolate_linear(reshape.unpivot_years(frame, REPEATED), REPEATED)
    values = [r["Value"] for r in filled.orderBy("Year", "src_row").collect()]
    assert np.allclose(values, [1, 10, 29 / 3, 28 / 3, 9, 9])
    means = reshape.pivot_measures(filled, REPEATED).orderBy("Year").collect()
    assert [r["Import_Quantity"] for r in means] == [5.5, 9.5, 9]


def test_rows_without_full_key_go(spark):
    frame = wide(spark, [("a", None, IMPORT, [1]), ("a", "i", IMPORT, [2])], [1])
    assert impute.interpolate_linear(reshape.unpivot_years(frame)).count() == 1
    both = wide(spark, [("a", None, IMPORT, [1]), ("a", "i", IMPORT, [2]), ("a", "i", SUPPLY, [2]), ("a", None, SUPPLY, [2])], [1])
    assert [r["Item"] for r in series.core_rows(series.histories(both)).collect()] == ["i"]


def test_negative_values_shape_neighbours_then_go(spark):
    frame = wide(spark, [("a", "i", IMPORT, [-2, None, 4])], [1, 2, 3])
    clean = impute.clean_long(impute.interpolate_linear(reshape.unpivot_years(frame)))
    assert [r["Value"] for r in clean.orderBy("Year").collect()] == [1, 4]


def test_filling_agrees_with_pandas(spark):
    years = list(range(1990, 2002))
    found = random_series(11, 60, years, max_repeats=3)
    frame = wide(spark, found, years, ordinal=True)
    got = impute.interpolate_linear(reshape.unpivot_years(frame, REPEATED), REPEATED).toPandas()
    flat = pd.DataFrame(
        [(a, i, e, s, y, v) for a, i, e, vs, s in found for y, v in zip(years, vs)],
        columns=["Area", "Item", "Element", "src_row", "Year", "Value"],
    ).sort_values(["Area", "Item", "Element", "Year", "src_row"])
    parts = [
        g.assign(Value=g["Value"].astype(float).interpolate(method="linear", limit_direction="both"))
        for _, g in flat.groupby(["Area", "Item", "Element"])
    ]
    want = pd.concat(parts)
    order = ["Area", "Item", "Element", "Year", "src_row"]
    merged = got.merge(want, on=order, suffixes=("", "_w"))
    assert len(merged) == len(got) == len(want)
    assert np.array_equal(merged["Value"].to_numpy(float), merged["Value_w"].to_numpy(float), equal_nan=True)


@pytest.mark.parametrize("block", [1, 4, 1 << 20])
def test_pieces_agree_with_whole_windows(spark, monkeypatch, block):
    """One series holds a third of all rows and is cut into many pieces."""
    monkeypatch.setattr(wide_scan, "ROWS_PER_BLOCK", block)
    years = list(range(2000, 2006))
    found = random_series(5, 20, years, max_repeats=2, hot=(3, 25))
    long = reshape.unpivot_years(wide(spark, found, years, ordinal=True), REPEATED)
    whole = rows(impute.interpolate_linear(long, REPEATED))
    assert rows(impute.interpolate_linear(long, REPEATED, series_limit=0)) == whole
    assert rows(impute.interpolate_linear(long, REPEATED, series_limit=30)) == whole


def test_pieces_take_a_source_position_as_ordinal(spark):
    years = [1, 2, 3]
    found = random_series(9, 6, years, max_repeats=4)
    frame = wide(spark, found, years, ordinal=True)
    placed = frame.withColumn("src_row", F.struct(
        F.lit("f").alias("file"), F.floor(F.col("src_row") / 3).alias("block"), F.col("src_row").alias("row")))
    def values(df):
        return rows(df.select("Area", "Item", "Element", "Year", "Value"))
    plain = impute.interpolate_linear(reshape.unpivot_years(frame, REPEATED), REPEATED)
    cut = impute.interpolate_linear(reshape.unpivot_years(placed, REPEATED), REPEATED, series_limit=0)
    assert values(cut) == values(plain)


def test_observed_values_stay_and_filled_lie_between(spark):
    years = list(range(1, 10))
    frame = wide(spark, random_series(2, 40, years), years)
    long = reshape.unpivot_years(frame)
    both = impute.interpolate_linear(long).join(
        long.withColumnRenamed("Value", "raw"), ["Area", "Item", "Element", "Year"])
    assert both.where("raw is not null and raw <> Value").count() == 0
    lo_hi = long.groupBy("Area", "Item", "Element").agg(F.min("Value").alias("lo"), F.max("Value").alias("hi"))
    assert both.join(lo_hi, ["Area", "Item", "Element"]).where("Value < lo or Value > hi").count() == 0


def test_core_panel_ratio_rules(spark):
    measures = spark.createDataFrame([
        ("a", "i", 1, 250.0, 100.0), ("a", "i", 2, 5.0, 0.0), ("a", "i", 3, 0.0, 7.0),
        ("a", "i", 4, None, 7.0), ("a", "i", 5, 7.0, None), ("a", "i", 6, 1.0, 4.0),
    ], "Area string, Item string, Year int, Import_Quantity double, Food_Supply double")
    assert [(r["Year"], r["Dependency_Pct"]) for r in panel.core_panel(measures).orderBy("Year").collect()] == [
        (1, 200.0), (3, 0.0), (6, 25.0)]


def test_measure_names(spark):
    df = spark.createDataFrame([("Food Supply (g)",), ("Import Quantity",), ("Stock",)], "e string")
    names = [r[0] for r in df.select(reshape.measure_name(F.col("e"))).collect()]
    assert names == ["Food_Supply", "Import_Quantity", None]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_array_path_agrees_with_long_path(spark, seed):
    years = list(range(1990, 2000))
    found = random_series(seed, 60, years, max_repeats=3)
    frame = wide(spark, found, years, ordinal=True)
    want = rows(long_core(frame, REPEATED))
    assert rows(series.core_rows(series.histories(frame, REPEATED))) == want
    one = wide(spark, random_series(seed, 60, years), years)
    assert rows(series.core_rows(series.histories(one))) == rows(long_core(one, PanelSpec()))


def test_frequent_keys_leave_the_array_path(spark):
    years = list(range(1990, 1996))
    found = random_series(4, 15, years, max_repeats=3, hot=(2, 30))
    frame = wide(spark, found, years, ordinal=True)
    want = rows(long_core(frame, REPEATED))
    for limit in (0, 5, 20, 1000):
        hist = series.histories(frame, REPEATED, rows_per_key=limit)
        assert rows(series.core_rows(hist)) == want
        assert hist.count() == hist.select("Area", "Item").distinct().count()


def test_array_lags_agree_with_windows(spark):
    years = list(range(1990, 2000))
    frame = wide(spark, random_series(8, 60, years), years)
    hist = series.histories(frame)
    core = series.core_rows(hist)
    want = features.engineered(core).dropna(subset=ENGINEERED)
    got = series.lagged_rows(hist).select(*want.columns)
    assert rows(got) == rows(want) and got.count() > 100


def test_result_is_the_same_for_any_partitioning(spark):
    years = list(range(1990, 1997))
    frame = wide(spark, random_series(6, 30, years, max_repeats=2), years, ordinal=True)
    want = rows(series.core_rows(series.histories(frame, REPEATED)))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        assert rows(series.core_rows(series.histories(frame.repartition(13), REPEATED))) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


VALUE = "Import Value"


@pytest.mark.parametrize("limit", [0, 5, 1000])
def test_elements_of_one_measure_are_filled_apart(spark, limit):
    """Filled per element, averaged per measure, on either path."""
    frame = wide(spark, [
        ("a", "i", IMPORT, [1, None, 9], 0), ("a", "i", VALUE, [100, 100, 100], 1), ("a", "i", SUPPLY, [1, 1, 1], 2)], [1, 2, 3], ordinal=True)
    hist = series.histories(frame, REPEATED, (IMPORT, VALUE, SUPPLY), rows_per_key=limit)
    assert [r["Import_Quantity"] for r in series.core_rows(hist).orderBy("Year").collect()] == [50.5, 52.5, 54.5]
    alone = series.histories(frame.drop("src_row"), PanelSpec(), (IMPORT, VALUE, SUPPLY))
    assert [r["Import_Quantity"] for r in series.core_rows(alone).orderBy("Year").collect()] == [50.5, 52.5, 54.5]


@pytest.mark.parametrize("seed", [1, 2])
def test_three_elements_agree_on_all_paths(spark, seed):
    years = list(range(1990, 1998))
    found = random_series(seed, 20, years, max_repeats=3, hot=(3, 25))
    more = [(*s[:2], VALUE, *s[3:]) for s in random_series(seed + 10, 20, years, max_repeats=2) if s[2] == IMPORT]
    frame = wide(spark, found + [(*s[:4], s[4] + 10_000) for s in more], years, ordinal=True)
    elements = (IMPORT, VALUE, SUPPLY)
    want = rows(long_core(frame, REPEATED))
    for limit in (0, 5, 1000):
        assert rows(series.core_rows(series.histories(frame, REPEATED, elements, rows_per_key=limit))) == want


def test_scan_numbers_are_the_default_ordinal(spark):
    frame = wide(spark, [
        ("a", "i", IMPORT, [1, None, 9], 0), ("a", "i", IMPORT, [10, None, None], 1), ("a", "i", SUPPLY, [1, 1, 1], 2)], [1, 2, 3], ordinal=True)
    core = series.core_rows(series.histories(frame)).orderBy("Year").collect()
    assert [r["Import_Quantity"] for r in core] == [5.5, 9.5, 9]


def test_repeated_rows_without_ordinal_are_an_error_in_the_long_path(spark):
    frame = wide(spark, [("a", "i", IMPORT, [1, None, 9]), ("a", "i", IMPORT, [10, None, None])], [1, 2, 3])
    with pytest.raises(Exception, match="name an ordinal"):
        impute.interpolate_linear(reshape.unpivot_years(frame)).collect()


def test_infinite_numbers_are_missing(spark):
    frame = wide(spark, [("a", "i", IMPORT, [1, float("inf"), 3]), ("a", "i", SUPPLY, [1, 1, 1])], [1, 2, 3])
    core = series.core_rows(series.histories(frame)).orderBy("Year").collect()
    assert [r["Import_Quantity"] for r in core] == [1, 2, 3]


def test_repeated_rows_without_ordinal_are_an_error(spark):
    frame = wide(spark, [
        ("a", "i", IMPORT, [1, 2]), ("a", "i", IMPORT, [3, 4]), ("a", "i", SUPPLY, [1, 1]),
    ], [1, 2])
    with pytest.raises(Exception, match="name an ordinal"):
        series.core_rows(series.histories(frame)).collect()
