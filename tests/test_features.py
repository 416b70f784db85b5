import pytest
from helpers import CORE_SCHEMA, random_series, rows, wide

from yearloom.operators import encode, features, forecast, profile, series
from yearloom.plans import training
from yearloom.spec import ENGINEERED, PANEL, PanelSpec


def core(spark, entries):
    return spark.createDataFrame(
        [(a, i, y, float(m), float(s), float(r)) for a, i, y, m, s, r in entries], CORE_SCHEMA)


def one_series(spark, values, years=None):
    years = years or range(2000, 2000 + len(values))
    return core(spark, [("a", "i", y, v, v + 1, v + 2) for y, v in zip(years, values)])


def test_rolling_mean_golden(spark):
    frame = features.rolling_mean(one_series(spark, [1, 2, 4, 8, 16])).orderBy("Year")
    assert [r["Import_RollingMean3"] for r in frame.collect()] == [None, 1, 1.5, 7 / 3, 14 / 3]


def test_lags_go_by_position_and_calendar_lags_by_year(spark):
    frame = one_series(spark, [10, 20, 30, 40], [2000, 2002, 2003, 2004])
    at_2002 = features.lag_features(frame).where("Year = 2002").first()
    assert (at_2002["Import_Lag1"], at_2002["Dep_Lag1"], at_2002["FoodSupply_Lag1"]) == (10, 12, 11)
    by_year = {r["Year"]: r for r in features.calendar_panel(frame).collect()}
    assert by_year[2002]["Import_Lag1"] == 0.0 and by_year[2002]["Import_Lag2"] == 10
    assert by_year[2002]["FoodSupply_Lag1"] == 41  # latest known year, though later
    assert by_year[2004]["Import_RollingMean3"] == (30 + 20 + 0) / 3


def test_calendar_panel_agrees_with_state_features(spark):
    frame = series.core_rows(series.histories(wide(spark, random_series(3, 30, range(1990, 1999)), range(1990, 1999))))
    panel = features.calendar_panel(frame)
    for year in (1992, 1998):
        state = forecast.calendar_lags(frame, year, frame.where(f"Year = {year}"))
        want = panel.where(f"Year = {year}").select(*state.columns)
        assert rows(state) == rows(want) and state.count() > 0


def test_short_series_lose_rows_but_keep_their_code(spark):
    frame = core(spark, [("b", "x", 2000 + k, 1, 1, 1) for k in range(3)]
                 + [("a", "y", 2000 + k, 1, 1, 1) for k in range(5)])
    prepared = training.prepare(frame)
    assert rows(prepared.areas.table) == [("a", 0), ("b", 1)]
    assert rows(prepared.features.select("Area", "Year", "Area_enc", "Item_enc")) == [
        ("a", 2003, 0, 1), ("a", 2004, 0, 1)]
    assert rows(profile.code_ranges(prepared.features)) == [(0, 1)]
    counts = profile.lag_drop_counts(features.engineered(frame)).first()
    assert tuple(counts) == (8, 2, 6)


def test_prepare_from_wide_agrees_with_prepare_from_core(spark):
    years = range(1990, 1998)
    frame = wide(spark, random_series(12, 40, years), years)
    a, b = training.prepare_wide(frame), training.prepare(training.core(frame))
    names = [*PANEL.core, *ENGINEERED, "Area_enc", "Item_enc"]
    assert rows(a.features.select(*names)) == rows(b.features.select(*names))
    assert rows(a.core) == rows(b.core)


def test_vocabulary_is_ranked_over_many_partitions(spark):
    labels = [f"label {i * 7919 % 1000:04d}" for i in range(1000)] + ["é", "Z", "a", "ß"]
    df = spark.createDataFrame([(t,) for t in [*labels * 3, None]], "x string").repartition(7)
    want = [(t, i) for i, t in enumerate(sorted(set(labels)))]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        vocab = encode.vocabulary(df, "x")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert rows(vocab.table) == rows(spark.createDataFrame(want, "label string, code int"))
    # one label on a third of all rows
    skewed = df.dropna().unionByName(spark.createDataFrame([("Z",)] * 1500, "x string"))
    got = encode.encode(skewed, vocab, "x", "c")
    assert got.count() == skewed.count() and got.where("x = 'Z'").select("c").distinct().collect()[0][0] == dict(want)["Z"]
    assert "repeat" not in got._jdf.queryExecution().toString().lower()


def test_unknown_label_is_an_error(spark):
    vocab = encode.vocabulary(spark.createDataFrame([("a",), ("b",)], "x string"), "x")
    with pytest.raises(Exception, match="no code for x: q"):
        encode.encode(spark.createDataFrame([("q",)], "x string"), vocab, "x", "c").collect()


def test_other_names(spark):
    spec = PanelSpec(keys=("Land", "Good"), kind="What", time="At", value="V")
    frame = spark.createDataFrame(
        [("l", "g", "Import Quantity", 1.0, None, 3.0), ("l", "g", "Food supply x", 2.0, 2.0, 2.0)],
        "Land string, Good string, What string, Y1 double, Y2 double, Y3 double")
    got = training.core(frame, spec, ("Import Quantity", "Food supply x"))
    assert got.columns[:3] == ["Land", "Good", "At"]
    assert rows(got) == [("l", "g", 1, 1.0, 2.0, 50.0), ("l", "g", 2, 2.0, 2.0, 100.0), ("l", "g", 3, 3.0, 2.0, 150.0)]
