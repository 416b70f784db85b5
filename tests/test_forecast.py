"""Forecasts against a plain per-series computation."""

import pytest
from helpers import CORE_SCHEMA, random_series, rows, wide

from yearloom.operators import forecast, profile
from yearloom.plans import serving, training
from yearloom.plans.catalog import FORMULAS
from yearloom.spec import FEATURES


@pytest.fixture(scope="module")
def prepared(spark):
    years = range(1995, 2002)
    return training.prepare(training.core(wide(spark, random_series(21, 25, years), years)).persist())


def by_hand(prepared, key, years):
    """One series, one year at a time."""
    known = {
        r["Year"]: [r["Import_Quantity"], r["Dependency_Pct"], r["Food_Supply"]]
        for r in prepared.core.collect() if (r["Area"], r["Item"]) == key
    }
    codes = [
        {r["label"]: r["code"] for r in v.table.collect()}[k]
        for v, k in zip((prepared.areas, prepared.items), key)
    ]
    result = []
    for year in years:
        def lag(column, k, year=year):
            return known[year - k][column] if year - k in known else 0.0
        if year - 1 in known:
            supply = known[year - 1][2]
        else:
            supply = known[max(known)][2] if known else 0.0
        imports = [lag(0, k) for k in (1, 2, 3)]
        x = [*codes, year, *imports, lag(1, 1), lag(1, 2), sum(imports) / 3, supply]
        out = []
        for base, weights in (FORMULAS.imports, FORMULAS.ratio):
            total = base
            for w, v in zip(weights, x, strict=True):
                total = total + w * v
            out.append(round(total * 100) / 100)
        known[year] = [*out, supply]
        result.append((*key, year, *out))
    return result


@pytest.mark.parametrize("years", [
    [2002, 2003, 2004], list(range(2002, 2010)), [2005], [1998], [2003, 2007, 2006], [1999, 2000, 2001, 2002],
])
def test_forecast_agrees_with_a_plain_loop(spark, prepared, years):
    state = serving.coded_state(prepared.core, prepared.areas, prepared.items, years)
    got = forecast.forecast(state, years, {"f": FORMULAS}).drop("algo")
    keys = {(r["Area"], r["Item"]) for r in prepared.core.collect()}
    want = sorted(row for key in keys for row in by_hand(prepared, key, years))
    assert [r[:3] for r in rows(got)] == [r[:3] for r in want]
    for a, b in zip(rows(got), want):
        assert a[3:] == pytest.approx(b[3:], abs=0.011)
    assert sum(a[3:] == pytest.approx(b[3:], abs=1e-9) for a, b in zip(rows(got), want)) > 0.95 * len(want)


def test_known_pair_without_history_starts_from_zero(spark, prepared):
    pairs = {(r["Area"], r["Item"]) for r in prepared.core.collect()}
    areas, items = {a for a, _ in pairs}, {i for _, i in pairs}
    missing = sorted((a, i) for a in areas for i in items if (a, i) not in pairs)[0]
    request = spark.createDataFrame([missing], "Area string, Item string")
    lags = forecast.calendar_lags(prepared.core, 2002, request).first()
    assert all(lags[c] == 0.0 for c in FEATURES[3:])
    state = serving.coded_state(prepared.core, prepared.areas, prepared.items, [2002], request)
    assert rows(forecast.forecast(state, [2002], {"f": FORMULAS}).drop("algo")) == [
        pytest.approx(r) for r in by_hand(prepared, missing, [2002])]


def test_unknown_label_is_an_error(spark, prepared):
    request = spark.createDataFrame([("nowhere", "nothing")], "Area string, Item string")
    state = serving.coded_state(prepared.core, prepared.areas, prepared.items, [2002], request)
    with pytest.raises(Exception, match="no code for"):
        state.collect()


def test_supply_is_carried_from_the_latest_year(spark):
    core = spark.createDataFrame(
        [("a", "i", 2010, 1.0, 5.0, 20.0), ("a", "i", 2011, 2.0, 6.0, 33.0)], CORE_SCHEMA)
    lags = forecast.calendar_lags(core, 2014).first()
    assert lags["FoodSupply_Lag1"] == 6.0 and lags["Import_Lag1"] == 0.0 and lags["Import_Lag3"] == 2.0


def test_first_step_is_the_point_forecast(prepared):
    state = serving.coded_state(prepared.core, prepared.areas, prepared.items, [2002, 2003])
    many = forecast.forecast(state, [2002, 2003], {"f": FORMULAS})
    one = forecast.forecast(state, [2002], {"f": FORMULAS})
    assert rows(many.where("Year = 2002")) == rows(one)


def test_compare_is_the_long_form_side_by_side(prepared):
    years = [2002, 2003]
    state = serving.coded_state(prepared.core, prepared.areas, prepared.items, years)
    both = {"x": FORMULAS, "y": forecast.LinearScorer(FORMULAS.ratio, FORMULAS.imports)}
    long = forecast.forecast(state, years, both)
    side = forecast.forecast_compare(state, years, both)
    for algo in both:
        part = long.where(f"algo = '{algo}'").select("Area", "Item", "Year", "imp", "dep")
        assert rows(side.select("Area", "Item", "Year", f"{algo}_import", f"{algo}_dep")) == rows(part)


def test_trend_joins_history_and_forecast(prepared):
    state = serving.coded_state(prepared.core, prepared.areas, prepared.items, [2002])
    future = forecast.forecast(state, [2002], {"f": FORMULAS})
    trend = forecast.trend_series(prepared.core, future)
    kinds = dict(rows(trend.groupBy("kind").count()))
    assert kinds == {"Historical": profile.history_tail(prepared.core).count(), "f forecast": future.count()}
