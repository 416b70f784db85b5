"""Shape of the physical plans, and the whole run from raw rows to forecasts."""

import re

from helpers import random_series, rows, wide
from pyspark.sql import functions as F

from yearloom.operators import features, impute, modeling, reshape, split
from yearloom.plans import serving, training
from yearloom.session import scratch_path
from yearloom.spec import FEATURES, PanelSpec

YEARS = list(range(1990, 2000))
REPEATED = PanelSpec(ordinal="src_row")


def stored(spark, ordinal=False, **how):
    path = scratch_path(spark, "wide")
    wide(spark, random_series(17, 60, YEARS, **how), YEARS, ordinal).write.parquet(path)
    return spark.read.parquet(path)


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final(df):
    df.write.format("noop").mode("overwrite").save()
    rows_ = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return rows_, plan.split("+- == Initial Plan ==")[0]


def exchanges(plan):
    return len(re.findall(r"Exchange hashpartitioning", plan))


def test_raw_to_features_is_one_exchange(spark):
    frame = stored(spark)
    for df in (training.core(frame), training.engineered_rows(frame)):
        plan = planned(df)
        assert exchanges(plan) == 1
        assert not re.search(r"Python|Window|CartesianProduct|NestedLoop|SinglePartition|SortAggregate", plan)
        assert plan.count("Scan parquet") == 1 and not re.search(r"\bSort \[", plan)


def test_scan_reads_keys_and_year_columns_only(spark):
    path = scratch_path(spark, "wide")
    frame = wide(spark, random_series(1, 5, YEARS), YEARS).withColumn("Unit", F.lit("t"))
    frame.select("*", *[F.lit("E").alias(f"Y{y}F") for y in YEARS]).write.parquet(path)
    plan = planned(training.core(spark.read.parquet(path)))
    schema = re.search(r"ReadSchema: struct<([^>]*)", plan).group(1)
    assert "Unit" not in schema and "F:" not in schema
    assert "In(Element" in plan


def test_conditions_on_arrays_are_not_pushed_into_the_chain(spark):
    """Such a filter would evaluate filling twice; filters name plain columns."""
    plan = training.core(stored(spark))._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Filter (" in line or "Filter isnotnull" in line:
            assert "transform(" not in line and "lambda" not in line


def test_branch_for_frequent_keys_is_dropped_when_there_are_none(spark):
    frame = stored(spark, ordinal=True, max_repeats=2)
    _, plan = final(training.core(frame, REPEATED))
    assert "Window" not in plan and "Union" not in plan
    assert plan.count("Scan parquet") == 1
    long = reshape.unpivot_years(frame, REPEATED)
    _, plan = final(impute.interpolate_linear(long, REPEATED))
    assert "_block" not in plan and "Union" not in plan


def test_feature_windows_share_one_exchange(spark):
    path = scratch_path(spark, "core")
    training.core(stored(spark)).write.parquet(path)
    core = spark.read.parquet(path)
    plan = planned(features.engineered(core))
    assert exchanges(plan) == 1 and plan.count("Sort [") == 1
    assert not re.search(r"SinglePartition|Python", planned(features.calendar_panel(core)))


def test_forecast_adds_no_exchange_per_step(spark):
    core = training.core(stored(spark)).persist()
    p = training.prepare(core)
    from yearloom.plans.catalog import FORMULAS
    from yearloom.operators import forecast

    def count(years):
        state = serving.coded_state(p.core, p.areas, p.items, years)
        return exchanges(planned(forecast.forecast(state, years, {"f": FORMULAS})))

    assert count([2000]) == count(list(range(2000, 2005)))


def test_model_steps_predict_once(spark):
    """Each prediction is used as output and as lags; it must not be repeated."""
    from yearloom.operators import forecast

    core = training.core(stored(spark)).persist()
    p = training.prepare(core)
    few = {"rf": dict(modeling.RF_PARAMS, n_estimators=2, max_depth=2, min_samples_leaf=1)}
    fitted = modeling.fit_all(p.features, ["rf"], few)
    years = [2000, 2001, 2002, 2003]
    state = serving.coded_state(p.core, p.areas, p.items, years)
    df = forecast.forecast(state, years, forecast.scorers(fitted))
    plan = df._jdf.queryExecution().optimizedPlan().toString().split("InMemoryRelation")[0]
    assert plan.count("aggregate(") == 2 * len(years)
    assert "UDF" not in plan
    assert df.count() == len(years) * state.count()


def test_comparison_of_models_has_one_exchange(spark):
    """State rows are not spread a second time, whatever the models."""
    from yearloom.operators import forecast, trees

    core = training.core(stored(spark)).persist()
    years = [2000, 2001, 2002]
    state = forecast.series_state(core, years).withColumns({"Area_enc": F.lit(1), "Item_enc": F.lit(2)})
    few = trees.written_out("forest", FEATURES, [("Import_Lag1", 3.0, 1.0, 2.0)])
    scorers = {"a": forecast.ModelScorer(few, few), "b": forecast.ModelScorer(few, few)}
    plan = planned(forecast.forecast_compare(state, years, scorers))
    assert exchanges(plan.split("InMemoryTableScan")[0]) == 1


def test_whole_run(spark):
    few = {
        "rf": dict(modeling.RF_PARAMS, n_estimators=4),
        "xgb": dict(modeling.XGB_PARAMS, n_estimators=3),
        "ridge": modeling.RIDGE_PARAMS,
    }
    folder = scratch_path(spark, "run")
    frame = stored(spark, max_repeats=1)
    metrics = training.train(frame, folder, params=few)
    assert metrics.count() == 6
    loaded = serving.load(spark, folder)
    assert rows(loaded.core) == rows(training.core(frame))
    info = loaded.metrics.select("dataset_info.*").first()
    assert info["total_rows"] == loaded.core.count()
    assert loaded.metrics.selectExpr("hyperparameters['random_forest']['n_estimators']").first()[0] == 4

    series_count = loaded.core.select("Area", "Item").distinct().count()
    everything = serving.predict(loaded)
    assert everything.count() == series_count * 5 * 3
    assert serving.predict(loaded, algo="xgb").select("algo").distinct().count() == 1
    side = serving.compare(loaded)
    assert side.columns[3:] == ["rf_import", "xgb_import", "ridge_import", "rf_dep", "xgb_dep", "ridge_dep"]
    assert side.count() == series_count * 3
    one = loaded.core.select("Area", "Item").limit(1)
    point = serving.predict(loaded, [2018], "ridge", one)
    assert point.count() == 1
    kinds = {r[0] for r in serving.trends(loaded, [2014], "rf").select("kind").distinct().collect()}
    assert kinds == {"Historical", "rf forecast"}


def test_training_leaves_nothing_in_memory(spark):
    few = {"rf": dict(modeling.RF_PARAMS, n_estimators=2), "xgb": dict(modeling.XGB_PARAMS, n_estimators=2), "ridge": modeling.RIDGE_PARAMS}
    before = set(spark.sparkContext._jsc.getPersistentRDDs())
    training.train(stored(spark), scratch_path(spark, "run"), params=few)
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= before


def test_whole_run_under_other_names(spark):
    few = {"rf": dict(modeling.RF_PARAMS, n_estimators=2), "xgb": dict(modeling.XGB_PARAMS, n_estimators=2), "ridge": modeling.RIDGE_PARAMS}
    spec = PanelSpec(keys=("nation", "part"), kind="flag", time="yr")
    frame = stored(spark).withColumnsRenamed({"Area": "nation", "Item": "part", "Element": "flag"})
    folder = scratch_path(spark, "run")
    metrics = training.train(frame, folder, spec, params=few)
    plain = training.train(stored(spark), scratch_path(spark, "run"), params=few)
    assert metrics.count() == 6
    scores = [rows(m.where("algorithm = 'Ridge Regression'").drop("train_time_sec", "position")) for m in (metrics, plain)]
    assert scores[0] == scores[1]
    loaded = serving.load(spark, folder, spec=spec)
    assert loaded.core.columns[:3] == ["nation", "part", "yr"]
    assert serving.compare(loaded, spec=spec).columns[:3] == ["nation", "part", "yr"]
    assert serving.predict(loaded, [2001], "ridge", loaded.core.select("nation", "part").limit(2), spec).count() <= 2
    assert "yr" in serving.trends(loaded, [2001], "rf", spec).columns


def test_lookup_reads_one_range_of_the_keys(spark):
    import glob

    import pyarrow.parquet as pq
    from yearloom.sources import panel_store

    path = scratch_path(spark, "core").removeprefix("file://")
    core = spark.range(4_000).selectExpr(
        "concat('a', id % 40) Area", "concat('i', id % 7) Item", "cast(id as int) Year", "1.0 Import_Quantity", "1.0 Food_Supply", "1.0 Dependency_Pct")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        panel_store.write_core(core, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hits = files = 0
    for name in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        for g in range(meta.num_row_groups):
            bounds = meta.row_group(g).column(0).statistics
            files += 1
            hits += bounds.min <= "a17" <= bounds.max
    assert files > 4 and hits <= 2
    assert panel_store.read_series(panel_store.read_core(spark, path), "a17", "i3").count() > 0


def test_long_horizon_survives_its_checkpoints(spark):
    from yearloom.operators import forecast
    from yearloom.plans.catalog import FORMULAS

    p = training.prepare(training.core(stored(spark)).persist())
    years = list(range(2000, 2012))
    state = serving.coded_state(p.core, p.areas, p.items, years)
    cut = forecast.forecast_wide(state, years, {"f": FORMULAS}, steps_per_checkpoint=2)
    whole = forecast.forecast_wide(state, years, {"f": FORMULAS}, steps_per_checkpoint=0)
    assert rows(cut) == rows(whole)
