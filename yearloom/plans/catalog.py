"""Every registered query: operators over panels derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearloom.functions.columns import round_to, to_number
from yearloom.operators import (
    evaluate, features, forecast, impute, linear, modeling, panel, profile, reshape, series, sketches, split, trees,
)
from yearloom.plans import serving, training
from yearloom.session import scratch_path
from yearloom.sources import derived, metrics_store, panel_store
from yearloom.sources import wide as wide_scan
from yearloom.spec import (
    ELEMENTS, ENGINEERED, FEATURES, IMPORTS, RATIO, RF_PARAMS, RIDGE_PARAMS, SUPPLY, XGB_PARAMS, PanelSpec,
)

Query = Callable[[SparkSession, str], DataFrame]

REPEATED = PanelSpec(ordinal="src_row")
# Years forecast beyond the last one of the data.
AHEAD = 3
# Name of the third element where it stands for the first measure too.
SECOND_IMPORT = "Import Value"

# Fixed formulas for the forecast queries that have a SQL counterpart.
FORMULAS = forecast.LinearScorer(
    imports=(3.5, [0.25, -0.125, 0.0, 0.5, 0.25, 0.125, 0.0625, -0.03125, 0.125, 0.25]),
    ratio=(20.0, [0.0, 0.0625, 0.0, -0.125, 0.0, 0.0, 0.5, 0.25, 0.0625, -0.0625]),
)


# Three formulas side by side, as three algorithms would be.
FORMULA_SETS = {
    "plain": FORMULAS,
    "steady": forecast.LinearScorer(
        imports=(0.0, [0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0]),
        ratio=(0.0, [0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0])),
    "mean": forecast.LinearScorer(
        imports=(1.0, [0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.75, 0.0]),
        ratio=(2.0, [0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.5, 0.25, 0.0, 0.125])),
}

# Two small trees a target, for the tree queries that have a SQL counterpart.
FIXED_TREES = {
    "import": [
        ("Import_Lag1", 25.0, ("Dep_Lag1", 80.0, 11.25, ("Item_enc", 70.0, 17.5, 14.0)), ("Import_Lag2", 30.0, 28.0, 41.5)),
        ("Year", 1999.0, 0.5, ("Area_enc", 12.0, ("FoodSupply_Lag1", 20.0, -1.25, 0.75), 2.0)),
    ],
    "dep": [
        ("Dep_Lag1", 100.0, ("Dep_Lag2", 60.0, 55.0, 75.25), ("Import_RollingMean3", 30.0, 120.0, 140.5)),
        ("Import_Lag3", 20.0, ("Dep_Lag1", 150.0, -2.0, 6.5), 3.25),
    ],
}


# --- shared steps -------------------------------------------------------------

def horizon(spark: SparkSession, folder: str) -> list[int]:
    """The years after the last one with an order."""
    last = derived.years(spark, folder)[-1]
    return [last + k for k in range(1, AHEAD + 1)]


def _stored(df: DataFrame, name: str) -> DataFrame:
    """For what several jobs read: a table in the shared folder, nothing in memory."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _selected(spark: SparkSession, folder: str, **how) -> DataFrame:
    """Filtered and projected wide rows."""
    raw = derived.wide(spark, folder, **how)
    spec = REPEATED if how.get("repeated") else PanelSpec()
    return wide_scan.select_years(wide_scan.filter_elements(raw, spec), spec)


def _long(spark: SparkSession, folder: str, **how) -> DataFrame:
    spec = REPEATED if how.get("repeated") else PanelSpec()
    return reshape.unpivot_years(_selected(spark, folder, **how), spec)


def _core(spark: SparkSession, folder: str, **how) -> DataFrame:
    spec = REPEATED if how.get("repeated") else PanelSpec()
    return training.core(derived.wide(spark, folder, **how), spec)


def _kept_core(spark: SparkSession, folder: str) -> DataFrame:
    """For operators that read the panel several times."""
    return _stored(_core(spark, folder), "core")


def _prepared(spark: SparkSession, folder: str) -> training.Prepared:
    return training.prepare(_kept_core(spark, folder))


def _assigned(spark: SparkSession, folder: str) -> DataFrame:
    """Feature rows without codes, split."""
    return split.assign_split(_stored(training.engineered_rows(derived.wide(spark, folder)), "features"))


def _at(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: round_to(F.col(c), digits) for c in columns})


# --- ingest -------------------------------------------------------------------

def _cells(wide: DataFrame) -> DataFrame:
    """The wide rows with their year columns in one text: names and whole values, in the columns' order."""
    shown = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("long").cast("string"), F.lit("")))
             for c in sorted(wide_scan.year_columns(wide.columns))]
    return wide.select("Area", "Item", "Element", F.concat_ws(",", *shown).alias("cells"))


def scan_wide(spark, folder):
    return _cells(wide_scan.select_years(derived.wide(spark, folder)))


def filter_elements(spark, folder):
    raw = wide_scan.filter_elements(derived.wide(spark, folder))
    return raw.groupBy("Element").agg(F.count("*").alias("row_count"))


def core_roundtrip(spark, folder):
    path = scratch_path(spark, "core")
    panel_store.write_core(_core(spark, folder), path)
    return _at(panel_store.read_core(spark, path), 4, IMPORTS, SUPPLY, RATIO)


def stage_counts(spark, folder):
    """Rows of every stage, counted on the way: the raw rows and histories while they are
    written, the long stages in the one pass that computes them."""
    seen = profile.Watched()
    raw = _stored(seen.watch("raw", derived.wide(spark, folder)), "wide")
    selected = seen.watch("selected", wide_scan.select_years(wide_scan.filter_elements(raw)))
    long = seen.watch("long", reshape.unpivot_years(selected))
    _passed(seen.watch("clean", impute.clean_long(impute.interpolate_linear(long))))
    hist = _stored(series.histories(raw), "histories")
    _passed(seen.watch("core", series.core_rows(hist)))
    _passed(seen.watch("features", series.lagged_rows(hist)))
    return seen.table(spark).select("stage", "row_count")


def _passed(df: DataFrame) -> None:
    """Computes all rows and keeps none."""
    df.write.format("noop").mode("overwrite").save()


def csv_rejects(spark, folder):
    """A text file in which some lines have a field too many: rows kept and set aside."""
    raw = derived.wide(spark, folder).drop(*[f"Y{y}F" for y in derived.years(spark, folder)])
    last = raw.columns[-1]
    value = F.coalesce(F.col(last).cast("long").cast("string"), F.lit("NA"))
    bad = (F.col("Area") == "NATION_7") & F.col("Item").endswith("PROMO")
    path, stored = scratch_path(spark, "wide-csv"), scratch_path(spark, "staged")
    raw.withColumn(last, F.when(bad, F.concat(value, F.lit(",surplus"))).otherwise(value)).write.option("header", True).option(
        "encoding", "ISO-8859-1").option("quote", "\u0000").csv(path)
    kept, rejected = wide_scan.stage_wide_csv(spark, path, stored)
    counts = kept.groupBy("Element").agg(F.count("*").alias("kept"))
    element = F.get(F.split("line", ","), F.lit(2))
    return counts.join(rejected.groupBy(element.alias("Element")).agg(F.count("*").alias("rejected")), "Element", "left").select(
        "Element", "kept", F.coalesce("rejected", F.lit(0)).alias("rejected"))


def scan_csv(spark, folder):
    """The wide table through a text file in the source's encoding and back."""
    path = scratch_path(spark, "wide-csv")
    derived.wide(spark, folder).write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    raw = wide_scan.select_years(wide_scan.scan_wide_csv(spark, path))
    years = wide_scan.year_columns(raw.columns)
    return _cells(raw.withColumns({c: to_number(F.col(c)) for c in years}))


# --- reshape and clean --------------------------------------------------------

def unpivot_years(spark, folder):
    return _long(spark, folder)


def coerce_numeric(spark, folder):
    texts = derived.text_values(spark, folder)
    return texts.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", to_number(F.col("raw")).alias("value")
    )


def interpolate_linear(spark, folder):
    return _at(impute.interpolate_linear(_long(spark, folder)), 4, "Value")


def interpolate_repeated(spark, folder):
    rows = _long(spark, folder, repeated=True)
    return _at(impute.interpolate_linear(rows, REPEATED), 4, "Value")


def interpolate_pieces(spark, folder):
    """The piecewise path for very long series, here for every series."""
    rows = _long(spark, folder, repeated=True)
    return _at(impute.interpolate_linear(rows, REPEATED, series_limit=0), 4, "Value")


def clean_long(spark, folder):
    rows = _long(spark, folder, signed=True)
    return _at(impute.clean_long(impute.interpolate_linear(rows)), 4, "Value")


def _measures(spark, folder):
    rows = _long(spark, folder, repeated=True, signed=True)
    filled = impute.interpolate_linear(rows, REPEATED)
    return reshape.pivot_measures(impute.clean_long(filled, REPEATED), REPEATED)


def pivot_measures(spark, folder):
    return _at(_measures(spark, folder), 4, IMPORTS, SUPPLY)


def core_panel(spark, folder):
    return _at(_core(spark, folder), 4, IMPORTS, SUPPLY, RATIO)


def core_panel_repeated(spark, folder):
    """Negative values and several source rows per series."""
    core = _core(spark, folder, repeated=True, signed=True)
    return _at(core, 4, IMPORTS, SUPPLY, RATIO)


def core_panel_elements(spark, folder):
    """Two elements that stand for one measure: filled apart, averaged together."""
    raw = derived.wide(spark, folder, repeated=True, signed=True, other=SECOND_IMPORT)
    core = training.core(raw, REPEATED, (*ELEMENTS, SECOND_IMPORT))
    return _at(core, 4, IMPORTS, SUPPLY, RATIO)


def core_panel_long(spark, folder):
    """The same from the long operators."""
    return _at(panel.core_panel(_measures(spark, folder)), 4, IMPORTS, SUPPLY, RATIO)


# --- features -----------------------------------------------------------------

def lag_features(spark, folder):
    lags = [c for c in ENGINEERED if c != "Import_RollingMean3"]
    frame = features.lag_features(_core(spark, folder)).select("Area", "Item", "Year", *lags)
    return _at(frame, 4, *lags)


def rolling_mean(spark, folder):
    frame = features.rolling_mean(_core(spark, folder))
    return _at(frame.select("Area", "Item", "Year", "Import_RollingMean3"), 4, "Import_RollingMean3")


def label_encode(spark, folder):
    p = _prepared(spark, folder)
    pairs = p.core.select("Area", "Item").distinct()
    return features.with_codes(pairs, p.areas, p.items)


def code_ranges(spark, folder):
    return profile.code_ranges(_prepared(spark, folder).features)


def feature_panel(spark, folder):
    p = training.prepare_wide(derived.wide(spark, folder))
    return _at(p.features, 4, IMPORTS, SUPPLY, RATIO, *ENGINEERED)


def feature_panel_long(spark, folder):
    """The same from a core panel with window functions."""
    return _at(_prepared(spark, folder).features, 4, IMPORTS, SUPPLY, RATIO, *ENGINEERED)


def calendar_lags(spark, folder):
    """For every pair of the raw table, with or without history."""
    raw = derived.wide(spark, folder)
    frame = forecast.calendar_lags(training.core(raw), derived.years(spark, folder)[-1] - 1, raw)
    return _at(frame, 4, *ENGINEERED)


def calendar_panel(spark, folder):
    core = _core(spark, folder, repeated=True, signed=True)
    frame = features.calendar_panel(core).select("Area", "Item", "Year", *ENGINEERED)
    return _at(frame, 4, *ENGINEERED)


def feature_non_null(spark, folder):
    return profile.feature_non_null(features.engineered(_core(spark, folder)))


def lag_drop_counts(spark, folder):
    return profile.lag_drop_counts(features.engineered(_core(spark, folder)))


# --- profile ------------------------------------------------------------------

def dataset_info(spark, folder):
    prepared = training.prepare_wide(derived.wide(spark, folder))
    return profile.dataset_info(prepared.core, split.assign_split(prepared.features))


def measure_stats(spark, folder):
    return profile.measure_stats(_kept_core(spark, folder))


def _histogram(frame: DataFrame) -> DataFrame:
    return _at(frame, 4, "lo", "hi")


def winsor_hist(spark, folder):
    return _histogram(profile.winsor_histogram(_kept_core(spark, folder)))


def ratio_hist(spark, folder):
    return _histogram(profile.histogram(_kept_core(spark, folder), RATIO))


def vocabulary(spark, folder):
    p = _prepared(spark, folder)
    return p.areas.table.select(F.lit("Area").alias("kind"), "label", "code").unionByName(
        p.items.table.select(F.lit("Item").alias("kind"), "label", "code")
    )


def series_lookup(spark, folder):
    path = scratch_path(spark, "core")
    panel_store.write_core(_core(spark, folder), path)
    core = panel_store.read_core(spark, path)
    return _at(panel_store.read_series(core, "NATION_7", "Brand#12/PROMO"), 4, IMPORTS, SUPPLY, RATIO)


def item_lookup(spark, folder):
    path = scratch_path(spark, "core")
    panel_store.write_core(_core(spark, folder), path)
    core = panel_store.read_core(spark, path)
    return _at(panel_store.read_item(core, "Brand#12/PROMO"), 4, IMPORTS, SUPPLY, RATIO)


def sketch_profile(spark, folder):
    """Distinct items and quantiles from stored sketches per area, merged: whether they are as near
    to the exact ones as stated."""
    core, path = _kept_core(spark, folder), scratch_path(spark, "sketches")
    sketches.write_sketches(sketches.area_sketches(core), path)
    whole = sketches.merged(spark.read.parquet(path))
    exact = core.agg(F.count_distinct("Item")).scalar()
    items = sketches.distinct_items(whole).withColumn("exact", exact).select(
        F.lit("Item").alias("measure"), F.lit(None).cast("double").alias("probability"), F.col("exact").alias("row_count"),
        (F.abs(F.col("n_items") - F.col("exact")) <= sketches.DISTINCT_ERROR * F.col("exact")).alias("within"))
    found = sketches.quantiles(whole, [0.05, 0.25, 0.5, 0.75, 0.95]).collect()
    ranks = core.agg(F.count("*").alias("n"), *[
        f.alias(f"{side}{i}") for i, r in enumerate(found)
        for side, f in (("below", F.count_if(F.col(r.measure) < r.value)), ("upto", F.count_if(F.col(r.measure) <= r.value)))])
    p = lambda i: found[i].probability
    rows = ranks.select(F.inline(F.array(*[
        F.struct(F.lit(r.measure).alias("measure"), F.lit(p(i)).alias("probability"), F.col("n").alias("row_count"),
                 ((F.col(f"below{i}") <= (p(i) + sketches.RANK_ERROR) * F.col("n"))
                  & (F.col(f"upto{i}") >= (p(i) - sketches.RANK_ERROR) * F.col("n"))).alias("within"))
        for i, r in enumerate(found)])))
    return items.unionByName(rows)


def history_tail(spark, folder):
    return profile.history_tail(_core(spark, folder))


def history_tail_short(spark, folder):
    """Fewer years than most series have."""
    return profile.history_tail(_core(spark, folder), rows=4)


# --- modelling ----------------------------------------------------------------

def split_assign(spark, folder):
    return _assigned(spark, folder).select("Area", "Item", "Year", "split")


def split_counts(spark, folder):
    return split.split_counts(_assigned(spark, folder))


def _split_features(spark, folder) -> DataFrame:
    """Feature rows with codes, split, as a table."""
    return _stored(split.assign_split(_stored(_prepared(spark, folder).features, "features")), "split")


def ridge_gram(spark, folder):
    """The sums that ridge fits of imports are solved from."""
    train = _split_features(spark, folder).where("split = 'train'")
    return _at(linear.gram(linear.moments(train, [*FEATURES, IMPORTS])), 3, "cross_product")


def ridge_residual(spark, folder):
    """The normal equations at the fitted weights: 0 for every target and feature."""
    train = _split_features(spark, folder).where("split = 'train'")
    fitted = modeling.fit_algorithm(train, "ridge")
    models = {f.key: (modeling.TARGETS[f.target], f.model) for f in fitted}
    rest = linear.residuals(train, models, FEATURES, RIDGE_PARAMS["alpha"])
    return rest.withColumn("rest", F.round("rest", 6) + F.lit(0.0))


def ridge_metrics(spark, folder):
    """Scores of the fitted ridge models on both parts of the split."""
    return evaluate.evaluate(_scores(spark, folder, "ridge"))


def bootstrap_counts(spark, folder):
    """Per tree of the forest, the rows drawn from the training rows and their weights."""
    train = _split_features(spark, folder).where("split = 'train'")
    numbers = range(RF_PARAMS["n_estimators"])
    drawn = trees.bootstrapped(modeling.prepare(train).rows, RF_PARAMS["random_state"], numbers)
    return drawn.groupBy((F.col("i") + 1).alias("tree")).agg(
        F.count("*").alias("row_count"), F.sum("weight").cast("long").alias("weight"))


def boost_first_split(spark, folder):
    """Root of the first boosted tree of each target; the gain per row."""
    train = _split_features(spark, folder).where("split = 'train'")
    found = [
        f.model.table(spark).where("tree = 1 and node = 1").select(F.lit(f.key).alias("model"), "feature", "threshold",
                                                                   round_to(F.col("gain") / F.col("cover"), 4).alias("gain"), "cover")
        for f in modeling.fit_algorithm(train, "xgb", params={**XGB_PARAMS, "n_estimators": 1})
    ]
    return found[0].unionByName(found[1])


def tree_importance(spark, folder):
    """Importances of fixed trees, by the gains their splits have on the training rows."""
    train = _split_features(spark, folder).where("split = 'train'")
    rows = [
        (f"{kind}_{target}", i, FEATURES[i], size)
        for kind, penalty in (("forest", 0.0), ("boosted", 1.0)) for target, nested in FIXED_TREES.items()
        for i, size in enumerate(trees.measured(
            trees.written_out(kind, FEATURES, nested), train, modeling.TARGETS[target], penalty).sizes())
    ]
    return modeling.ranked_shares(spark.createDataFrame(rows, "model string, position int, feature string, size double"))


def _naive(spark, folder):
    predictions = evaluate.naive_predictions(_assigned(spark, folder))
    order = predictions.select("model", "target", "position").distinct()
    return evaluate.evaluate(predictions).join(order, ["model", "target"])


def eval_metrics(spark, folder):
    return _naive(spark, folder).select("model", "target", *evaluate.METRICS)


def best_model(spark, folder):
    return evaluate.best_model(_naive(spark, folder))


def metric_best_flags(spark, folder):
    return evaluate.best_flags(_naive(spark, folder)).select(
        "model", "best_r2_test", "best_mae", "best_rmse", "best_mape"
    )


def r2_cap_flag(spark, folder):
    """Which models the sanity cap reports."""
    metrics = _naive(spark, folder).select("model", "target", "r2_test")
    over = evaluate.over_cap(metrics).select("model", "target", F.lit(True).alias("over"))
    joined = metrics.join(over, ["model", "target"], "left")
    return joined.select("model", "target", "r2_test", F.coalesce("over", F.lit(False)).alias("over_cap"))


@dataclass(frozen=True)
class _Fits:
    prepared: training.Prepared
    split: DataFrame
    fitted: list[modeling.Fitted]


def _fits(spark, folder, algorithms=modeling.ALGORITHMS) -> _Fits:
    """Fits on the stored split feature rows."""
    prepared = _prepared(spark, folder)
    stored = _stored(split.assign_split(_stored(prepared.features, "features")), "split")
    return _Fits(prepared, stored, modeling.fit_all(stored.where("split = 'train'"), algorithms))


def _scores(spark, folder, algo):
    fits = _fits(spark, folder, [algo])
    return modeling.predictions_long(fits.split, fits.fitted)


def rf_scores(spark, folder):
    return _scores(spark, folder, "rf")


def gbt_scores(spark, folder):
    return _scores(spark, folder, "xgb")


def ridge_scores(spark, folder):
    return _at(_at(_scores(spark, folder, "ridge"), 4, "y"), 3, "p")


def _score_counts(scores: DataFrame) -> DataFrame:
    """What of a scoring does not depend on the fit: rows and labels."""
    return scores.groupBy("model", "target", "split").agg(
        F.count("p").alias("row_count"), round_to(F.sum("y"), 2).alias("label_sum"))


def rf_score_counts(spark, folder):
    return _score_counts(rf_scores(spark, folder))


def ridge_score_counts(spark, folder):
    return _score_counts(ridge_scores(spark, folder))


def importance_rank(spark, folder):
    return modeling.importances(spark, _fits(spark, folder).fitted)


def slope_importance(spark, folder):
    """Ranked shares of coefficients that SQL can find too."""
    return modeling.ranked_shares(modeling.slopes(_assigned(spark, folder).where("split = 'train'").withColumns(
        {"Area_enc": F.length("Area"), "Item_enc": F.length("Item")})))


def _naive_document(spark, folder) -> DataFrame:
    """The metrics document of the rules that need no fitting, written and read."""
    assigned = _stored(_assigned(spark, folder), "split")
    predictions = evaluate.naive_predictions(assigned)
    order = predictions.select("model", "target", "position").distinct()
    metrics = evaluate.evaluate(predictions).join(order, ["model", "target"]).withColumn("train_time_sec", F.lit(0.0))
    shares = modeling.ranked_shares(modeling.slopes(assigned.where("split = 'train'").withColumns(
        {"Area_enc": F.length("Area"), "Item_enc": F.length("Item")})))
    by_target = F.concat(F.lit("slope_"), F.col("target"))
    weights = order.select(by_target.alias("rule"), F.col("model").alias("name")).join(
        shares.withColumnRenamed("model", "rule"), "rule").select(F.col("name").alias("model"), "feature", "importance")
    path = scratch_path(spark, "metrics")
    metrics_store.write_metrics(
        path, profile.dataset_info(_core(spark, folder), assigned), metrics, weights, evaluate.best_model(metrics))
    return metrics_store.read_metrics(spark, path)


def document_models(spark, folder):
    return metrics_store.model_rows(_naive_document(spark, folder)).drop("train_time_sec")


def document_importances(spark, folder):
    return metrics_store.importance_rows(_naive_document(spark, folder))


def document_info(spark, folder):
    """Facts of the data and the winners, read back."""
    return _naive_document(spark, folder).select(
        *[f"dataset_info.{c}" for c in ("total_rows", "training_rows", "n_countries", "n_items", "year_min", "year_max")],
        F.col("best_model")["import_quantity"].alias("best_import"), F.col("best_model")["dependency_pct"].alias("best_dep"))


def model_comparison(spark, folder):
    fits = _fits(spark, folder)
    return training.score(fits.split, fits.fitted).drop("train_time_sec")


def metrics_document(spark, folder):
    fits = _fits(spark, folder)
    metrics = training.score(fits.split, fits.fitted)
    path = scratch_path(spark, "metrics")
    metrics_store.write_metrics(
        path, profile.dataset_info(fits.prepared.core, fits.split), metrics,
        modeling.importances(spark, fits.fitted), evaluate.best_model(metrics),
    )
    document = metrics_store.read_metrics(spark, path)
    return metrics_store.model_rows(document).drop("train_time_sec")


# --- forecast -----------------------------------------------------------------

def _state(spark, folder, years):
    p = _prepared(spark, folder)
    return p.core, serving.coded_state(p.core, p.areas, p.items, years)


def _forecast(spark, folder, years):
    core, state = _state(spark, folder, years)
    return core, forecast.forecast(state, years, {"fixed": FORMULAS})


def point_forecast(spark, folder):
    """One year beyond a gap: nothing is fed back."""
    return _forecast(spark, folder, horizon(spark, folder)[-1:])[1].drop("algo")


def recursive_forecast(spark, folder):
    return _forecast(spark, folder, horizon(spark, folder))[1].drop("algo")


def requested_forecast(spark, folder):
    """Every known area with every known item: pairs without history start from zeros."""
    years = horizon(spark, folder)
    p = _prepared(spark, folder)
    raw = derived.wide(spark, folder).select("Area", "Item").distinct()
    known = raw.join(p.areas.table.select(F.col("label").alias("Area")), "Area").join(
        p.items.table.select(F.col("label").alias("Item")), "Item")
    state = serving.coded_state(p.core, p.areas, p.items, years, known)
    return forecast.forecast(state, years, {"fixed": FORMULAS}).drop("algo")


def trend_series(spark, folder):
    core, future = _forecast(spark, folder, horizon(spark, folder))
    return forecast.trend_series(core, future)


def formula_compare(spark, folder):
    """Three fixed formulas side by side."""
    years = horizon(spark, folder)
    _, state = _state(spark, folder, years)
    return forecast.forecast_compare(state, years, FORMULA_SETS)


def tree_forecast(spark, folder):
    """The recursive forecast with fixed trees, as conditions over the features."""
    years = horizon(spark, folder)
    _, state = _state(spark, folder, years)
    pair = [trees.written_out("boosted", FEATURES, FIXED_TREES[t]) for t in modeling.TARGETS]
    return forecast.forecast(state, years, {"fixed": forecast.ModelScorer(*pair)}).drop("algo")


def served_forecast(spark, folder):
    """A stored run, loaded again and asked for the forecast of one algorithm."""
    path = scratch_path(spark, "run")
    training.train(derived.wide(spark, folder), path, algorithms=["ridge"])
    run = serving.load(spark, path)
    return serving.predict(run, horizon(spark, folder), algo="ridge")


def forecast_compare(spark, folder):
    years = horizon(spark, folder)
    fits = _fits(spark, folder)
    p = fits.prepared
    state = serving.coded_state(p.core, p.areas, p.items, years)
    return forecast.forecast_compare(state, years, forecast.scorers(fits.fitted))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        scan_wide, scan_csv, csv_rejects, item_lookup, sketch_profile, filter_elements, core_roundtrip, stage_counts,
        unpivot_years, coerce_numeric, interpolate_linear, interpolate_repeated,
        interpolate_pieces, clean_long, pivot_measures, core_panel, core_panel_repeated,
        core_panel_elements, core_panel_long,
        lag_features, rolling_mean, label_encode, code_ranges, feature_panel,
        feature_panel_long, calendar_lags, calendar_panel, feature_non_null, lag_drop_counts,
        dataset_info, measure_stats, winsor_hist, ratio_hist, vocabulary, series_lookup,
        history_tail, history_tail_short,
        split_assign, split_counts, ridge_gram, eval_metrics, best_model, metric_best_flags,
        r2_cap_flag,
        ridge_residual, ridge_metrics, bootstrap_counts, boost_first_split, tree_importance,
        point_forecast, recursive_forecast, requested_forecast, trend_series, formula_compare,
        tree_forecast, served_forecast,
        rf_scores, gbt_scores, ridge_scores, rf_score_counts, ridge_score_counts, slope_importance,
        document_models, document_importances, document_info, importance_rank, model_comparison,
        metrics_document, forecast_compare,
    )
}
