import math

import numpy as np
from helpers import CORE_SCHEMA, random_series, rows, wide
from pyspark.sql import functions as F

from yearloom.operators import profile, sketches, split
from yearloom.plans import training
from yearloom.session import scratch_path
from yearloom.spec import IMPORTS, RATIO



def panel(spark, seed=1, keys=60):
    years = range(1990, 1999)
    return training.core(wide(spark, random_series(seed, keys, years), years)).persist()


def test_measure_stats_match_numpy_on_both_paths(spark):
    core = panel(spark)
    data = core.toPandas()
    for small in (2_000_000, 50):
        for row in profile.measure_stats(core, small).collect():
            v = data[row["measure"]]
            assert np.allclose([row["mean"], row["median"], row["max"]],
                               [v.mean(), v.median(), v.max()], atol=1e-4)


def test_histogram_counts_and_edges(spark):
    core = panel(spark)
    total = core.count()
    for frame in (profile.histogram(core, RATIO), profile.winsor_histogram(core)):
        got = frame.orderBy("bin").collect()
        assert sum(r["row_count"] for r in got) == total
        assert got[-1]["bin"] == 49 and len(got) <= 50
        assert all(r["lo"] < r["hi"] for r in got)
    top = core.toPandas()[IMPORTS].quantile(0.95)
    assert math.isclose(max(r["hi"] for r in profile.winsor_histogram(core).collect()), top)


def test_histogram_of_a_constant_is_one_bin(spark):
    df = spark.createDataFrame([(3.0,), (3.0,), (None,)], "x double")
    assert rows(profile.histogram(df, "x")) == [(0, 3.0, 3.0, 2)]


def test_histogram_matches_numpy(spark):
    core = panel(spark, 5)
    counts, edges = np.histogram(core.toPandas()[IMPORTS], bins=50)
    got = {r["bin"]: r["row_count"] for r in profile.histogram(core, IMPORTS).collect()}
    assert sum(abs(got.get(i, 0) - c) for i, c in enumerate(counts)) <= 2  # rounding at edges


def test_history_tail_takes_latest_rows(spark):
    core = spark.createDataFrame(
        [("a", "i", 1990 + k, k + 0.125, 1.0, 2.345) for k in range(14)], CORE_SCHEMA)
    got = rows(profile.history_tail(core))
    assert [r[2] for r in got] == list(range(1994, 2004))
    assert got[0][3] == 4.12  # half to even


def test_stage_counts_and_info(spark):
    core = panel(spark)
    counts = {r["stage"]: (r["row_count"], r["column_count"]) for r in
              profile.stage_counts({"core": core, "areas": core.select("Area").distinct()}).collect()}
    assert counts["core"] == (core.count(), 6) and counts["areas"][1] == 1
    prepared = training.prepare(core)
    info = profile.dataset_info(core, split.assign_split(prepared.features)).first()
    assert info["total_rows"] - info["training_rows"] == info["lag_rows_dropped"]
    assert info["train_rows"] + info["test_rows"] == info["training_rows"]
    assert info["n_features"] == 10


def test_split_is_exact_stable_and_total(spark):
    core = panel(spark)
    n = core.count()
    first = split.assign_split(core)
    counts = dict(rows(split.split_counts(first)))
    assert counts == {"test": math.ceil(0.2 * n), "train": n - math.ceil(0.2 * n)}
    again = split.assign_split(core.repartition(9), gathered=30)
    assert rows(again) == rows(first)
    assert rows(split.assign_split(core, seed=7)) != rows(first)
    assert split.assign_split(core.limit(0)).count() == 0


def test_draws_tell_keys_apart(spark):
    df = spark.createDataFrame([("a|b", "c", 1), ("a", "b|c", 1)], "Area string, Item string, Year int")
    assert df.select(split.row_draw()).distinct().count() == 2


def jobs(spark, work):
    """The number of jobs that work starts."""
    context = spark.sparkContext
    group = f"jobs-{id(work)}"
    context.setJobGroup(group, "counted")
    try:
        work()
    finally:
        context._jsc.clearJobGroup()
    return len(context.statusTracker().getJobIdsForGroup(group))


def test_stages_are_counted_without_jobs_of_their_own(spark):
    core = panel(spark, 3)
    core.count()

    def plain():
        core.where("Year > 1991").groupBy("Area").count().write.format("noop").mode("overwrite").save()

    seen = profile.Watched()

    def watched():
        rows_ = seen.watch("late", seen.watch("core", core).where("Year > 1991"), first=F.min("Year"))
        seen.watch("areas", rows_.groupBy("Area").count()).write.format("noop").mode("overwrite").save()

    assert jobs(spark, watched) == jobs(spark, plain)
    assert [tuple(r) for r in seen.table(spark).collect()] == [
        ("core", core.count(), 6), ("late", core.where("Year > 1991").count(), 6), ("areas", 4, 2)]
    assert seen.values("late")["first"] == 1992


def test_observed_info_equals_the_counted_one(spark):
    years = range(1990, 1999)
    prepared = training.prepare_wide(wide(spark, random_series(4, 30, years), years))
    assigned = split.assign_split(prepared.features)
    seen = profile.Watched()
    for name, df, more in (("core", prepared.core, {"year_min": F.min("Year"), "year_max": F.max("Year")}),
                           ("split", assigned, {"train_rows": F.count_if(F.col("split") == "train")}),
                           ("areas", prepared.areas.table, {}), ("items", prepared.items.table, {})):
        seen.watch(name, df, **more).write.format("noop").mode("overwrite").save()
    observed = profile.observed_info(spark, *[seen.values(n) for n in ("core", "split", "areas", "items")])
    counted = profile.dataset_info(prepared.core, assigned)
    assert observed.columns == counted.columns and rows(observed) == rows(counted)


def test_merged_sketches_are_near_the_exact_profile(spark):
    n = 30_000
    core = spark.range(n).selectExpr(
        "concat('a', id % 7) as Area", "concat('i', id % 9000) as Item", "cast(1960 + id % 50 as int) as Year",
        "pow(id % 5003, 2) as Import_Quantity", "1.0D as Food_Supply", "cast(id % 200 as double) as Dependency_Pct")
    parts = sketches.area_sketches(core.where("Year % 2 = 0"))
    path = scratch_path(spark, "sketches")
    sketches.write_sketches(parts, path)
    sketches.write_sketches(sketches.area_sketches(core.where("Year % 2 = 1")), path, "append")
    stored = spark.read.parquet(path)
    whole = sketches.merged(stored)
    row = sketches.distinct_items(whole).first()
    assert (row.row_count, row.year_min, row.year_max) == (n, 1960, 2009)
    assert abs(row.n_items - 9000) <= sketches.DISTINCT_ERROR * 9000
    data = core.toPandas()
    for frame, area in ((whole, None), (sketches.merged(stored.where("Area = 'a3'"), "Area"), "a3")):
        own = data if area is None else data[data.Area == area]
        for r in sketches.quantiles(frame, [0.1, 0.5, 0.99]).collect():
            values = np.sort(own[r.measure].to_numpy())
            low, high = np.searchsorted(values, r.value), np.searchsorted(values, r.value, side="right")
            assert low / len(values) <= r.probability + sketches.RANK_ERROR and high / len(values) >= r.probability - sketches.RANK_ERROR
    assert sketches.merged(stored, "Area").count() == 7
