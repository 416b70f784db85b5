import json
import os

import pytest
from helpers import IMPORT, SUPPLY, random_series, rows, wide
from pyspark.sql import functions as F

from yearloom.operators import impute, reshape
from yearloom.plans import training
from yearloom.session import cut_lineage, scratch_path, shared_folder
from yearloom.sources import panel_store
from yearloom.sources import wide as wide_scan
from yearloom.spec import PANEL, PanelSpec

REPEATED = PanelSpec(ordinal="src_row")


def write(path, text):
    path.write_bytes(text.encode("latin1"))
    return str(path)


def test_csv_scan_reads_latin1_and_missing_tokens(spark, tmp_path):
    path = write(tmp_path / "raw.csv", (
        "Area Code,Area,Item,Element,Unit,Y1961F,Y1961,Y1962F,Y1962\n"
        "1,Côte d'Ivoire,\"Rice, milled\",Import Quantity,t,E,1,E,NA\n"
        "2,NA,Maize,Import Quantity,t,E,1,E,2\n"
        "3,Namibia,\"say \"\"x\"\"\",Food supply quantity (kg/capita/yr),t,E,,E,3\n"
        "4,Namibia,Maize,Production,t,E,1,E,2\n"
    ))
    raw = wide_scan.scan_wide_csv(spark, path)
    kept = wide_scan.select_years(wide_scan.filter_elements(raw, REPEATED), REPEATED)
    assert kept.columns == ["Area", "Item", "Element", "src_row", "Y1961", "Y1962"]
    got = [tuple(r)[:3] + tuple(r)[4:] for r in kept.orderBy("src_row").collect()]
    assert got == [
        ("Côte d'Ivoire", "Rice, milled", IMPORT, "1", None),
        (None, "Maize", IMPORT, "1", "2"),
        ("Namibia", 'say "x"', SUPPLY, None, "3"),
    ]
    long = impute.interpolate_linear(reshape.unpivot_years(kept, REPEATED), REPEATED)
    assert long.where("Area is null").count() == 0
    assert rows(long.where("Area like 'C%'").select("Year", "Value")) == [(1961, 1.0), (1962, 1.0)]


def test_source_rows_keep_file_order_over_many_splits(spark, tmp_path):
    for part in range(3):
        lines = "".join(f"a,i,{IMPORT},{part * 1000 + k}\n" for k in range(1000 - 300 * part))
        write(tmp_path / f"part-{part}.csv", "Area,Item,Element,Y1961\n" + lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
        raw = wide_scan.scan_wide_csv(spark, str(tmp_path))
        assert raw.rdd.getNumPartitions() > 5
        stored = wide_scan.stage_wide(raw, scratch_path(spark, "wide"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    values = [int(r["Y1961"]) for r in stored.orderBy("src_row").collect()]
    assert values == sorted(values) and len(values) == 2100


def test_whole_run_from_csv_equals_typed_input(spark, tmp_path):
    years = list(range(1990, 1996))
    found = random_series(31, 25, years, max_repeats=2)
    def text(v):
        return "" if v is None else str(v)
    lines = [",".join([a, i, f'"{e}"', *map(text, vs)]) for a, i, e, vs, _ in found]
    path = write(tmp_path / "raw.csv", "\n".join([",".join(["Area", "Item", "Element", *[f"Y{y}" for y in years]]), *lines]))
    typed = wide(spark, [(*s[:4], n) for n, s in enumerate(found)], years, ordinal=True)
    want = rows(training.core(typed, REPEATED))
    raw = wide_scan.scan_wide_csv(spark, path)
    assert rows(training.core(raw, REPEATED)) == want
    stored = scratch_path(spark, "wide")
    typed.drop("src_row").coalesce(1).write.parquet(stored)
    scanned = wide_scan.scan_wide_parquet(spark, stored)
    assert scanned.schema["src_row"].dataType.names == ["file", "block", "row"]
    assert training.core(scanned, REPEATED).count() == len(want)


def test_rows_with_too_many_fields_are_an_error(spark, tmp_path):
    path = write(tmp_path / "raw.csv", "Area,Item,Element,Y1,Y2\na,i,Import Quantity,1,2,3\nb,i,Import Quantity,1\n")
    with pytest.raises(Exception, match="more fields than the header: 3"):
        wide_scan.scan_wide_csv(spark, path).collect()
    short = write(tmp_path / "short.csv", "Area,Item,Element,Y1,Y2\nb,i,Import Quantity,1\n")
    assert [(r["Y1"], r["Y2"]) for r in wide_scan.scan_wide_csv(spark, short).collect()] == [("1", None)]


def test_rows_with_too_many_fields_are_set_aside(spark, tmp_path):
    write(tmp_path / "a.csv", 'Area,Item,Element,Y1,Y2\na,i,e,1,2,3\nb,"x, ""y""",e,1\n"Côte, Q",i,e,1,2,3,4,5\nc,i,e,NA,2\n')
    write(tmp_path / "b.csv", 'Area,Item,Element,Y1,Y2\nd,"i\nj",e,1,2\nf,"q,r\n",e,1,2,"9"\n')
    kept, rejected = wide_scan.stage_wide_csv(spark, str(tmp_path), scratch_path(spark, "staged"), multiline=True)
    assert kept.columns == ["Area", "Item", "Element", "Y1", "Y2", "src_row"]
    assert sorted(tuple(r)[:5] for r in kept.collect()) == [
        ("b", 'x, "y"', "e", "1", None), ("c", "i", "e", None, "2"), ("d", "i\nj", "e", "1", "2")]
    assert sorted((os.path.basename(r.file), r.line) for r in rejected.collect()) == [
        ("a.csv", '"Côte, Q",i,e,1,2,3,4,5'), ("a.csv", "a,i,e,1,2,3"), ("b.csv", 'f,"q,r\n",e,1,2,"9"')]
    clean, none = wide_scan.stage_wide_csv(spark, write(tmp_path / "c.csv", "Area,Y1\na,1\n"), scratch_path(spark, "staged"))
    assert clean.count() == 1 and none.count() == 0


def test_csv_panel_keeps_every_label(spark):
    labels = ['12" pipe, steel', " b", "x ", "back\\slash", 'say "hi"', "c,d", "\ttab", "semi;colon", "two\nlines", "Côte"]
    core = spark.createDataFrame([(a, "i", 1, 1.5, 2.0, 75.0) for a in labels],
                                 "Area string, Item string, Year int, Import_Quantity double, Food_Supply double, Dependency_Pct double")
    path = scratch_path(spark, "csv")
    panel_store.write_core(core, path, "csv")
    assert rows(panel_store.read_core(spark, path, "csv", multiline=True)) == rows(core)


def test_years_come_from_the_data(spark, tmp_path):
    from datetime import datetime

    from yearloom.sources import derived

    folder = "/root/testdata/sf0.001"
    for name in ("lineitem", "orders", "customer", "nation", "part"):
        frame = spark.read.parquet(f"{folder}/{name}.parquet")
        if name == "orders":
            first = frame.agg({"o_orderkey": "min"}).first()[0]
            frame = frame.withColumn("o_orderdate", F.when(F.col("o_orderkey") == first, F.lit(datetime(1990, 5, 1))).otherwise(F.col("o_orderdate")))
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    years = derived.years(spark, str(tmp_path))
    assert years[0] == 1990 and "Y1990" in derived.wide(spark, str(tmp_path)).columns
    assert derived.years(spark, folder)[0] > 1990


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_core_panel_roundtrip(spark, fmt):
    years = range(1990, 1996)
    core = training.core(wide(spark, random_series(2, 20, years), years))
    path = scratch_path(spark, "core")
    panel_store.write_core(core, path, fmt)
    back = panel_store.read_core(spark, path, fmt)
    assert back.columns == PANEL.core
    assert rows(back) == rows(core)
    one = back.first()
    series = panel_store.read_series(back, one["Area"], one["Item"]).collect()
    assert [r["Year"] for r in series] == sorted(r["Year"] for r in series) and series


def test_series_lookup_is_pushed_to_the_scan(spark):
    years = range(1990, 1996)
    path = scratch_path(spark, "core")
    panel_store.write_core(training.core(wide(spark, random_series(2, 5, years), years)), path)
    plan = panel_store.read_series(panel_store.read_core(spark, path), "a1", "i1")._jdf.queryExecution().toString()
    assert "EqualTo(Area,a1)" in plan and "EqualTo(Item,i1)" in plan


def scanned_rows(df):
    """Rows that the scan of a query hands on."""
    import re

    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        text = node.nodeName()
        if re.match("Scan|FileScan", text) and node.metrics().contains("numOutputRows"):
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan)
    return sum(found)


def test_lookup_by_item_alone_skips_row_groups(spark):
    """Items alternate through every file; only the Bloom filters can tell the row groups apart."""
    core = spark.range(40_000).selectExpr(
        "concat('a', id % 40) as Area", "concat('item ', id) as Item", "1990 as Year",
        "1.0D as Import_Quantity", "2.0D as Food_Supply", "50.0D as Dependency_Pct")
    path = scratch_path(spark, "core")
    saved = {k: spark.conf.get(k, None) for k in ("parquet.block.size", "parquet.enable.dictionary")}
    try:
        spark.conf.set("parquet.block.size", "50000")
        spark.conf.set("parquet.enable.dictionary", "false")
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        hadoop.set("parquet.block.size", "50000")
        hadoop.set("parquet.enable.dictionary", "false")
        hadoop.set("parquet.page.size.row.check.min", "100")
        hadoop.set("parquet.block.size.row.check.min", "100")
        panel_store.write_core(core, path)
        plain = scratch_path(spark, "plain")
        spark.read.parquet(path).write.parquet(plain)
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        for k in ("parquet.block.size", "parquet.enable.dictionary", "parquet.page.size.row.check.min", "parquet.block.size.row.check.min"):
            hadoop.unset(k)
    wanted = panel_store.read_item(panel_store.read_core(spark, path), "item 777")
    assert wanted.count() == 1
    filtered, whole = scanned_rows(wanted), scanned_rows(panel_store.read_item(panel_store.read_core(spark, plain), "item 777"))
    assert filtered < 0.3 * whole


def test_the_panel_is_computed_once(spark):
    """Finding the ranges of the keys must not run the plan a second time."""
    count = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            count.add(batch.num_rows)
            yield batch

    core = spark.range(5_000).selectExpr(
        "concat('a', id % 40) as Area", "concat('i', id) as Item", "1990 as Year",
        "1.0D as Import_Quantity", "2.0D as Food_Supply", "50.0D as Dependency_Pct")
    path = scratch_path(spark, "core")
    panel_store.write_core(core.mapInArrow(passed, core.schema), path)
    assert count.value == 5_000 and panel_store.read_core(spark, path).count() == 5_000


def test_tables_of_a_run_are_gone_at_its_end(spark):
    from yearloom.session import run_folder

    with run_folder(spark) as folder:
        path = scratch_path(spark, "t")
        assert os.path.dirname(path) == folder
        spark.range(3).write.parquet(path)
        assert os.path.isdir(path)
        with run_folder(spark) as inner:
            assert os.path.dirname(scratch_path(spark, "t")) == inner
        assert os.path.dirname(scratch_path(spark, "t")) == folder
    assert not os.path.exists(folder)
    assert os.path.dirname(scratch_path(spark, "t")) == shared_folder(spark)


def test_unknown_format_is_an_error(spark):
    with pytest.raises(ValueError):
        panel_store.read_core(spark, "x", "xls")


def test_checkpoints_go_to_the_named_folder(spark):
    folder = shared_folder(spark)
    assert shared_folder(spark) == folder
    assert cut_lineage(spark.range(5).withColumn("x", F.col("id") + 1)).count() == 5
    assert os.path.dirname(scratch_path(spark, "t")) == folder


def test_metrics_document_is_plain_json(spark):
    from yearloom.operators import evaluate
    from yearloom.sources import metrics_store

    info = spark.createDataFrame(
        [(9, 5, 4, 1, 2, 3, 1990, 1999, 10, 4)],
        "total_rows bigint, training_rows bigint, train_rows bigint, test_rows bigint, n_countries bigint, "
        "n_items bigint, year_min int, year_max int, n_features bigint, lag_rows_dropped bigint")
    metrics = spark.createDataFrame(
        [("rf_import", "import", 0, 0.9, 0.8, 1.0, 2.0, 3.0, 0.5), ("rf_dep", "dep", 1, 0.7, 0.6, 1.0, 2.0, None, 0.5)],
        "model string, target string, position int, r2_train double, r2_test double, mae double, rmse double, "
        "mape double, train_time_sec double")
    weights = spark.createDataFrame(
        [(m, f, w) for m in ("rf_import", "rf_dep") for f, w in (("Year", 0.25), ("Import_Lag1", 0.75))],
        "model string, feature string, importance double")
    path = scratch_path(spark, "metrics")
    metrics_store.write_metrics(path, info, metrics, weights, evaluate.best_model(metrics))
    text = "".join(r["value"] for r in spark.read.text(path).collect())
    document = json.loads(text)
    assert document["best_model"] == {"import_quantity": "rf_import", "dependency_pct": "rf_dep"}
    assert document["models"]["rf_import"]["feature_importance"] == {"Year": 0.25, "Import_Lag1": 0.75}
    assert document["hyperparameters"]["ridge"] == {"alpha": 1.0}
    assert document["dataset_info"]["features"][0] == "Area_enc"
    back = metrics_store.read_metrics(spark, path)
    assert rows(metrics_store.model_rows(back)) == rows(metrics.drop("position"))
    assert [r["feature"] for r in metrics_store.importance_rows(back).collect()] == ["Import_Lag1", "Year"] * 2
    assert metrics_store.hyperparameter_rows(back).count() == 11
