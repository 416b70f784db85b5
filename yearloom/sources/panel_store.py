"""Reading and writing the core panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearloom.functions.columns import missing_to_null, to_number
from yearloom.session import discard, scratch_path
from yearloom.spec import IMPORTS, PANEL, RATIO, SUPPLY, PanelSpec

#: Different labels of the second key that a row group's Bloom filter is made for (some 60 kB).
LABELS_PER_GROUP = 50_000


def write_core(core: DataFrame, path: str, fmt: str = "parquet", spec: PanelSpec = PANEL) -> None:
    """Six columns in fixed order, every year kept, as a folder of part files.

    Parquet files hold ranges of the keys in order, so a lookup of one series skips
    all files and row groups but those of its range; Bloom filters of the second key do
    the same for a lookup by it alone.  The panel is computed once: rows are stored as
    they come, and their ranges are found on that table.
    """
    rows = core.select(*spec.core)
    if fmt == "csv":
        (
            rows.write.mode("overwrite").option("header", True).option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
        )
    elif fmt == "parquet":
        spark, first = core.sparkSession, scratch_path(core.sparkSession, "unordered")
        rows.write.parquet(first)
        ordered = spark.read.schema(rows.schema).parquet(first).repartitionByRange(*spec.keys).sortWithinPartitions(
            *spec.keys, spec.time)
        second = spec.keys[1]
        ordered.write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{second}", True).option(
            f"parquet.bloom.filter.expected.ndv#{second}", LABELS_PER_GROUP).parquet(path)
        discard(spark, first)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def read_core(
    spark: SparkSession, path: str, fmt: str = "parquet", spec: PanelSpec = PANEL, multiline: bool = False
) -> DataFrame:
    """The stored panel; ``multiline``: labels of a CSV form may hold line breaks."""
    texts, numbers = spec.keys, (IMPORTS, SUPPLY, RATIO)
    if fmt == "parquet":
        schema = ", ".join([*(f"`{c}` string" for c in texts), f"`{spec.time}` int", *(f"{c} double" for c in numbers)])
        return spark.read.schema(schema).parquet(path)
    if fmt != "csv":
        raise ValueError(f"unknown format {fmt!r}")
    raw = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline).csv(path)
    return raw.select(
        *[missing_to_null(F.col(f"`{c}`")).alias(c) for c in texts],
        F.col(f"`{spec.time}`").cast("int").alias(spec.time),
        *[to_number(F.col(c)).alias(c) for c in numbers],
    )


def read_series(core: DataFrame, area: str, item: str, spec: PanelSpec = PANEL) -> DataFrame:
    """One series in year order; both key predicates reach the Parquet scan."""
    first, second = spec.keys
    return core.where((F.col(first) == area) & (F.col(second) == item)).orderBy(spec.time)


def read_item(core: DataFrame, item: str, spec: PanelSpec = PANEL) -> DataFrame:
    """All series of one label of the second key; row groups whose Bloom filter lacks it are skipped."""
    return core.where(F.col(spec.keys[1]) == item)
