"""Scans of the raw wide table: one row per series, one column per year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yearloom.functions.columns import missing_to_null
from yearloom.spec import ELEMENTS, ORDINAL, PANEL, PanelSpec

ROWS_PER_BLOCK = 1 << 20
EXCESS = "_excess"
LINE = "_line"
REJECTED = "_rejected"
_ORDINAL_TYPE = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("block", T.LongType()), T.StructField("row", T.LongType())])


def year_columns(columns: list[str]) -> list[str]:
    """Names that start with Y and do not end in F (those hold flags)."""
    return [c for c in columns if c.startswith("Y") and not c.endswith("F")]


def _reader(spark: SparkSession, encoding: str, multiline: bool) -> DataFrameReader:
    return (
        spark.read.option("header", True).option("encoding", encoding)
        .option("quote", '"').option("escape", '"').option("multiLine", multiline)
    )


def _source_row() -> Column:
    return F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ).alias(ORDINAL)


def _texts(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in names])


def scan_wide_csv(
    spark: SparkSession, path: str, encoding: str = "ISO-8859-1", multiline: bool = False
) -> DataFrame:
    """All columns as text, missing tokens as NULL, plus ``src_row``.

    A row with fewer fields than the header ends in NULLs; one with more is an
    error, its values would be lost (`stage_wide_csv` sets such rows aside).

    ``src_row`` orders rows as they stand in the source whatever the packing of
    splits into tasks: file, start of the split, running number inside it.  The
    running number depends on split planning, so a job that needs the same
    numbers twice stores the scan first (`stage_wide`).
    """
    reader = _reader(spark, encoding, multiline)
    names = reader.csv(path).columns
    raw = reader.schema(_texts([*names, EXCESS])).csv(path)
    error = F.raise_error(F.concat(F.lit("a row has more fields than the header: "), F.col(EXCESS)))
    raw = raw.where(F.when(F.col(EXCESS).isNotNull(), error.cast("boolean")).otherwise(True))
    return raw.select(*[missing_to_null(F.col(f"`{c}`")).alias(c) for c in names], _source_row())


def stage_wide_csv(
    spark: SparkSession, source: str, path: str, encoding: str = "ISO-8859-1", multiline: bool = False
) -> tuple[DataFrame, DataFrame]:
    """`scan_wide_csv` stored at ``path`` in one pass, rows with too many fields set aside.

    Returns the good rows and the rejected ones (file, line): the text of each row that has
    more fields than the header, as it stands in the source.
    """
    reader = _reader(spark, encoding, multiline)
    names = reader.csv(source).columns
    raw = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE).schema(_texts([*names, LINE])).csv(source)
    # a line that does not have the header's number of fields is kept; only these are read a second time
    wider = ", ".join(f"`{c}` string" for c in [*names, EXCESS])
    again = F.from_csv(F.col(LINE), wider, {"quote": '"', "escape": '"', "multiLine": str(multiline).lower()})
    rejected = F.col(LINE).isNotNull() & again[EXCESS].isNotNull()
    raw.select(
        *[missing_to_null(F.col(f"`{c}`")).alias(c) for c in names], _source_row(),
        F.when(rejected, F.col(LINE)).alias(LINE), F.coalesce(rejected, F.lit(False)).alias(REJECTED),
    ).write.mode("overwrite").partitionBy(REJECTED).parquet(path)
    stored = spark.read.schema(T.StructType([
        *_texts(names).fields, T.StructField(ORDINAL, _ORDINAL_TYPE), T.StructField(LINE, T.StringType()),
        T.StructField(REJECTED, T.BooleanType())])).parquet(path)
    return (
        stored.where(~F.col(REJECTED)).drop(LINE, REJECTED),
        stored.where(F.col(REJECTED)).select(F.col(f"{ORDINAL}.file").alias("file"), F.col(LINE).alias("line")),
    )


def scan_wide_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A stored wide table; its file row numbers are stable by themselves."""
    raw = spark.read.parquet(path)
    if ORDINAL in raw.columns:
        return raw
    row = F.col("_metadata.row_index")
    return raw.select(
        "*",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.floor(row / ROWS_PER_BLOCK).alias("block"),
            row.alias("row"),
        ).alias(ORDINAL),
    )


def stage_wide(raw: DataFrame, path: str) -> DataFrame:
    """Store a text scan once as Parquet: fixes ``src_row``, parses no text twice."""
    raw.write.mode("overwrite").parquet(path)
    return raw.sparkSession.read.parquet(path)


def filter_elements(
    raw: DataFrame, spec: PanelSpec = PANEL, elements: tuple[str, ...] = ELEMENTS
) -> DataFrame:
    return raw.where(F.col(spec.kind).isin(*elements))


def select_years(raw: DataFrame, spec: PanelSpec = PANEL) -> DataFrame:
    """Series keys, ordinal where there is one, and the year columns."""
    extra = [] if spec.ordinal is None else [spec.ordinal]
    return raw.select(*spec.series, *extra, *year_columns(raw.columns))


def ordinal_block(df: DataFrame, ordinal: str):
    """The part of an ordinal shared by at most one split's worth of rows."""
    if isinstance(df.schema[ordinal].dataType, T.StructType):
        return F.struct(F.col(f"{ordinal}.file"), F.col(f"{ordinal}.block"))
    return F.floor(F.col(ordinal) / ROWS_PER_BLOCK)
