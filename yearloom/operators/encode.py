"""Sorted distinct labels and their integer codes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from yearloom.session import scratch_path


@dataclass(frozen=True)
class Vocabulary:
    """``table``: label, code."""

    table: DataFrame


def vocabulary(df: DataFrame, column: str) -> Vocabulary:
    """Distinct labels in sorted order, numbered from 0.

    The rank comes from a distributed sort: running numbers inside its partitions,
    stored so that they cannot change between their two uses, plus the sizes of
    earlier partitions.  No task holds the vocabulary, however large it is.
    """
    path = scratch_path(df.sparkSession, "labels")
    labels = df.select(F.col(column).alias("label")).dropna().distinct()
    labels.orderBy("label").withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
    part = F.shiftright("_id", 33).alias("_part")
    numbered = df.sparkSession.read.parquet(path).withColumn("_part", part)
    sizes = numbered.groupBy("_part").agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    codes = scratch_path(df.sparkSession, "codes")
    numbered.join(starts, "_part").select(
        "label", (F.col("_start") + inside).cast("int").alias("code")).write.parquet(codes)
    return stored_vocabulary(df.sparkSession, codes)


def encode(df: DataFrame, vocab: Vocabulary, column: str, output: str) -> DataFrame:
    """Append the code of ``column``; a label without code is an error.

    Whether the vocabulary is broadcast is decided by its size in bytes, as for any
    join; otherwise adaptive execution splits the rows of a frequent label.
    """
    table = vocab.table.select(F.col("label").alias(column), F.col("code").alias("_code"))
    unknown = F.raise_error(F.concat(F.lit(f"no code for {column}: "), F.col(column)))
    return df.join(table, column, "left").select(
        *df.columns, F.coalesce("_code", unknown.cast("int")).alias(output))


def stored_vocabulary(spark: SparkSession, path: str) -> Vocabulary:
    """A vocabulary table written earlier."""
    return Vocabulary(spark.read.parquet(path))
