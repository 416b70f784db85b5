"""Sharding by proportional stratified interleaving, in DataFrame operations alone.

The rows of each source are put in a seeded random order; row ``k`` of ``n`` gets the
fraction ``(k - 1/2) / n``.  All rows sorted by that fraction form one sequence in which
every stretch has the mixture of the whole, and shards are equal cuts of it.

Ranks are found without a task that holds a source or the whole table: rows are dealt to
about sqrt(N) buckets by their random number (within a source) or their fraction (over
all), ranked in their bucket, and moved up by the rows of the buckets before it.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: 2**52: random numbers of so many bits are whole doubles.
_WIDTH = 1 << 52


def _offsets(rows: DataFrame, within: list[str], bucket: str, before: str, total: str | None = None) -> DataFrame:
    """For each bucket with rows: how many rows the earlier buckets have (and all of them)."""
    counts = rows.groupBy(*within, bucket).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*within).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    out = counts.withColumn(before, F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    if total:
        out = out.withColumn(total, F.sum("_n").over(Window.partitionBy(*within)))
    return out.drop("_n")


def interleave(docs: DataFrame, shards: int, seed: int = 42, source: str = "source") -> DataFrame:
    """Puts every row into one of ``shards`` shards.

    Returns doc_id, size (UTF-8 bytes + 1), text_crc32, law, shard, slot and grown_shard.
    The law is ``rows``: shards differ by one row at most.  Slots of a shard run from 0
    without gaps, in the order of the fractions.

    Null sources are a stratum of their own, apart from the empty name; null texts count
    as empty; repeated rows are rows of their own and may part; an empty table gives an
    empty result.  Other columns are not read.
    """
    count = docs.count()
    buckets = max(1, math.isqrt(count))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = docs.select(
        F.col("doc_id"),
        F.when(F.col(source).isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col(source))).alias("_stratum"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("long").alias("_draw"),
    ).withColumn("_bucket", F.floor(F.col("_draw") / F.lit(float(_WIDTH)) * buckets))
    place = Window.partitionBy("_stratum", "_bucket").orderBy("_draw", "doc_id", "text_crc32")
    ranked = (
        rows.withColumn("_place", F.row_number().over(place))
        .join(_offsets(rows, ["_stratum"], "_bucket", "_before", "_total"), ["_stratum", "_bucket"])
        .withColumn("_fraction", (F.col("_before") + F.col("_place") - 0.5) / F.col("_total"))
        .withColumn("_cut", F.floor(F.col("_fraction") * buckets))
        .drop("_place", "_before", "_total", "_bucket")
    )
    place = Window.partitionBy("_cut").orderBy("_fraction", "_stratum", "_draw", "doc_id", "text_crc32")
    rank = (F.col("_before") + F.col("_place") - 1).alias("_rank")
    ordered = (
        ranked.withColumn("_place", F.row_number().over(place))
        .join(_offsets(ranked, [], "_cut", "_before"), "_cut")
        .select("doc_id", "size", "text_crc32", rank)
    )
    total = max(count, 1)
    shard = F.expr(f"(_rank * {shards}L) div {total}L")
    first = F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")
    return ordered.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("_rank") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
