"""Panel tables derived from order data: traded quantity by nation, part and year.

An order line's return flag stands for the element, the customer's nation for the
area, the part's brand and type (or its key) for the item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yearloom.spec import ELEMENTS

OTHER_ELEMENT = "Production"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def years(spark: SparkSession, folder: str) -> list[int]:
    """All years with an order, whatever they are; one small row each."""
    found = table(spark, folder, "orders").select(F.year("o_orderdate").alias("y")).dropna().distinct()
    return sorted(r["y"] for r in found.collect())


def trade(spark: SparkSession, folder: str, item: str = "type", other: str = OTHER_ELEMENT) -> DataFrame:
    """Area, Item, Element, yr, l_linestatus, l_quantity: one row per order line.

    Only `nation` is marked for broadcast (25 rows by definition); for the other
    sides the session's size threshold and adaptive execution decide.
    """
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_returnflag", "l_linestatus"
    )
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", F.year("o_orderdate").alias("yr")
    )
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey"
    )
    nations = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("Area")
    )
    placed = orders.join(customers.join(F.broadcast(nations), "c_nationkey"), "o_custkey")
    flag = F.col("l_returnflag")
    rows = lines.join(placed, "l_orderkey")
    if item == "type":
        parts = table(spark, folder, "part").select(
            F.col("p_partkey").alias("l_partkey"),
            F.concat_ws("/", "p_brand", "p_type").alias("Item"),
        )
        rows = rows.join(parts, "l_partkey")
    else:
        rows = rows.withColumn("Item", F.concat(F.lit("part "), F.col("l_partkey")))
    return rows.select(
        "Area", "Item",
        F.when(flag == "N", ELEMENTS[0]).when(flag == "R", ELEMENTS[1])
        .otherwise(other).alias("Element"),
        "yr", "l_linestatus", "l_quantity",
    )


def wide(
    spark: SparkSession, folder: str, item: str = "type",
    signed: bool = False, repeated: bool = False, other: str = OTHER_ELEMENT,
) -> DataFrame:
    """The raw wide table: year columns plus flag columns that scans must skip.

    ``signed`` makes lines of status F negative; ``repeated`` gives every series
    one source row per line status, numbered by ``src_row``.  ``other`` names the
    third element.
    """
    lines = trade(spark, folder, item, other)
    found = years(spark, folder)
    quantity = F.col("l_quantity")
    if signed:
        quantity = F.when(F.col("l_linestatus") == "F", -quantity).otherwise(quantity)
    keys: list[Column | str] = ["Area", "Item", "Element"]
    if repeated:
        keys.append(F.when(F.col("l_linestatus") == "F", 0).otherwise(1).cast("long").alias("src_row"))
    return lines.groupBy(*keys).agg(
        *[F.sum(F.when(F.col("yr") == y, quantity)).alias(f"Y{y}") for y in found]
    ).select("*", *[F.lit("E").alias(f"Y{y}F") for y in found])


def text_values(spark: SparkSession, folder: str) -> DataFrame:
    """Quantities as text, by line number sometimes malformed."""
    q = F.col("l_quantity").cast("int").cast("string")
    n = F.col("l_linenumber")
    text = (
        F.when(n == 1, q)
        .when(n == 2, F.concat(F.lit(" "), q, F.lit(" ")))
        .when(n == 3, F.concat(q, F.lit("d")))
        .when(n == 4, F.concat(q, F.lit("e1")))
        .when(n == 5, F.concat(F.lit("1_"), q))
        .when(n == 6, F.concat(F.lit("+."), q))
        .otherwise("nan")
    )
    lines = table(spark, folder, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", text.alias("raw"))
