"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.llm import shared

#: Rounds after which a graph that still changes is an error; each round shortens paths to about a half.
MOST_ROUNDS = 60


def _round(edges: DataFrame) -> DataFrame:
    """A large and a small star on edges from larger nodes a to smaller ones b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    tied = edges.join(least.withColumnRenamed("a", "b"), "b", "left")
    large = tied.select("a", F.coalesce("m", "b").alias("b")).distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    below = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return below.unionByName(least.withColumnRenamed("m", "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with a link; the component is its smallest node.

    ``edges`` has columns a and b.  Each round is written to the shared folder, so a lost
    executor costs one round at most.  Links of a node to itself are left out; the result
    has no row for nodes without other links.
    """
    current = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    seen = None
    for _ in range(MOST_ROUNDS):
        current = shared.stored(_round(current), "components")
        state = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == seen:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
        if state[0] == 0:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = state
    raise RuntimeError("components did not settle")


def local_roots(size: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """For nodes 0 .. size - 1, the smallest node of each one's component under the links u - v."""
    label = np.arange(size)
    while len(u):
        least = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, u, least)
        np.minimum.at(label, v, least)
        label = label[label]
        if (label == before).all():
            break
    return label
