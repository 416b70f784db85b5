"""Near-duplicate vectors by tiles: leading principal coordinates first, the rest bounded by norms.

Unit vectors are turned so that their coordinates come in order of variance and dealt by
the first one into tiles, which are files in the shared folder.  Two tiles are compared
coordinate block by coordinate block: the products of the coordinates not yet seen are at
most the product of the two rests' norms, so pairs that cannot reach the threshold any more
are left.  Tiles whose first coordinates lie too far apart are not compared at all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.llm import shared
from yearloom.llm.components import components, local_roots

#: Vectors of a tile.
TILE = 512

#: Vectors the turn is fitted to; any turn gives the same links, a fitted one leaves pairs sooner.
FITTED = 5_000

#: Shares of the coordinates after which pairs are left.
STEPS = (0.375, 0.625)

#: Shares of a tile's pairs up to which pairs go on one by one.
SPARSE = 0.02

#: Room for rounding in the bounds; links are decided by the whole product alone.
SLACK = 1e-9


def valid(embedding: str = "embedding"):
    """Vectors with components, none null or not finite, and not all zero."""
    finite = F.forall(embedding, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def units(matrix: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so squares neither overflow nor vanish."""
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def turn(sample: list[list[float]]) -> np.ndarray:
    """An orthogonal matrix whose columns are the principal axes, largest variance first."""
    rows = units(np.array(sample, dtype=np.float64))
    _, axes = np.linalg.eigh(rows.T @ rows)
    return axes[:, ::-1]


def rows_of(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def near_pairs(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of rows of turned unit vectors with cosine of at least ``threshold``."""
    size = a.shape[1]
    cuts = [0, *(max(1, int(size * s)) for s in STEPS), size]
    products = np.zeros((len(a), len(b)))
    left = None
    for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
        rest_a, rest_b = np.linalg.norm(a[:, stop:], axis=1), np.linalg.norm(b[:, stop:], axis=1)
        if left is None:
            products += a[:, start:stop] @ b[:, start:stop].T
            if stop == size:
                return np.nonzero(products >= threshold)
            bound = threshold - SLACK - rest_a * rest_b.max()
            u, v = np.nonzero(products >= bound[:, None])
            keep = products[u, v] + rest_a[u] * rest_b[v] >= threshold - SLACK
            if keep.sum() <= SPARSE * products.size:
                left = u[keep], v[keep], products[u[keep], v[keep]]
        else:
            u, v, sums = left
            sums = sums + np.einsum("ij,ij->i", a[u, start:stop], b[v, start:stop])
            least = threshold if stop == size else threshold - SLACK
            keep = sums + rest_a[u] * rest_b[v] >= least
            left = u[keep], v[keep], sums[keep]
    return left[0], left[1]


def near_duplicates(vectors: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Links vectors with cosine of at least ``threshold``; one row per vector.

    Returns vec_id, n_links, component_id (the smallest vec_id reachable) and kept.  Vectors
    that are null, empty, zero or hold null or non-finite components link with nothing, nor
    do vectors of different lengths; a row without vec_id stays as it is, alone.  Rows that
    repeat a vec_id and its vector are one vector.  Different vectors of one vec_id are
    vectors of their own, each with its links, and share their component.  An empty table
    gives an empty result; other columns are not read.
    """
    spark = vectors.sparkSession
    single = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").distinct()
    single = shared.stored(single.withColumn("number", F.monotonically_increasing_id()), "vectors")
    usable = single.where(valid() & F.col("vec_id").isNotNull())
    links = shared.stored(_links(spark, usable, threshold), "vector-links")
    degrees = links.groupBy("number").agg(F.sum("links").alias("n_links"))
    joined = components(links.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    component = F.coalesce("component", "vec_id")
    return (
        single.select("vec_id", "number").join(degrees, "number", "left")
        .join(joined.withColumnRenamed("node", "vec_id"), "vec_id", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
    )


class Tiles:
    """The list of tiles by length and first coordinate, in a file that tasks map: name, size, rows, low, high."""

    def __init__(self, address: str):
        names, sizes, rows, low, high = shared.read_array(address, np.float64).reshape(5, -1)
        self.name, self.size, self.rows = names.astype(np.int64), sizes.astype(np.int64), rows.astype(np.int64)
        self.low, self.high = low, high

    def reached(self, i: int, reach: float) -> int:
        """After the last tile that lies within ``reach`` of tile i, of those from i on."""
        stop = int(np.searchsorted(self.size, self.size[i], side="right"))
        return i + int(np.searchsorted(self.low[i:stop], self.high[i] + reach, side="right"))


def _links(spark, usable: DataFrame, threshold: float) -> DataFrame:
    """(number, vec_id, links, root): partial counts of links and ties to the smallest vec_id found with it."""
    schema = "number long, vec_id long, links long, root long"
    sizes = {r[0]: r[1] for r in usable.groupBy(F.size("embedding")).count().collect()}
    if not sizes:
        return spark.createDataFrame([], schema)
    axes = {size: turn([r[0] for r in usable.where(F.size("embedding") == size).orderBy(F.xxhash64("vec_id")).limit(FITTED)
                        .select("embedding").collect()]) for size in sizes}
    shared_axes = spark.sparkContext.broadcast(axes)
    folder = shared.folder(spark, "vector-tiles")

    def first_coordinate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.diff(batch.column("embedding").offsets.to_numpy())
            for size in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == size))
                turned = units(rows_of(part.column("embedding"), size)) @ shared_axes.value[size][:, 0]
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), part.column("number"), part.column("embedding").cast(pa.list_(pa.float64())),
                     pa.array(np.full(len(turned), size, np.int32)), pa.array(turned)],
                    names=["vec_id", "number", "embedding", "size", "first"])

    def write_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, number = TaskContext.get().partitionId(), {}, 0

        def flush(size: int) -> pa.RecordBatch:
            ids, numbers, rows = (np.concatenate([x[k] for x in held[size]]) for k in range(3))
            turned = units(rows) @ shared_axes.value[size]
            order = np.lexsort((numbers, ids))
            name = part << 20 | number
            shared.write_file(f"{folder}/tile-{name}", [ids[order].astype("<i8"), numbers[order].astype("<i8"), turned[order].astype("<f8")])
            held[size] = []
            return pa.RecordBatch.from_pydict(
                {"name": [name], "size": pa.array([size], pa.int32()), "n": [len(ids)], "low": [turned[:, 0].min()], "high": [turned[:, 0].max()]})

        for batch in batches:
            lengths = batch.column("size").to_numpy()
            for size in np.unique(lengths).tolist():
                rows = batch.filter(pa.array(lengths == size))
                for at in range(0, rows.num_rows, TILE):
                    cut = rows.slice(at, TILE)
                    held.setdefault(size, []).append(
                        (cut.column("vec_id").to_numpy(), cut.column("number").to_numpy(), rows_of(cut.column("embedding"), size)))
                    if sum(len(x[0]) for x in held[size]) >= TILE:
                        yield flush(size)
                        number += 1
        for size in [s for s in held if held[s]]:
            yield flush(size)
            number += 1

    def list_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = [np.concatenate(c) for c in zip(*([b.column(c).to_numpy().astype(np.float64) for c in ("name", "size", "n", "low", "high")]
                                                    for b in batches), strict=True)]
        shared.write_array(f"{folder}/tiles", np.stack(columns))
        yield pa.RecordBatch.from_pydict({"n": [len(columns[0])]})

    tiles = shared.stored(
        usable.select("vec_id", "number", "embedding")
        .mapInArrow(first_coordinate, "vec_id long, number long, embedding array<double>, size int, first double")
        .repartitionByRange(max(1, -(-sum(sizes.values()) // TILE)), "size", "first", F.xxhash64("number"))
        .mapInArrow(write_tiles, "name long, size int, n long, low double, high double"), "tiles")
    total = tiles.repartition(1).sortWithinPartitions("size", "low", "name").mapInArrow(list_tiles, "n long").first()[0]
    reach = math.sqrt(max(0.0, 2.0 - 2.0 * threshold)) + SLACK

    def load(every: Tiles, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raw, n = shared.read_array(f"{folder}/tile-{every.name[i]}", np.uint8), int(every.rows[i])
        return raw[:8 * n].view("<i8"), raw[8 * n:16 * n].view("<i8"), raw[16 * n:].view("<f8").reshape(n, int(every.size[i]))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = Tiles(f"{folder}/tiles")
        for batch in batches:
            for i in batch.column("id").to_pylist():
                ids, numbers, a = load(every, i)
                for j in range(i, every.reached(i, reach)):  # each pair of tiles once
                    other_ids, other_numbers, b = load(every, j)
                    u, v = near_pairs(a, b, threshold)
                    if j == i:
                        u, v = u[u < v], v[u < v]
                        other_ids, other_numbers = ids[:0], numbers[:0]
                    if len(u):
                        yield found(np.concatenate([ids, other_ids]), np.concatenate([numbers, other_numbers]),
                                    u, v + (len(ids) if j > i else 0))

    def found(every: np.ndarray, numbers: np.ndarray, u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(every, kind="stable")
        place = np.empty(len(every), np.int64)
        place[order] = np.arange(len(every))
        roots = order[local_roots(len(every), place[u], place[v])][place]
        links = np.bincount(u, minlength=len(every)) + np.bincount(v, minlength=len(every))
        some = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays(
            [pa.array(numbers[some]), pa.array(every[some]), pa.array(links[some]), pa.array(every[roots[some]])],
            names=["number", "vec_id", "links", "root"])

    return spark.range(0, total, 1, total).mapInArrow(compare, schema)
