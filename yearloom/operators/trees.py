"""Regression trees by histograms: second-order boosting and bagged forests.

Features are cut into bins once.  A tree grows level by level: one aggregate sums, per node,
feature and bin, what the rows ask for; the best cut of each node follows from these sums
alone, so the driver holds nodes x bins however many rows there are.  Nodes with at most
`LOCAL_ROWS` rows are finished where these are gathered, a task each; a table of no more rows,
by then some 30 bytes each, is sent to all tasks, and each grows trees from it.  Sums are whole
numbers (values in fixed point), draws come from the rows' keys: any partitioning, and any of
these ways, gives the same trees.
"""

from __future__ import annotations

import math
import random
import sys
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yearloom.session import discard, scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of the library

BINS = 256
#: Significant bits, after the first, of the values among which cuts are chosen.
CUT_BITS = 12
#: Rows that one task may hold.
LOCAL_ROWS = 1 << 20
#: Trees of a forest grown together; their histograms meet on the driver, nodes x bins of each.
TREES_TOGETHER = 16
#: Prime modulus of the draws.
MODULUS = 2**31 - 1
#: Splits of a model up to which it is compiled to conditions.
COMPILED_SPLITS = 500
#: Chances that a row is drawn at most 0, 1, 2, .. times as often as on average once.
POISSON = [math.exp(-1) * sum(1 / math.factorial(j) for j in range(k + 1)) for k in range(9)]
MOST_WEIGHT = len(POISSON)

NODE_SCHEMA = ("tree int, node int, feature string, threshold double, gain double, cover double, value double")


# --- bins ------------------------------------------------------------------------

def coarse(value: Column) -> Column:
    """The value rounded down to 1 + `CUT_BITS` significant bits: a grid on which few numbers occur."""
    size = F.abs(value)
    guess = F.floor(F.log2(size)).cast("double")
    two = F.lit(2.0)
    exponent = guess + F.when(size >= F.pow(two, guess + 1), 1.0).when(size < F.pow(two, guess), -1.0).otherwise(0.0)
    scale = F.pow(two, F.lit(float(CUT_BITS)) - exponent)
    return F.when(size < 1e-290, 0.0).otherwise(F.try_divide(F.floor(value * scale).cast("double"), scale))


def bin_edges(train: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Per feature, ascending values that cut its rows into at most ``bins`` parts of like size.

    Cuts are grid values (`coarse`), counted exactly in one aggregate; up to ``bins`` different
    ones are all cuts.  Their number does not grow with the rows but with the range: 4,096 a
    factor of two.
    """
    cells = train.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("f"), coarse(F.col(c).cast("double")).alias("cell")) for i, c in enumerate(features)
    ])).alias("v")).groupBy("v.f", "v.cell").agg(F.count("*").alias("n")).toArrow()
    feature, cell, n = (cells.column(c).to_numpy() for c in ("f", "cell", "n"))
    edges = []
    for i in range(len(features)):
        own = feature == i
        order = np.argsort(cell[own])
        values, counts = cell[own][order], n[own][order]
        if len(values) > bins:
            before = np.cumsum(counts) - counts
            part = before * bins // counts.sum()
            edges.append(values[1:][part[1:] > part[:-1]])
        else:
            edges.append(values[1:])
    return edges


def binned(rows: DataFrame, features: Sequence[str], edges: list[np.ndarray]) -> DataFrame:
    """The rows with ``bins``: per feature the number of edges at most as large, less 128 (one byte)."""
    named = [f"_x{i}" for i in range(len(features))]
    frame = rows.withColumns({x: F.col(c).cast("double") for x, c in zip(named, features, strict=True)})
    cut = [i for i, e in enumerate(edges) if len(e)]
    if cut:
        splits = [[-math.inf, *edges[i].tolist(), math.inf] for i in cut]
        frame = Bucketizer(splitsArray=splits, inputCols=[named[i] for i in cut], outputCols=[f"_b{i}" for i in cut]).transform(frame)
    places = [F.col(f"_b{i}") if i in cut else F.lit(0.0) for i in range(len(features))]
    bins = F.array(*[(p - 128).cast("tinyint") for p in places]).alias("bins")
    return frame.select(*rows.columns, bins)


# --- draws -----------------------------------------------------------------------

def factor(*of) -> int:
    """A multiplier of its own for each use of a row's draw."""
    return random.Random(":".join(map(str, of))).randrange(1, MODULUS)


def share(draw, multiplier):
    """A number from 0 to below 1 for each row and multiplier, of columns as of arrays; ``draw`` is below `MODULUS`."""
    return (draw * multiplier) % MODULUS / float(MODULUS)


def bootstrapped(rows: DataFrame, seed: int, trees: Sequence[int]) -> DataFrame:
    """The rows of each tree: tree as ``i`` (its place in ``trees``) and weight, how often the row is
    drawn for it, a Poisson quantile of its share; rows that are not drawn are left out."""
    own = share(F.col("draw"), F.get(F.lit([factor("tree", seed, t) for t in trees]), F.col("i")))
    weight = sum(((own >= F.lit(p)).cast("int") for p in POISSON[1:]), (own >= F.lit(POISSON[0])).cast("int"))
    drawn = rows.select("*", F.explode(F.lit(list(range(len(trees))))).alias("i")).withColumn("weight", weight)
    return drawn.where("weight > 0")


def fixed_bits(rows: int, largest: float) -> int:
    """Binary places of fixed-point values: sums over all rows fit 62 bits, over `LOCAL_ROWS` 53.

    Values may be twice ``largest`` and have weights up to `MOST_WEIGHT`.
    """
    return min(28, 57 - rows.bit_length()) - int(largest).bit_length()


def fixed(value: Column, bits: int) -> Column:
    return F.rint(value * F.lit(2.0**bits)).cast("long")


# --- growing ---------------------------------------------------------------------

@dataclass(frozen=True)
class Growth:
    """How trees grow: ``penalty`` on squared leaf values, fewest rows of a leaf, least gain of a split."""

    depth: int
    penalty: float
    least_rows: int
    least_gain: float
    bits: int


class Tree:
    """Nodes by number: the root is 1, the children of i are 2i and 2i + 1; feature -1 is a leaf."""

    def __init__(self, depth: int):
        size = 2 ** (depth + 1)
        self.feature, self.cut = np.full(size, -1, np.int64), np.zeros(size, np.int64)
        self.gain, self.wanted, self.weight = np.zeros(size), np.zeros(size), np.zeros(size)
        self.rows = np.zeros(size, np.int64)

    def values(self, growth: Growth, rate: float) -> np.ndarray:
        """What each node adds to a prediction, in the label's unit."""
        found = np.zeros(len(self.wanted))
        np.divide(self.wanted, self.weight + growth.penalty, out=found, where=self.rows > 0)
        return rate * (found / 2.0**growth.bits)

    def split(self, node: int, feature: int, cut: int, gain: float, left: tuple, whole: tuple) -> None:
        self.feature[node], self.cut[node], self.gain[node] = feature, cut, gain
        for child, sums in ((node, whole), (2 * node, left), (2 * node + 1, tuple(w - part for w, part in zip(whole, left, strict=True)))):
            self.wanted[child], self.weight[child], self.rows[child] = sums


def best_splits(wanted: np.ndarray, weight: np.ndarray, rows: np.ndarray, growth: Growth):
    """Best cut of each node from sums, nodes x features x bins: feature, cut, gain, sums left and in all.

    Of equal gains the first feature's smallest cut counts; a gain of -inf stands for none.
    Rows up to the cut's bin go left.
    """
    sums = [np.cumsum(x, axis=2) for x in (wanted, weight, rows)]
    whole = [s[:, :1, -1:] for s in sums]
    left = [s[:, :, :-1] for s in sums]
    with np.errstate(divide="ignore", invalid="ignore"):
        def score(s, w):
            return s * s / (w + growth.penalty)

        gain = score(left[0], left[1]) + score(whole[0] - left[0], whole[1] - left[1]) - score(whole[0], whole[1])
    gain[(left[2] < growth.least_rows) | (whole[2] - left[2] < growth.least_rows)] = -np.inf
    flat = gain.reshape(len(gain), -1)
    at = np.nanargmax(np.where(np.isnan(flat), -np.inf, flat), axis=1)
    feature, cut = np.divmod(at, gain.shape[2])
    own = np.arange(len(gain))
    best = flat[own, at] / 4.0**growth.bits
    best = np.where(best > growth.least_gain, best, -np.inf)
    return feature, cut, best, [x[own, feature, cut] for x in left], [x[:, 0, 0] for x in whole]


def grow_here(bins: np.ndarray, wanted: np.ndarray, weight: np.ndarray, features: np.ndarray, levels: int, growth: Growth) -> Tree:
    """A whole (sub)tree of ``levels`` levels from rows at hand; ``bins`` is rows x all features, from 0."""
    tree = Tree(levels)
    tree.wanted[1], tree.weight[1], tree.rows[1] = wanted.sum(), weight.sum(), len(wanted)
    node = np.ones(len(wanted), np.int64)
    for level in range(levels):
        open_, own = np.unique(node, return_inverse=True)
        if not len(open_):
            break
        shape = (len(open_), len(features), BINS)
        sums = [np.zeros(shape) for _ in range(3)]
        own_cells = own * BINS
        for k, f in enumerate(features):
            at = own_cells + bins[:, f]
            for total, values in zip(sums, (wanted, weight, None), strict=True):
                total[:, k] = np.bincount(at, values, len(open_) * BINS).reshape(len(open_), BINS)
        feature, cut, gain, left, whole = best_splits(*sums, growth)
        splits = gain > -np.inf
        for i in np.flatnonzero(splits).tolist():
            tree.split(int(open_[i]), int(features[feature[i]]), int(cut[i]), gain[i], [x[i] for x in left], [x[i] for x in whole])
        stay = splits[own]
        bins, wanted, weight, node = bins[stay], wanted[stay], weight[stay], node[stay]
        if level + 1 < levels:
            right = bins[np.arange(len(node)), tree.feature[node]] > tree.cut[node]
            node = 2 * node + right
    return tree


def _walk(rows: DataFrame, trees: list[Tree], steps: int, which: Column) -> DataFrame:
    """Adds ``_node``: where each row stands in its tree after ``steps`` splits.

    Trees enter as arrays, not as conditions: the same code runs for every tree.
    """
    size = 2**steps
    feature, cut = (F.lit([getattr(t, name)[:size].tolist() for t in trees]) for name in ("feature", "cut"))
    rows = rows.withColumn("_node", F.lit(1))
    for _ in range(steps):
        split = F.get(F.get(feature, which), F.col("_node"))
        right = F.get("bins", split).cast("int") > F.get(F.get(cut, which), F.col("_node")) - 128
        rows = rows.withColumn("_node", F.when(F.coalesce(split, F.lit(-1)) < 0, F.col("_node"))
                               .otherwise(2 * F.col("_node") + right.cast("int")))
    return rows


def grow(rows: DataFrame, trees: int, chosen: list[list[int]], n_features: int, total: int, growth: Growth,
         local_rows: int = LOCAL_ROWS) -> list[Tree]:
    """Trees 0 .. ``trees`` - 1 from rows (tree, bins, wanted, weight); ``total`` bounds the rows of a tree.

    ``chosen`` lists the features each tree may use.  Levels are split by distributed
    histograms as long as a node has more than ``local_rows`` rows.
    """
    grown = [Tree(growth.depth) for _ in range(trees)]
    large = [(t, 1) for t in range(trees)] if total > local_rows else []
    small = [] if large else [(t, 1) for t in range(trees)]
    for level in range(growth.depth):
        if not large:
            break
        wanted_nodes = [[0] * 2 ** (level + 1) for _ in range(trees)]
        for t, node in large:
            wanted_nodes[t][node] = 1
        which = F.col("tree")
        here = _walk(rows, grown, level, which).where(F.get(F.get(F.lit(wanted_nodes), which), F.col("_node")) == 1)
        cells = here.select("tree", "_node", "bins", "wanted", "weight", F.explode(F.get(F.lit(chosen), which)).alias("f"))
        key = ((F.col("tree").cast("long") * 2**level + F.col("_node") - 2**level) * n_features + F.col("f")) * BINS \
            + F.get("bins", F.col("f")) + 128
        sums = cells.groupBy(key.alias("key")).agg(
            F.sum("wanted").alias("wanted"), F.sum("weight").alias("weight"), F.count("*").alias("n")).toArrow()
        order = np.argsort(sums.column("key").to_numpy())
        place, cell = np.divmod(sums.column("key").to_numpy()[order], n_features * BINS)
        columns = [sums.column(c).to_numpy()[order] for c in ("wanted", "weight", "n")]
        large_next = []
        for t, node in large:
            first, last = np.searchsorted(place, t * 2**level + node - 2**level + np.arange(2))
            dense = [np.zeros((1, n_features, BINS)) for _ in columns]
            for filled, values in zip(dense, columns, strict=True):
                filled.reshape(-1)[cell[first:last]] = values[first:last]
            picked = np.array(chosen[t])
            feature, cut, gain, left, whole = best_splits(*[d[:, picked] for d in dense], growth)
            tree = grown[t]
            if node == 1:
                tree.wanted[1], tree.weight[1], tree.rows[1] = (w[0] for w in whole)
            if gain[0] > -np.inf:
                tree.split(node, int(picked[feature[0]]), int(cut[0]), gain[0], [x[0] for x in left], [x[0] for x in whole])
                for child in (2 * node, 2 * node + 1):
                    if level + 1 < growth.depth:
                        (large_next if tree.rows[child] > local_rows else small).append((t, child))
        large = large_next
    if small:
        _finish(rows, grown, small, chosen, growth)
    return grown


def _bytes(bins: pa.Array) -> np.ndarray:
    """Bins from 0 to 255, rows x features, each feature's together."""
    found = bins.flatten().to_numpy(zero_copy_only=False).view(np.uint8) ^ np.uint8(128)
    return np.asfortranarray(found.reshape(len(bins), -1))


_LOCAL = "tree int, root int, node int, feature int, cut int, gain double, wanted double, weight double, rows long"


def _finish(rows: DataFrame, grown: list[Tree], small: list[tuple[int, int]], chosen: list[list[int]], growth: Growth) -> None:
    """Finishes the small nodes, each in the task that gathers its rows; at most `LOCAL_ROWS` of them."""
    deepest = max(node for _, node in small).bit_length() - 1
    mark = [[0] * 2 ** (deepest + 1) for _ in grown]
    for t, node in small:
        mark[t][node] = 1
    which = F.col("tree")  # unsplit nodes end the walk, so every row of a small node stands at it
    here = _walk(rows, grown, deepest, which).where(F.get(F.get(F.lit(mark), which), F.col("_node")) == 1)

    def finish(group: pa.Table) -> pa.Table:
        t, root = group.column("tree")[0].as_py(), group.column("_node")[0].as_py()
        bins = group.column("bins").combine_chunks()
        matrix = _bytes(bins)
        wanted, weight = (group.column(c).to_numpy().astype(np.float64) for c in ("wanted", "weight"))
        levels = growth.depth - (root.bit_length() - 1)
        tree = grow_here(matrix, wanted, weight, np.array(chosen[t]), levels, growth)
        return pa.Table.from_batches([_told(tree, t, root)])

    found = here.select("tree", "_node", "bins", "wanted", "weight").groupBy("tree", "_node").applyInArrow(finish, _LOCAL).toArrow()
    _fill(grown, found)


def _told(tree: Tree, number: int, root: int) -> pa.RecordBatch:
    """A tree's nodes as rows of `_LOCAL`."""
    nodes = np.flatnonzero(tree.rows > 0)
    own = np.ones(len(nodes), np.int32)
    return pa.RecordBatch.from_pydict({
        "tree": own * np.int32(number), "root": own * np.int32(root), "node": nodes.astype(np.int32),
        "feature": tree.feature[nodes].astype(np.int32), "cut": tree.cut[nodes].astype(np.int32), "gain": tree.gain[nodes],
        "wanted": tree.wanted[nodes], "weight": tree.weight[nodes], "rows": tree.rows[nodes].astype(np.int64)})


def _fill(grown: list[Tree], found: pa.Table) -> None:
    """Puts subtrees into their trees."""
    columns = {c: found.column(c).to_numpy() for c in found.column_names}
    level = np.floor(np.log2(np.maximum(columns["node"], 1))).astype(np.int64)
    number = (columns["root"].astype(np.int64) << level) + columns["node"] - (1 << level)
    for t in np.unique(columns["tree"]).tolist():
        own = columns["tree"] == t
        for name in ("feature", "cut", "gain", "wanted", "weight", "rows"):
            getattr(grown[t], name)[number[own]] = columns[name][own]


# --- models ----------------------------------------------------------------------

@dataclass(frozen=True)
class Trees:
    """A fitted model as a node table: leaves have feature -1; of a forest the mean over the trees counts.

    Arrays, one entry a node, by tree and node number: tree, node, feature, threshold (smaller
    values go left, missing ones right), gain of the split, cover (sum of weights) and value.
    """

    kind: str
    features: tuple[str, ...]
    nodes: dict[str, np.ndarray]

    @property
    def count(self) -> int:
        return len(np.unique(self.nodes["tree"]))

    @property
    def splits(self) -> int:
        return int((self.nodes["feature"] >= 0).sum())

    def table(self, spark: SparkSession) -> DataFrame:
        n = self.nodes
        names = [self.features[f] if f >= 0 else None for f in n["feature"].tolist()]
        rows = zip(n["tree"].tolist(), n["node"].tolist(), names,
                   [t if f is not None else None for t, f in zip(n["threshold"].tolist(), names, strict=True)],
                   *(n[c].tolist() for c in ("gain", "cover", "value")), strict=True)
        return spark.createDataFrame(list(rows), NODE_SCHEMA)

    def conditions(self, columns: Sequence[str]) -> str:
        """The prediction as nested conditions in SQL over the features' columns."""
        n = self.nodes
        place = {(t, i): k for k, (t, i) in enumerate(zip(n["tree"].tolist(), n["node"].tolist(), strict=True))}
        names = [f"`{c}`" for c in columns]

        def shown(tree: int, node: int) -> str:
            k = place[tree, node]
            f = int(n["feature"][k])
            if f < 0:
                return f"{float(n['value'][k])!r}D"
            return f"IF({names[f]} < {float(n['threshold'][k])!r}D, {shown(tree, 2 * node)}, {shown(tree, 2 * node + 1)})"

        trees = ", ".join(shown(t, 1) for t in np.unique(n["tree"]).tolist())
        total = f"aggregate(array({trees}), 0D, (a, x) -> a + x)"
        return f"{total} / {float(self.count)!r}D" if self.kind == "forest" else total

    def column(self, columns: Sequence[str]) -> Column:
        """The prediction of rows from their features' columns: conditions, or beyond
        `COMPILED_SPLITS` splits, whose plan would cost more than its rows, the same walk
        over whole Arrow batches."""
        if self.splits <= COMPILED_SPLITS:
            return F.expr(self.conditions(columns))
        walk = self._walker()
        return F.arrow_udf(walk, "double")(*[F.col(c).cast("double") for c in columns])

    def _walker(self) -> Callable[..., pa.Array]:
        n = self.nodes
        trees = np.unique(n["tree"])
        size = int(n["node"].max()) + 1
        depth = size.bit_length() - 1
        feature, threshold, value = np.full((len(trees), size), -1, np.int64), np.zeros((len(trees), size)), np.zeros((len(trees), size))
        at = np.searchsorted(trees, n["tree"])
        feature[at, n["node"]], threshold[at, n["node"]], value[at, n["node"]] = n["feature"], n["threshold"], n["value"]
        mean = float(len(trees)) if self.kind == "forest" else None

        def walk(*columns: pa.Array) -> pa.Array:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in columns], axis=1)
            total, rows = np.zeros(len(x)), np.arange(len(x))
            for f, t, v in zip(feature, threshold, value, strict=True):
                node = np.ones(len(x), np.int64)
                for _ in range(depth):
                    split = f[node]
                    right = ~(x[rows, split] < t[node])
                    node = np.where(split >= 0, 2 * node + right, node)
                total += v[node]
            return pa.array(total if mean is None else total / mean)

        return walk

    def sizes(self) -> list[float]:
        """Importance of each feature: of boosted trees the mean gain of its splits, of a forest the
        sum of its gains as a share of each tree's, summed over the trees."""
        n = self.nodes
        split = n["feature"] >= 0
        feature, gain, tree = n["feature"][split], n["gain"][split], n["tree"][split]
        if self.kind == "forest":
            of_tree = np.bincount(tree, gain, int(tree.max(initial=0)) + 1)
            gain = gain / of_tree[tree]
        sums = np.bincount(feature, gain, len(self.features))
        if self.kind == "boosted":
            sums = sums / np.maximum(np.bincount(feature, minlength=len(self.features)), 1)
        return sums.tolist()


def written_out(kind: str, features: Sequence[str], nested: Sequence) -> Trees:
    """A model from trees written as nested (feature, threshold, smaller, larger) with values as leaves."""
    columns: dict[str, list] = {c: [] for c in ("tree", "node", "feature", "threshold", "gain", "cover", "value")}

    def add(tree: int, node: int, part) -> None:
        split = isinstance(part, tuple)
        row = (tree, node, features.index(part[0]), part[1], 0.0, 0.0, 0.0) if split else (tree, node, -1, 0.0, 0.0, 0.0, part)
        for column, value in zip(columns.values(), row, strict=True):
            column.append(value)
        if split:
            add(tree, 2 * node, part[2])
            add(tree, 2 * node + 1, part[3])

    for number, part in enumerate(nested, 1):
        add(number, 1, part)
    return _model(kind, features, columns)


def from_table(table: DataFrame, kind: str, features: Sequence[str]) -> Trees:
    """A model from its stored node table."""
    rows = table.select("tree", "node", "feature", "threshold", "gain", "cover", "value").orderBy("tree", "node").collect()
    place = {name: i for i, name in enumerate(features)}
    columns = list(zip(*rows, strict=True)) if rows else [()] * 7
    return Trees(kind, tuple(features), {
        "tree": np.array(columns[0], np.int64), "node": np.array(columns[1], np.int64),
        "feature": np.array([place[f] if f is not None else -1 for f in columns[2]], np.int64),
        "threshold": np.array([0.0 if t is None else t for t in columns[3]], np.float64),
        **{c: np.array(columns[k], np.float64) for k, c in ((4, "gain"), (5, "cover"), (6, "value"))}})


def _nodes(numbered: list[tuple[int, Tree]], edges: list[np.ndarray], growth: Growth, rate: float) -> dict[str, list]:
    """Columns of the node table: values in their own unit again."""
    found: dict[str, list] = {c: [] for c in ("tree", "node", "feature", "threshold", "gain", "cover", "value")}
    for number, tree in numbered:
        values = tree.values(growth, rate)
        for node in np.flatnonzero(tree.rows > 0).tolist():
            f = int(tree.feature[node])
            for c, v in zip(found, (number, node, f, float(edges[f][tree.cut[node]]) if f >= 0 else 0.0, float(tree.gain[node]),
                                    float(tree.weight[node]), float(values[node])), strict=True):
                found[c].append(v)
    return found


def _model(kind: str, features: Sequence[str], columns: dict[str, list]) -> Trees:
    whole = ("tree", "node", "feature")
    return Trees(kind, tuple(features), {c: np.array(v, np.int64 if c in whole else np.float64) for c, v in columns.items()})


@dataclass(frozen=True)
class Prepared:
    """Binned rows as a table: draw (below `MODULUS`), bins and one column per label."""

    rows: DataFrame
    edges: list[np.ndarray]
    count: int
    bits: dict[str, int]


def prepare(train: DataFrame, features: Sequence[str], labels: Sequence[str], draw: Column) -> Prepared:
    """Bins the rows without a missing value and stores them; ``draw`` is a long from the row's key."""
    known = train.dropna(subset=[*features, *labels]).select(
        (draw % F.lit(MODULUS)).alias("draw"), *[F.col(c).cast("double").alias(c) for c in dict.fromkeys([*features, *labels])])
    edges = bin_edges(known, features)
    path = scratch_path(train.sparkSession, "binned")
    binned(known, features, edges).select("draw", "bins", *labels).write.parquet(path)
    rows = train.sparkSession.read.parquet(path)
    count, *largest = rows.agg(F.count("*"), *[F.max(F.abs(c)) for c in labels]).first()
    if not count:
        raise ValueError("no rows to fit")
    return Prepared(rows, edges, count, {c: fixed_bits(count, m) for c, m in zip(labels, largest, strict=True)})


def _sent(prepared: Prepared, labels: Sequence[str]):
    """All rows, at most `LOCAL_ROWS`, as arrays for every task."""
    rows = prepared.rows.select("draw", "bins", *labels).toArrow()
    held = (rows.column("draw").to_numpy(), _bytes(rows.column("bins").combine_chunks()),
            [rows.column(c).to_numpy() for c in labels])
    return prepared.rows.sparkSession.sparkContext.broadcast(held)


def _whole(values: np.ndarray, bits: int) -> np.ndarray:
    return np.rint(values * 2.0**bits)


def forest(prepared: Prepared, features: Sequence[str], labels: Sequence[str], trees: int, depth: int, least_rows: int,
           seed: int, local_rows: int = LOCAL_ROWS, together: int = TREES_TOGETHER) -> list[Trees]:
    """Bagged trees on all features, one model per label; a row's weight in a tree is the same for all labels."""
    bits = min(prepared.bits.values())
    growth = Growth(depth, 0.0, least_rows, 1e-9, bits)
    n_labels, n_features = len(labels), len(features)
    grown: list[Tree] = []
    if prepared.count <= local_rows:
        held = _sent(prepared, labels)
        multipliers = [factor("tree", seed, t) for t in range(trees)]

        def one(batches):
            draw, bins, wanted = held.value
            for batch in batches:
                for t in batch.column("id").to_pylist():
                    weight = np.searchsorted(POISSON, share(draw, multipliers[t]), side="right")
                    own = weight > 0
                    for k, y in enumerate(wanted):
                        tree = grow_here(bins[own], _whole(y[own], bits) * weight[own], weight[own].astype(np.float64),
                                         np.arange(n_features), depth, growth)
                        yield _told(tree, t * n_labels + k, 1)

        grown = [Tree(depth) for _ in range(trees * n_labels)]
        _fill(grown, prepared.rows.sparkSession.range(0, trees, 1, trees).mapInArrow(one, _LOCAL).toArrow())
        held.destroy()
    for first in range(len(grown) // n_labels, trees, together):
        numbers = range(first, min(first + together, trees))
        asked = F.posexplode(F.array(*[fixed(F.col(c), bits) for c in labels])).alias("label", "asked")
        rows = bootstrapped(prepared.rows, seed, numbers).select("bins", "i", "weight", asked).select(
            (F.col("i") * n_labels + F.col("label")).alias("tree"), "bins", (F.col("asked") * F.col("weight")).alias("wanted"),
            F.col("weight").cast("long").alias("weight"))
        n = len(numbers) * n_labels
        grown += grow(rows, n, [list(range(n_features))] * n, n_features, prepared.count, growth, local_rows)
    return [_model("forest", features, _nodes(list(enumerate(grown[k::n_labels], 1)), prepared.edges, growth, 1.0))
            for k in range(n_labels)]


def drawn_features(seed: int, label: str, tree: int, features: int, part: float) -> list[int]:
    """The features a boosted tree may use."""
    return sorted(random.Random(f"features:{seed}:{label}:{tree}").sample(range(features), max(1, int(features * part))))


def first_values(prepared: Prepared, labels: Sequence[str]) -> list[float]:
    """The labels' means, from fixed-point sums."""
    sums = prepared.rows.agg(*[F.sum(fixed(F.col(c), prepared.bits[c])) for c in labels]).first()
    return [s / prepared.count / 2.0**prepared.bits[c] for s, c in zip(sums, labels, strict=True)]


def boosting_rows(state: DataFrame, labels: Sequence[str], bits: int, seed: int, tree: int, subsample: float) -> DataFrame:
    """Rows (tree, bins, wanted, weight) of one round: what each label still lacks, of the rows drawn for its tree."""
    asked = F.array(*[
        F.struct(F.lit(i).alias("tree"), fixed(F.col(c) - F.col(f"_p{i}"), bits).alias("wanted"),
                 (share(F.col("draw"), factor("round", seed, c, tree)) < subsample).alias("drawn"))
        for i, c in enumerate(labels)
    ])
    return state.select("bins", F.explode(asked).alias("a")).where("a.drawn").select(
        "a.tree", "bins", "a.wanted", F.lit(1).cast("long").alias("weight"))


def _boost_here(prepared, features, labels, base, growth, rounds, rate, subsample, part, seed) -> list[list[Tree]]:
    """The rounds of each label in one task, from rows that every task holds."""
    held = _sent(prepared, labels)
    rounds_of = [[(drawn_features(seed, c, t, len(features), part), factor("round", seed, c, t)) for t in range(1, rounds + 1)]
                 for c in labels]

    def one(batches):
        draw, bins, wanted = held.value
        rows = np.arange(len(draw))
        for batch in batches:
            for k in batch.column("id").to_pylist():
                y, p = wanted[k], np.full(len(draw), base[k])
                for number, (chosen, multiplier) in enumerate(rounds_of[k]):
                    own = share(draw, multiplier) < subsample
                    lacking = _whole(y[own] - p[own], growth.bits)
                    tree = grow_here(bins[own], lacking, np.ones(len(lacking)), np.array(chosen), growth.depth, growth)
                    yield _told(tree, k * rounds + number, 1)
                    node = np.ones(len(draw), np.int64)
                    for _ in range(growth.depth):
                        split = tree.feature[node]
                        node = np.where(split >= 0, 2 * node + (bins[rows, split] > tree.cut[node]), node)
                    p = p + tree.values(growth, rate)[node]

    grown = [Tree(growth.depth) for _ in range(rounds * len(labels))]
    _fill(grown, prepared.rows.sparkSession.range(0, len(labels), 1, len(labels)).mapInArrow(one, _LOCAL).toArrow())
    held.destroy()
    return [grown[k * rounds:(k + 1) * rounds] for k in range(len(labels))]


def _boost_over(prepared, features, labels, base, growth, rounds, rate, subsample, part, seed, local_rows) -> list[list[Tree]]:
    """The rounds of all labels side by side over the whole table; what is predicted so far is a table a round."""
    spark = prepared.rows.sparkSession
    found: list[list[Tree]] = [[] for _ in labels]
    names = [f"_p{i}" for i in range(len(labels))]
    state, path = prepared.rows.withColumns({p: F.lit(b) for p, b in zip(names, base, strict=True)}), None
    for tree in range(1, rounds + 1):
        chosen = [drawn_features(seed, c, tree, len(features), part) for c in labels]
        rows = boosting_rows(state, labels, growth.bits, seed, tree, subsample)
        grown = grow(rows, len(labels), chosen, len(features), prepared.count, growth, local_rows)
        for own, new in zip(found, grown, strict=True):
            own.append(new)
        if tree < rounds:
            following = state
            for p, new in zip(names, grown, strict=True):
                added = F.get(F.lit(new.values(growth, rate).tolist()), F.col("_node"))
                following = _walk(following, [new], growth.depth, F.lit(0)).withColumn(p, F.col(p) + added).drop("_node")
            before, path = path, scratch_path(spark, "boosting")
            following.write.parquet(path)
            state = spark.read.parquet(path)
            if before is not None:
                discard(spark, before)
    if path is not None:
        discard(spark, path)
    return found


def boost(prepared: Prepared, features: Sequence[str], labels: Sequence[str], rounds: int, depth: int, rate: float,
          subsample: float, part: float, seed: int, penalty: float = 1.0, local_rows: int = LOCAL_ROWS) -> list[Trees]:
    """Second-order boosting of the squared error, all labels side by side, one tree each a round.

    The first value is the label's mean; a leaf's is the rate times the sum of what its rows
    lack over their number plus ``penalty``.  A tree sees ``subsample`` of the rows and
    ``part`` of the features.  Tree 0 of the node table is the first value.
    """
    bits = min(prepared.bits.values())
    growth = Growth(depth, penalty, 1, 1e-6, bits)
    base = first_values(prepared, labels)
    if prepared.count <= local_rows:
        found = _boost_here(prepared, features, labels, base, growth, rounds, rate, subsample, part, seed)
    else:
        found = _boost_over(prepared, features, labels, base, growth, rounds, rate, subsample, part, seed, local_rows)
    models = []
    for own, first in zip(found, base, strict=True):
        columns = _nodes(list(enumerate(own, 1)), prepared.edges, growth, rate)
        for c, v in zip(columns, (0, 1, -1, 0.0, 0.0, float(prepared.count), first), strict=True):
            columns[c].insert(0, v)
        models.append(_model("boosted", features, columns))
    return models


def measured(model: Trees, rows: DataFrame, label: str, penalty: float = 0.0) -> Trees:
    """The same trees with gains, covers and values as these rows have them (rows without missing values).

    One aggregate per model: rows are counted and summed at the leaves they reach.
    """
    n = model.nodes
    trees = np.unique(n["tree"]).tolist()
    place = {(t, i): k for k, (t, i) in enumerate(zip(n["tree"].tolist(), n["node"].tolist(), strict=True))}

    def leaf(tree: int, node: int) -> str:
        k = place[tree, node]
        if n["feature"][k] < 0:
            return str(node)
        name, at = model.features[int(n["feature"][k])], float(n["threshold"][k])
        return f"IF(`{name}` < {at!r}D, {leaf(tree, 2 * node)}, {leaf(tree, 2 * node + 1)})"

    known = rows.dropna(subset=[*model.features, label])
    reached = known.select(F.col(label).cast("double").alias("y"), F.posexplode(F.array(*[F.expr(leaf(t, 1)) for t in trees])).alias("t", "node"))
    sums = {(trees[t], node): (s, c) for t, node, s, c in reached.groupBy("t", "node").agg(F.sum("y"), F.count("*")).collect()}
    wanted, cover = np.zeros(len(n["tree"])), np.zeros(len(n["tree"]))
    for (t, node), (s, c) in sums.items():
        while node:
            wanted[place[t, node]] += s
            cover[place[t, node]] += c
            node //= 2

    def score(k: int) -> float:
        return wanted[k] ** 2 / (cover[k] + penalty) if cover[k] else 0.0

    gain = np.array([
        score(place[t, 2 * i]) + score(place[t, 2 * i + 1]) - score(k) if n["feature"][k] >= 0 else 0.0
        for k, (t, i) in enumerate(zip(n["tree"].tolist(), n["node"].tolist(), strict=True))])
    value = np.divide(wanted, cover + penalty, out=np.zeros_like(wanted), where=cover > 0)
    return Trees(model.kind, model.features, {**n, "gain": gain, "cover": cover, "value": value})
