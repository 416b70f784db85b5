"""Hard negatives: rows of other labels that score nearly as high as an anchor's positives.

Every vector is cut into segments, and of each segment its mean and its deviation (the length
of what is left without the mean) are stored.  Over a segment of n components the product of
two vectors is n times the product of the means, plus or minus at most the product of the
deviations.  Sums of these bounds over coarse segments leave out most pairs that cannot
matter, sums over finer ones more, and only what is left is scored exactly.

Rows and anchors lie with their summaries in files of the shared folder, a file a partition;
a task takes one file of rows, tile by tile, through the anchors block by block.  The anchors
among themselves are compared first: their best scores are limits below which no other row
needs to be looked at.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yearloom.llm import shared

#: Rows of a file, of one of its tiles, anchors of a block.
ROWS, TILE, BLOCK = 16_384, 4_096, 256

#: Components of a segment, coarse to fine.
LEVELS = (16, 4)

#: Share of the pairs up to which they go on one by one, and from which finer bounds cost more than scores.
SPARSE, DENSE = 0.02, 0.5

#: Room for rounding in the bounds, as a share of their sizes; summaries have single precision.
SLACK = 1e-6

#: Scores below are whole numbers in double precision.
EXACT = 2.0 ** 53

MOST = 2**63 - 1

_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_FOUND = "anchor long, anchor_id long, positive_id long, positive_score long, slot int, score long, vec_id long"


def scaled(embedding: str, scale: int) -> Column:
    """Components times ``scale``, or null if one is null or not finite."""
    values = F.transform(F.col(embedding).cast("array<double>"), lambda x: x * F.lit(float(scale)))
    return F.when(F.forall(values, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False))), values)


# --- bounds -------------------------------------------------------------------

def summary(rows: np.ndarray) -> np.ndarray:
    """Per row and level: the segments' means (times the root of their sizes), then their deviations."""
    parts = []
    size = rows.shape[1]
    for length in LEVELS if size else ():
        starts = np.arange(0, size, length)
        sizes = np.diff(np.append(starts, size))
        mean = np.add.reduceat(rows, starts, axis=1) / sizes
        rest = rows - np.repeat(mean, sizes, axis=1)
        parts += [mean * np.sqrt(sizes), np.sqrt(np.add.reduceat(rest * rest, starts, axis=1))]
    return np.concatenate(parts, axis=1) if parts else np.zeros((len(rows), 0))


def levels(size: int) -> list[tuple[slice, slice]]:
    """Where the means and deviations of each level lie in a summary."""
    found, at = [], 0
    for length in LEVELS if size else ():
        n = -(-size // length)
        found.append((slice(at, at + n), slice(at + n, at + 2 * n)))
        at += 2 * n
    return found


def scores(a: np.ndarray, b: np.ndarray, one_by_one: bool = False) -> np.ndarray:
    """Inner products of whole-numbered rows: of all pairs, or of row i with row i; exact, held to 64 bits."""
    reach = (np.abs(a).max(initial=0) * np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if reach < EXACT:
        return (np.einsum("ij,ij->i", a, b) if one_by_one else a @ b.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in m.tolist()], dtype=object).reshape(m.shape) for m in (a, b)]
    exact = (whole[0] * whole[1]).sum(axis=1) if one_by_one else whole[0] @ whole[1].T
    return np.clip(exact, -MOST, MOST).astype(np.int64)


def survivors(a: np.ndarray, a_summary: np.ndarray, b: np.ndarray, b_summary: np.ndarray,
              allowed: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All allowed pairs (u, v) with ``low[u] <= score <= high[u]``, and their scores.

    ``low`` and ``high`` are doubles that may be infinite.
    """
    u = v = None
    for means, deviations in levels(a.shape[1]):
        am, ad, bm, bd = a_summary[:, means], a_summary[:, deviations], b_summary[:, means], b_summary[:, deviations]
        with np.errstate(over="ignore", invalid="ignore"):  # unbounded sizes bound nothing
            if u is None:
                middle, room = am @ bm.T, ad @ bd.T
                room += SLACK * (np.abs(am) @ np.abs(bm).T + room) + SLACK
                allowed &= ~(middle + room < low[:, None]) & ~(middle - room > high[:, None])
                left = np.count_nonzero(allowed)
                if left <= SPARSE * allowed.size:
                    u, v = np.nonzero(allowed)
                elif left >= DENSE * allowed.size:
                    break
            else:
                middle, room = np.einsum("ij,ij->i", am[u], bm[v]), np.einsum("ij,ij->i", ad[u], bd[v])
                room += SLACK * (np.einsum("ij,ij->i", np.abs(am[u]), np.abs(bm[v])) + room) + SLACK
                keep = ~(middle + room < low[u]) & ~(middle - room > high[u])
                u, v = u[keep], v[keep]
    if u is None:
        found = scores(a, b)
        u, v = np.nonzero(allowed)
        found = found[u, v]
    else:
        found = scores(a[u], b[v], one_by_one=True)
    keep = (found >= low[u]) & (found <= high[u])
    return u[keep], v[keep], found[keep]


def first_of(group: np.ndarray, score: np.ndarray, ident: np.ndarray, most: int) -> np.ndarray:
    """Places of each group's first ``most`` entries, higher scores first, then smaller ids; repeats count once."""
    order = np.lexsort((ident, -score, group))
    group, score, ident = group[order], score[order], ident[order]
    new_group = np.ones(len(order), bool)
    new_group[1:] = group[1:] != group[:-1]
    new = new_group.copy()
    new[1:] |= (score[1:] != score[:-1]) | (ident[1:] != ident[:-1])
    order, new_group = order[new], new_group[new]
    starts = np.flatnonzero(new_group)
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[place < most]


# --- files of rows, anchors and limits --------------------------------------------

def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), size)


class Rows:
    """Rows of one vector length; ``numbers`` tell the rows of all files apart."""

    def __init__(self, numbers: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, told: np.ndarray):
        self.numbers, self.ids, self.labels = numbers, ids, labels
        self.vectors, self.summary = vectors.astype(np.float64), told.astype(np.float64)
        self.size = vectors.shape[1]


def _narrow(whole: np.ndarray) -> np.ndarray:
    """The same whole numbers in two or four bytes each, where they fit."""
    most = np.abs(whole).max(initial=0)
    return whole.astype("<i2" if most < 2**15 else "<i4" if most < 2**31 else "<f8")


def _write_rows(rows: DataFrame, address: str, most: int) -> int:
    """A file per partition with its vectors and their summaries, at most ``most`` together; returns the number of files."""

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out = TaskContext.get().partitionId(), io.BytesIO()
        for batch in batches:
            lengths = np.diff(batch.column("scaled").offsets.to_numpy())
            for size in np.unique(lengths).tolist():
                own = batch.filter(pa.array(lengths == size))
                for at in range(0, own.num_rows, most):
                    tile = own.slice(at, most)
                    whole = np.floor(_matrix(tile.column("scaled"), size))
                    for values in (tile.column("vec_id").to_numpy(), tile.column("label").to_numpy(), _narrow(whole),
                                   summary(whole).astype("<f4")):
                        np.save(out, values, allow_pickle=False)
        if out.tell():
            shared.write_file(f"{address}-{part}", [out.getbuffer()])
            yield pa.RecordBatch.from_pydict({"part": [part]})

    last = rows.mapInArrow(written, "part long").agg(F.max("part")).first()[0]
    return 0 if last is None else last + 1


def _read_rows(address: str, part: int) -> Iterator[Rows]:
    if not _there(f"{address}-{part}"):
        return
    system, path = shared.located(f"{address}-{part}")
    with system.open_input_file(path) as source:
        held = io.BytesIO(source.read_buffer())
    end, before = held.getbuffer().nbytes, part << 32
    while held.tell() < end:
        ids, labels, vectors, told = (np.load(held, allow_pickle=False) for _ in range(4))
        yield Rows(before + np.arange(len(ids)), ids, labels, vectors, told)
        before += len(ids)


class Limits:
    """Rows found for anchors of one file, sorted by anchor and slot, best first."""

    def __init__(self, address: str | None):
        names = ("anchor", "slot", "score", "vec_id")
        self.anchor, self.slot, self.score, self.vec_id = (
            np.zeros(0, np.int64) for _ in names) if address is None else shared.read_array(address, np.int64).reshape(4, -1)

    def worst(self, numbers: np.ndarray, slot: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per anchor: score and id of the ``most``-th row found, and whether there is one."""
        own = self.slot == slot
        anchor, score, ident = self.anchor[own], self.score[own], self.vec_id[own]
        at = np.searchsorted(anchor, numbers) + most - 1
        there = at < np.searchsorted(anchor, numbers, side="right")
        at = np.where(there, at, 0)
        if not len(anchor):
            return np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64), there
        return score[at], ident[at], there

    def all(self, numbers: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores and ids, anchors x most, and which are there."""
        first, last = np.searchsorted(self.anchor, numbers), np.searchsorted(self.anchor, numbers, side="right")
        at = first[:, None] + np.arange(most)
        there = at < last[:, None]
        at = np.where(there, at, 0)
        if not len(self.anchor):
            return np.zeros(at.shape, np.int64), np.zeros(at.shape, np.int64), there
        return self.score[at], self.vec_id[at], there


def _write_limits(found: DataFrame, folder: str, name: str) -> int:
    """Writes each anchor file's found rows to a file beside it; returns their number."""

    def written(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        group = group.sort_by([("anchor", "ascending"), ("slot", "ascending"), ("score", "descending"), ("vec_id", "ascending")])
        columns = [group.column(c).to_numpy().astype("<i8") for c in ("anchor", "slot", "score", "vec_id")]
        shared.write_file(f"{folder}/{name}-{part}", columns)
        return pa.table({"n": pa.array([len(group)], pa.int64())})

    rows = found.select(F.shiftright("anchor", 32).alias("part"), "anchor", "slot", "score", "vec_id")
    return rows.groupBy("part").applyInArrow(written, "n long").agg(F.sum("n")).first()[0] or 0


def _there(address: str) -> bool:
    system, path = shared.located(address)
    return system.get_file_info(path).type.name == "File"


# --- passes ----------------------------------------------------------------------

def _best(found: DataFrame, most: int) -> DataFrame:
    """The first ``most`` rows of each anchor and slot over all tiles, with their rank from 1."""
    own = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    kept = found.withColumn("rank", F.dense_rank().over(own)).where(F.col("rank") <= most)
    return kept.dropDuplicates(["anchor", "slot", "rank"])


def _wider(limit: np.ndarray, sign: int) -> np.ndarray:
    """A limit moved outwards by what rounding may have moved it inwards."""
    return limit + sign * SLACK * np.where(np.isfinite(limit), np.abs(limit), 0)


class _Pass:
    """One comparison of the rows in files ``source`` with all anchors, as a task function.

    ``wanted`` names the files of positives if negatives are searched; ``limits`` those of
    rows found before, if there are any.
    """

    def __init__(self, folder: str, source: str, parts: int, most: int, share: tuple[int, int], positives: int,
                 wanted: str | None = None, limits: str | None = None):
        self.folder, self.source, self.parts, self.most, self.share = folder, source, parts, most, share
        self.positives, self.wanted, self.limits = positives, wanted, limits

    def _limits(self, name: str | None, part: int) -> Limits:
        address = f"{self.folder}/{name}-{part}"
        return Limits(address if name is not None and _there(address) else None)

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in batch.column("id").to_pylist():
                for rows in _read_rows(f"{self.folder}/{self.source}", own):
                    for part in range(self.parts):
                        limits, wanted = self._limits(self.limits, part), self._limits(self.wanted, part)
                        for anchors in _read_rows(f"{self.folder}/anchors", part):
                            if anchors.size == rows.size:
                                yield from (self._negatives(anchors, rows, limits, wanted) if self.wanted
                                            else self._positives(anchors, rows, limits))

    def _positives(self, anchors: Rows, rows: Rows, limits: Limits) -> Iterator[pa.RecordBatch]:
        allowed = (anchors.labels[:, None] == rows.labels) & (anchors.ids[:, None] != rows.ids)
        score, ident, there = limits.worst(anchors.numbers, 0, self.most)
        low = _wider(np.where(there, score.astype(np.float64), -np.inf), -1)
        u, v, found = survivors(anchors.vectors, anchors.summary, rows.vectors, rows.summary, allowed, low,
                                np.full(len(low), np.inf))
        beaten = there[u] & ((found < score[u]) | ((found == score[u]) & (rows.ids[v] > ident[u])))
        u, v, found = u[~beaten], v[~beaten], found[~beaten]
        best = first_of(u, found, rows.ids[v], self.most)
        if len(best):
            u, v, found = u[best], v[best], found[best]
            zero = np.zeros(len(u), np.int64)
            yield self._batch(anchors, u, zero, zero, 0, found, rows.ids[v])

    def _negatives(self, anchors: Rows, rows: Rows, limits: Limits, wanted: Limits) -> Iterator[pa.RecordBatch]:
        low_share, high_share = self.share
        p_score, p_id, p_there = wanted.all(anchors.numbers, self.positives)
        least = np.array([[-(-low_share * p // high_share) for p in row] for row in p_score.tolist()], dtype=object)
        least = np.clip(least.reshape(p_score.shape), -MOST, MOST).astype(np.int64)
        worst = [limits.worst(anchors.numbers, slot, self.most) for slot in range(self.positives)]
        need = np.stack([np.where(w[2], np.maximum(w[0], least[:, k]), least[:, k]) for k, w in enumerate(worst)], axis=1)
        low = _wider(np.where(p_there, need.astype(np.float64), np.inf).min(axis=1, initial=np.inf), -1)
        high = _wider(np.where(p_there, p_score.astype(np.float64), -np.inf).max(axis=1, initial=-np.inf), 1)
        allowed = anchors.labels[:, None] != rows.labels
        u, v, found = survivors(anchors.vectors, anchors.summary, rows.vectors, rows.summary, allowed, low, high)
        for slot, (score, ident, there) in enumerate(worst):
            fits = p_there[u, slot] & (found >= least[u, slot]) & (found <= p_score[u, slot])
            fits &= ~(there[u] & ((found < score[u]) | ((found == score[u]) & (rows.ids[v] > ident[u]))))
            own, other, value = u[fits], v[fits], found[fits]
            best = first_of(own, value, rows.ids[other], self.most)
            if len(best):
                own, other, value = own[best], other[best], value[best]
                yield self._batch(anchors, own, p_id[own, slot], p_score[own, slot], slot, value, rows.ids[other])

    @staticmethod
    def _batch(anchors, u, positive, positive_score, slot, score, ident) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (anchors.numbers[u], anchors.ids[u], positive, positive_score,
                                   np.full(len(u), slot, np.int32), score, ident)],
            names=["anchor", "anchor_id", "positive_id", "positive_score", "slot", "score", "vec_id"])


def mine(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100),
         scale: int = 256) -> DataFrame:
    """Hard negatives of the anchors, the rows whose vec_id is divisible by ``every``.

    Reads vec_id, label and embedding; components x become floor(scale * x), scores are inner
    products of these.  An anchor's positives are its first ``positives`` other rows of its
    label, higher scores first, then smaller vec_id.  For each, returns the first ``negatives``
    rows of other labels whose score times ``share[1]`` is from ``share[0]`` to ``share[1]``
    times the positive's: anchor_id, positive_id, rank from 1, negative_id and both scores.

    Rows with a null vec_id, label or vector, or with null or non-finite components (also once
    scaled) take no part.  Vectors of different lengths are not compared.  Rows of one vec_id
    with different labels or vectors are each a row; where score and vec_id agree they count
    once, and a row of the anchor's own vec_id is not its positive.  Scores beyond 64 bits are
    held to them.  An empty table gives an empty result; other columns are not read.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                          scaled("embedding", scale).alias("scaled"))

    rows = rows.where("vec_id is not null and label is not null and scaled is not null")
    chosen = F.col("vec_id") % every == 0
    n_rows, n_anchors = rows.agg(F.count("*"), F.count_if(chosen)).first()
    folder = shared.folder(spark, "negatives")
    anchors = rows.where(chosen).dropDuplicates(["vec_id", "label", "scaled"]).repartition(-(-n_anchors // (4 * BLOCK)) or 1, "vec_id")
    parts = _write_rows(anchors.sortWithinPartitions(F.size("scaled"), "label", "vec_id", "scaled"), f"{folder}/anchors", BLOCK)
    if not parts:
        return spark.createDataFrame([], _RESULT)
    tasks = _write_rows(rows.repartition(-(-n_rows // ROWS)), f"{folder}/rows", TILE)

    def found(source: str, files: int, most: int, **limits: str) -> DataFrame:
        step = _Pass(folder, source, parts, most, share, positives, **limits)
        return _best(spark.range(0, files, 1, files).mapInArrow(step, _FOUND), most)

    _write_limits(found("anchors", parts, positives), folder, "seeds")
    _write_limits(found("rows", tasks, positives, limits="seeds"), folder, "positives")
    _write_limits(found("anchors", parts, negatives, wanted="positives"), folder, "close")
    return found("rows", tasks, negatives, wanted="positives", limits="close").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
