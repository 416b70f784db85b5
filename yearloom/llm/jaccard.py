"""Joining near-duplicate texts: MinHash banding, verified on full sets of word n-grams.

Texts with the same set of n-grams are one class with many copies; from there on each class
takes part once.  Classes meet where they share a band hash, and only such pairs are compared,
on their full sets.  So that sets travel little, a class has its home in the largest band it
meets others in (the largest of that band's lead, if it is large); the classes of a home lie in cells of like size, and cells are compared two by
two wherever a band has members in both, whole homes cell by cell, other cells by the members
concerned.  Hot bands are spread over many such tiles, and no list of pairs is made: tiles
report, per class, the number of links and one tie to the smallest class it was linked with.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.llm import shared
from yearloom.llm import text as tx
from yearloom.llm.components import components, local_roots

#: Words of an n-gram.
SHINGLE = 5

#: Similarity from which two texts are linked.
THRESHOLD = 0.8

#: Share of the pairs at the threshold that must meet in a band.
RECALL = 0.99999

#: MinHash values a text may take.
MOST_HASHES = 160

#: Classes of a cell; in large homes the root of their number.
TILE = 64

#: Doublings of the way from a lead to its home.
HOPS = 4

#: Bits for each wanted document, and at least and at most in all, of the map that tells whose sets are wanted.
MAP_SHARE, MAP_LEAST, MAP_MOST = 16, 1 << 20, 1 << 30

#: Distinct n-grams of a tile counted at once.
COLUMNS = 1 << 16


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """Bands and rows: the most rows, so the fewest chance meetings, that reach the recall within ``most`` hashes."""
    best = None
    for rows in range(1, most + 1):
        share = threshold ** rows
        bands = 1 if share >= 1 else math.ceil(math.log1p(-recall) / math.log1p(-share))
        if bands * rows > most:
            break
        best = bands, rows
    if best is None:
        raise ValueError("no banding reaches this recall")
    return best


def shingles(hasher: tx.Hasher, column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct n-grams of each text, and each text's first (one more entry).

    A text of fewer words than ``size``, but not none, is one n-gram.
    """
    data, offsets = tx.text_bytes(column)
    lowered = tx.lower_table()[data]
    first, last, owner = tx.find_words(lowered, offsets, tx.alnum_mask())
    words = hasher.ranges(lowered, first, last)
    counts = np.diff(owner)
    grams = np.maximum(counts - size + 1, (counts > 0).astype(np.int64))
    text = np.repeat(np.arange(len(counts)), grams)
    at = owner[text] + tx.runs(grams)
    values = np.zeros(len(at), np.uint64)
    for k in range(size):
        there = at + k < owner[text + 1]
        values[there] = tx.mix(values[there] + words[at[there] + k])
    _, kept = np.unique(tx.mix(values + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    order = kept[np.lexsort((values[kept], text[kept]))]
    return values[order], np.searchsorted(text[order], np.arange(len(counts) + 1))


def keys(hashes: int, seed: int = 20) -> tuple[np.ndarray, np.ndarray]:
    base = tx.mix(np.arange(1, 2 * hashes + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(seed))
    return base[:hashes], base[hashes:] | np.uint64(1)


def bands(grams: np.ndarray, bounds: np.ndarray, n_bands: int, rows: int) -> np.ndarray:
    """Band hashes, texts x bands; those of texts without n-grams mean nothing."""
    out = np.zeros((len(bounds) - 1, n_bands), np.uint64)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        turns, factors = keys(n_bands * rows)
        for k in range(n_bands * rows):
            least = np.minimum.reduceat((grams ^ turns[k]) * factors[k], bounds[some])
            out[some, k // rows] = tx.mix(out[some, k // rows] + least)
    return out


def set_keys(grams: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each text's set, from sums over its n-grams."""
    sums = []
    for salt in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25):
        total = np.zeros(len(grams) + 1, np.uint64)
        np.cumsum(tx.mix(grams ^ np.uint64(salt)), out=total[1:])
        sums.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
    return sums[0], sums[1]


def sign(docs: DataFrame, threshold: float, recall: float, size: int) -> DataFrame:
    """doc_id, a hash of the text, the keys of its set of n-grams (null for no words), their number, and band hashes."""
    n_bands, rows = choose_bands(threshold, recall)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = tx.Hasher()
        marks = tx.mix(np.arange(1, n_bands + 1, dtype=np.uint64))
        for block in tx.blocks(batches):
            grams, bounds = shingles(hasher, block.column("text"), size)
            none = np.diff(bounds) == 0
            a, b = set_keys(grams, bounds)
            values = (bands(grams, bounds, n_bands, rows) + marks).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("text_key"), pa.array(a, mask=none), pa.array(b, mask=none), pa.array(np.diff(bounds)),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(none) + 1, dtype=np.int32) * n_bands), pa.array(values.reshape(-1)))],
                names=["doc_id", "text_key", "set_a", "set_b", "n", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text").mapInArrow(
        task, "doc_id long, text_key long, set_a long, set_b long, n long, bands array<long>")


def overlaps(first: list[np.ndarray], second: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of one list with all of the other."""
    sets = first + second
    sizes = np.array([len(s) for s in sets])
    _, number, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    common = times[number] > 1  # others add nothing to an intersection
    owner = owner[common]
    _, number = np.unique(number[common], return_inverse=True)
    order = np.argsort(number, kind="stable")
    number, owner = number[order], owner[order]
    out = np.zeros((len(first), len(second)))
    for at in range(0, int(number[-1]) + 1 if len(number) else 0, COLUMNS):
        a, b = np.searchsorted(number, (at, at + COLUMNS))
        has = np.zeros((len(sets), min(COLUMNS, int(number[-1]) + 1 - at)), np.float32)
        has[owner[a:b], number[a:b] - at] = 1
        out += has[:len(first)] @ has[len(first):].T  # sums below 2**24 are exact
    return out


def meeting(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Which rows of band hashes share one in the same place."""
    out = np.zeros((len(first), len(second)), bool)
    for k in range(first.shape[1]):
        out |= first[:, k, None] == second[:, k]
    return out


def linked(first: list[np.ndarray], second: list[np.ndarray], met: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of sets that have met and have a Jaccard similarity of at least ``threshold``."""
    u, v = np.flatnonzero(met.any(axis=1)), np.flatnonzero(met.any(axis=0))
    if not len(u):
        return u, v
    a, b = [first[i] for i in u], [second[i] for i in v]
    shared_grams = overlaps(a, b)
    union = np.array([len(s) for s in a])[:, None] + np.array([len(s) for s in b]) - shared_grams
    x, y = np.nonzero((shared_grams / union >= threshold) & met[np.ix_(u, v)])
    return u[x], v[y]


def similar(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, size: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, class_id, n_links.

    Two documents are linked if the Jaccard similarity of their sets of ``size`` consecutive
    words (runs of 0-9, a-z, characters beyond ASCII; A-Z lower-cased) is at least
    ``threshold``; ``class_id`` is the smallest doc_id reachable by links, itself included, and
    ``n_links`` counts the documents linked directly.  A pair at the threshold is found with
    the chance ``recall``, nearer ones almost surely.  Null texts and texts without words link
    with nothing; a text of fewer words is one n-gram; repeated rows are documents of their
    own, as are different texts under one doc_id; a row without doc_id counts as a link and has
    the class of those it is linked with, null if none has an id; an empty table gives an empty
    result.  Other columns are not read.
    """
    return _classified(docs, threshold, recall, size).select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def _classified(docs: DataFrame, threshold: float, recall: float, size: int) -> DataFrame:
    """Per document doc_id, text_key, component (null without words), class_id and n_links."""
    signed = shared.stored(sign(docs, threshold, recall, size), "jaccard-signed")
    classes = shared.stored(
        signed.where("n > 0").groupBy("set_a", "set_b")
        .agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("bands").alias("bands"))
        .withColumn("node", F.xxhash64("set_a", "set_b")), "jaccard-classes")
    links = shared.stored(_verified(docs, classes, threshold, size), "jaccard-links")
    degrees = links.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    joined = joined.unionByName(joined.select(F.col("component").alias("node"), "component").distinct())
    least = joined.join(classes.select("node", "rep"), "node").groupBy("component").agg(F.min("rep").alias("class_id"))
    named = (
        classes.select("set_a", "set_b", "node", "rep", "copies").join(degrees, "node", "left")
        .join(joined.join(least, "component"), "node", "left")
    )
    found = named.select("set_a", "set_b", F.coalesce("component", "node").alias("component"), F.coalesce("class_id", "rep").alias("class_id"),
                         (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return signed.select("doc_id", "text_key", "set_a", "set_b").join(found, ["set_a", "set_b"], "left")


def _tiles(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, shipments): classes that share a band with their cells, and the tiles each one is wanted in.

    A tile is two cells (home, number), the smaller first.
    """
    met = classes.select("node", F.explode("bands").alias("band"))
    leads = met.groupBy("band").agg(F.min("node").alias("lead"), F.count("*").alias("met")).where("met > 1")
    shared_bands = shared.stored(met.join(leads, "band"), "jaccard-bands")
    largest = shared.stored(shared_bands.groupBy("node").agg(F.max(F.struct("met", "lead")).alias("b")).select("node", "b.met", "b.lead"), "jaccard-leads")
    homes = _settled(largest)
    sizes = homes.groupBy("home").agg(F.count("*").alias("size")).where("size > 1")
    tile = F.greatest(F.lit(TILE), F.floor(F.sqrt("size")).cast("int"))
    cells = F.coalesce(F.ceil(F.col("size") / tile).cast("int"), F.lit(1))
    members = homes.join(sizes, "home", "left").withColumn("cells", cells).withColumn(
        "cell", F.pmod(F.xxhash64("node"), "cells").cast("int")).join(
        classes.select("node", "set_a", "set_b", "rep", "copies", "bands"), "node")
    members = shared.stored(members, "jaccard-members")

    def pair(home, number, other_home, other_number) -> list:
        own, other = F.struct(home.alias("home"), number.alias("cell")), F.struct(other_home.alias("home"), other_number.alias("cell"))
        return [F.least(own, other).alias("x"), F.greatest(own, other).alias("y"), own.alias("own")]

    inside = members.where("size > 1").select("node", "home", "cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("other"))
    inside = inside.select("node", *pair(F.col("home"), F.col("cell"), F.col("home"), F.col("other")))
    placed = shared_bands.select("node", "band").join(members.select("node", "home", "cell"), "node")
    mixed = placed.groupBy("band").agg(F.min("home").alias("a"), F.max("home").alias("b")).where("a <> b").select("band")
    crossing = shared.stored(placed.join(mixed, "band"), "jaccard-crossing")
    others = crossing.groupBy("band", F.col("home").alias("other_home"), F.col("cell").alias("other_cell")).agg(F.lit(1).alias("one")).drop("one")
    between = crossing.join(others, "band").where("home <> other_home").select(
        "node", *pair(F.col("home"), F.col("cell"), F.col("other_home"), F.col("other_cell"))).distinct()
    return members, inside.unionByName(between)


def _settled(largest: DataFrame) -> DataFrame:
    """(node, home): the lead of each class's largest band, or of large bands the home of that lead in turn.

    Near copies of one text meet in many bands of about the same members; their leads' homes
    lie in one another, so the group gets few homes.  Leads are few: one a large band.
    """
    large = largest.where(F.col("met") > TILE)
    hop = large.select(F.col("lead").alias("home")).distinct().join(
        largest.select(F.col("node").alias("home"), F.col("lead").alias("next")), "home")
    for _ in range(HOPS):
        onward = hop.select(F.col("home").alias("next"), F.col("next").alias("after"))
        hop = hop.join(onward, "next", "left").select("home", F.coalesce("after", "next").alias("next"))
    hop = shared.stored(hop, "jaccard-hops")
    onward = F.when(F.col("met") > TILE, F.col("next"))
    return largest.withColumnRenamed("lead", "home").join(hop, "home", "left").select(
        "node", F.coalesce(onward, "home").alias("home"))


def _verified(docs: DataFrame, classes: DataFrame, threshold: float, size: int) -> DataFrame:
    """(node, links, root) from the full sets of the classes that share a band, in tiles."""
    members, shipments = _tiles(classes)
    bits, wanted = _id_map(members)
    sent = shared.sent(docs.sparkSession, wanted)

    def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held = tx.Hasher(), shared.received(sent)
        for batch in batches:
            place = _map_place(pc.fill_null(batch.column("doc_id"), -1).to_numpy(), bits)
            some = batch.filter(pa.array((held[place >> 3] >> (place & 7) & 1).astype(bool)))
            for part in tx.blocks(iter([some])):
                grams, bounds = shingles(hasher, part.column("text"), size)
                raw = [grams[i:j].tobytes() for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(x) for x in set_keys(grams, bounds)), pa.array(raw, pa.binary())],
                    names=["doc_id", "own_a", "own_b", "grams"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for batch in batches:
            for row in batch.to_pylist():
                if (row["x"], row["y"]) != key:
                    yield from compared(held, key)
                    held, key = [], (row["x"], row["y"])
                held.append(row)
        yield from compared(held, key)

    def compared(rows: list[dict], key) -> Iterator[pa.RecordBatch]:
        rows = list({row["node"]: row for row in rows}.values())  # a repeated row counts once
        if len(rows) < 2:
            return
        x, y = key
        first = [r for r in rows if r["own"] == x]
        second = first if x == y else [r for r in rows if r["own"] == y]
        if not first or not second:
            return
        sets = [[np.frombuffer(r["grams"], np.uint64) for r in side] for side in (first, second)]
        met = meeting(*(np.array([r["bands"] for r in side]) for side in (first, second)))
        if x == y:
            met = np.triu(met, 1)
        u, v = linked(*sets, met, threshold)
        every = first if x == y else first + second
        v = v + (0 if x == y else len(first))
        ids = np.array([r["node"] for r in every])
        order = np.argsort(ids)
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        roots = order[local_roots(len(ids), place[u], place[v])][place]
        copies = np.array([r["copies"] for r in every])
        links = np.zeros(len(ids), np.int64)
        np.add.at(links, u, copies[v])
        np.add.at(links, v, copies[u])
        some = np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(links[some]), pa.array(ids[roots[some]])],
                                         names=["node", "links", "root"])

    sets = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        full_sets, "doc_id long, own_a long, own_b long, grams binary")
    with_sets = sets.join(members.select("node", "set_a", "set_b", "rep", "copies", "bands"), (
        (F.col("own_a") == F.col("set_a")) & (F.col("own_b") == F.col("set_b")) & F.col("doc_id").eqNullSafe(F.col("rep")))).select(
        "node", "copies", "bands", "grams")
    tiles = with_sets.join(shipments, "node")
    return tiles.repartition("x", "y").sortWithinPartitions("x", "y", "node").mapInArrow(compare, "node long, links long, root long")


def _map_place(ids: np.ndarray, bits: int) -> np.ndarray:
    return (tx.mix(ids.astype(np.int64).view(np.uint64)) % np.uint64(bits)).astype(np.int64)


def _id_map(members: DataFrame) -> tuple[int, np.ndarray]:
    """A map of bits, set for the documents that stand for the members; and their number.

    Other ids may meet a bit that is set: the join that follows is exact.
    """
    wanted = members.count() * MAP_SHARE
    bits = min(max(1 << max(wanted - 1, 1).bit_length(), MAP_LEAST), MAP_MOST)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = _map_place(pc.fill_null(batch.column("rep"), -1).to_numpy(), bits)
            yield pa.RecordBatch.from_arrays([pa.array(place)], names=["place"])

    bit = F.expr("shiftleft(1, cast(place % 8 as int))")
    found = members.select("rep").mapInArrow(task, "place long").groupBy(F.expr("place div 8").alias("byte")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(bits // 8, np.uint8)
    out[found.column("byte").to_numpy()] = found.column("bits").to_numpy()
    return bits, out


def one_per_class(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, size: int = SHINGLE) -> DataFrame:
    """The documents, unchanged, one of each class: that with the smallest doc_id, then text hash; ids before none.

    Of rows that repeat a doc_id and text one is kept.  Rows without words are classes of their own.
    Other columns may have any names.
    """
    found = _classified(docs, threshold, recall, size)
    rows = shared.stored(found.groupBy("component", "doc_id", "text_key").agg(F.count("*").alias("n")), "jaccard-rows")
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_key")
    # stored, so that a component with many rows is split in the join
    kept = shared.stored(rows.where("component is not null").groupBy("component").agg(F.min(place).alias("kept")), "jaccard-kept")
    marked = rows.join(kept, "component", "left").withColumn("gone", F.coalesce(F.col("kept") != place, F.lit(False)))
    marked = shared.stored(marked.where("gone or n > 1").select("doc_id", "text_key", "gone"), "jaccard-marked")
    key = "_key"
    while key in [c.lower() for c in docs.columns]:
        key = "_" + key
    left = docs.withColumn(key, F.xxhash64("text"))
    same = left["doc_id"].cast("long").eqNullSafe(marked["doc_id"]) & (left[key] == marked["text_key"])
    left = left.join(marked.where("gone"), same, "left_anti")
    repeated = marked.where("not gone")
    if not repeated.isEmpty():
        once = left.join(repeated, same, "left_semi").dropDuplicates(["doc_id", key])
        left = left.join(repeated, same, "left_anti").unionByName(once)
    return left.drop(key)
