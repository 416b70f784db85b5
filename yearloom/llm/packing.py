"""Packing token sequences under several limits at once: vector bin packing by dot products.

A sequence has room for so many tokens, segments and loss-bearing tokens.  It is filled
with the example whose demands, as shares of the limits, have the largest dot product
with the shares still free, until no example fits; then the rest of its tokens is filled
with the first part of an example that is cut there.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yearloom.llm import shared
from yearloom.llm import tokens as tk

#: Ids of unfinished sequences that one task packs again.
REST_IDS = 4_000_000

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
    T.StructField("doc_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType()),
    T.StructField("loss_tokens", T.LongType()),
])


def fill(tokens: np.ndarray, loss: np.ndarray, limits: tuple[int, int, int], least: int = 32) -> np.ndarray:
    """Places examples of ``tokens`` ids, of which the last ``loss`` bear loss.

    ``limits``: ids, segments and loss-bearing ids of a sequence.  ``least``: gaps of
    fewer ids are left as padding.  Returns rows (example, start, length, sequence,
    offset, loss); every id of an example lies in one piece.  The first id of a piece
    follows nothing and bears no loss.
    """
    room, segments, most = limits
    if min(room, segments, most) < 1:
        raise ValueError("limits must be positive")
    whole = min(room, most + 1)
    placed: list[tuple[int, int, int, int, int, int]] = []
    stacks: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def bearing(example: int, start: int, length: int) -> int:
        opens = max(int(tokens[example] - loss[example]), start + 1)
        return max(0, start + length - opens)

    def push(example: int, start: int) -> tuple[int, int]:
        length = int(tokens[example]) - start
        kind = (length, bearing(example, start, length))
        stacks.setdefault(kind, []).append((example, start))
        return kind

    sequence = 0
    for example, length in enumerate(tokens.tolist()):
        start = 0
        while length - start > whole:  # a full sequence of its own
            placed.append((example, start, whole, sequence, 0, bearing(example, start, whole)))
            sequence, start = sequence + 1, start + whole
        if length > start:
            push(example, start)

    caps = np.array(limits, dtype=np.float64)
    kinds = sorted(stacks, reverse=True)
    number = {kind: i for i, kind in enumerate(kinds)}
    shares = np.array([(t, 1, b) for t, b in kinds], dtype=np.float64).reshape(-1, 3) / caps
    left = np.array([len(stacks[k]) for k in kinds], dtype=np.int64)

    while left.any():
        free, offset, held, bears = np.ones(3), 0, 0, 0
        while True:
            fits = (left > 0) & (shares <= free + 1e-9).all(axis=1)
            if not fits.any():
                break
            pick = int(np.argmax(np.where(fits, shares @ free, -1.0)))
            example, start = stacks[kinds[pick]].pop()
            left[pick] -= 1
            length, weight = kinds[pick]
            placed.append((example, start, length, sequence, offset, weight))
            offset, held, bears = offset + length, held + 1, bears + weight
            free = 1.0 - np.array([offset, held, bears]) / caps
        gap = min(room - offset, most - bears + 1)
        if gap >= least and held < segments and left.any():
            pick = int(np.argmax(np.where(left > 0, shares[:, 0], 0)))  # the longest example that is left
            example, start = stacks[kinds[pick]].pop()
            left[pick] -= 1
            placed.append((example, start, gap, sequence, offset, bearing(example, start, gap)))
            rest = push(example, start + gap)
            if rest in number:
                left[number[rest]] += 1
            else:
                number[rest] = len(kinds)
                kinds.append(rest)
                shares = np.vstack([shares, np.array([(rest[0], 1, rest[1])]) / caps])
                left = np.append(left, 1)
        sequence += 1
    return np.array(placed, dtype=np.int64).reshape(-1, 6)


def _crcs(ids: np.ndarray, first: np.ndarray, length: np.ndarray) -> pa.Array:
    raw = ids.astype("<u4", copy=False)
    return pa.array([zlib.crc32(raw[a:b]) for a, b in zip(first.tolist(), (first + length).tolist(), strict=True)], pa.int64())


def unfinished(pieces: np.ndarray, limits: tuple[int, int, int], least: int) -> np.ndarray:
    """Which pieces lie in sequences that could take more: room for ``least`` ids, a segment and loss."""
    _, _, length, sequence, _, loss = pieces.T
    n = int(sequence.max(initial=-1)) + 1
    ids, bears = np.bincount(sequence, length, n), np.bincount(sequence, loss, n)
    open_ = (limits[0] - ids >= least) & (np.bincount(sequence, minlength=n) < limits[1]) & (limits[2] - bears >= least)
    return open_[sequence]


def pack(docs: DataFrame, tokenizer: str, end: int, limits: tuple[int, int, int], least: int = 32) -> DataFrame:
    """Packs the ids of all documents, cut freely, into sequences; one row per piece.

    A document's ids are those of its whole text and then ``end``; its first id bears no
    loss.  Documents are packed where they lie, block by block.  What a block cannot finish,
    less than a sequence's ids in the main, is gathered with their ids and packed again, so
    the fill does not depend on how the input is split.  Sequences are padded to the limit.

    Null and empty texts are the end id alone; repeated rows are packed as often as they
    occur; an empty table gives no pieces.  Other columns are not read.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        for block, ids, bounds in tk.encoded(batches, tokenizer, True, end):
            sizes = np.diff(bounds)
            pieces = fill(sizes, sizes - 1, limits, least)
            example, start, length, sequence, offset, loss = pieces.T
            rest = unfinished(pieces, limits, least)
            raw = ids.astype("<u4", copy=False)
            first = bounds[example] + start
            held = [raw[a:b].tobytes() if left else None
                    for a, b, left in zip(first.tolist(), (first + length).tolist(), rest.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id").take(pa.array(example)), pa.array(start), pa.array(length), _crcs(ids, first, length),
                 pa.array(sizes[example]), pa.array(sequence + base), pa.array(offset), pa.array(loss), pa.array(held, pa.binary())],
                names=[*PIECES.names, "ids"])
            base += int(sequence.max()) + 1 if len(sequence) else 0

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = 1 << 62 | TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), "<u4")
            size, before = (batch.column(c).to_numpy() for c in ("length", "start"))
            pieces = fill(size, batch.column("loss_tokens").to_numpy(), limits, least)
            example, start, length, sequence, offset, loss = pieces.T
            first = (np.cumsum(size) - size)[example] + start
            own = pa.array(example)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(own), pa.array(before[example] + start), pa.array(length), _crcs(ids, first, length),
                 batch.column("doc_tokens").take(own), pa.array(sequence + base), pa.array(offset), pa.array(loss)], names=PIECES.names)
            base += int(sequence.max()) + 1 if len(sequence) else 0

    schema = T.StructType([*PIECES.fields, T.StructField("ids", T.BinaryType())])
    placed = shared.stored(docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(task, schema), "packed")
    rest = placed.where("ids is not null")
    tasks = -(-(rest.agg(F.sum("length")).first()[0] or 0) // REST_IDS) or 1
    return placed.where("ids is null").drop("ids").unionByName(rest.repartition(tasks).mapInArrow(again, PIECES))
