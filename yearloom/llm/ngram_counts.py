"""Counting keys at scale: blocks of sorted keys travel compressed, one row per shard and block."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOBS = "shard int, n long, keys binary, counts binary"

#: Distinct keys a task holds before it sends them on.
HELD_KEYS = 2_000_000


def shards_for(total: int) -> int:
    """Shards for ``total`` counted things: their size grows with the root of the total, within bounds."""
    cell = min(max(1 << 19, math.isqrt(total) * 32), 1 << 22)
    return max(1, -(-total // cell))


def squeeze(values: np.ndarray) -> bytes:
    """Whole numbers, bytes of equal weight together, compressed."""
    width = values.dtype.itemsize
    return pa.compress(values.view(np.uint8).reshape(-1, width).T.tobytes(), codec="zstd", asbytes=True)


def unsqueeze(blob: bytes, n: int, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = pa.decompress(blob, decompressed_size=n * width, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, n).T).reshape(-1).view(kind)


def tally(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    if counts is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts[:0]


def to_blobs(keys: np.ndarray, counts: np.ndarray | None, shard: np.ndarray) -> pa.RecordBatch:
    """Rows for sorted keys, with or without counts, whose shards do not decrease."""
    first = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if len(shard) else np.zeros(0, np.int64)
    last = np.append(first[1:], len(shard))
    ends = list(zip(first.tolist(), last.tolist(), strict=True))
    columns = {"shard": pa.array(shard[first].astype(np.int32)), "n": pa.array((last - first).astype(np.int64)),
               "keys": pa.array([squeeze(np.diff(keys[a:b], prepend=np.uint64(0))) for a, b in ends], pa.binary())}
    if counts is not None:
        columns["counts"] = pa.array([squeeze(counts[a:b].astype(np.int64)) for a, b in ends], pa.binary())
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def collected(parts: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], limit: int = HELD_KEYS) -> Iterator[pa.RecordBatch]:
    """Shards, keys and counts of a task's parts, merged while they fit, as blob rows."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def flush() -> pa.RecordBatch:
        shard, keys, counts = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((keys, shard))
        shard, keys, counts = shard[order], keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (shard[1:] != shard[:-1])]))
        return to_blobs(keys[first], np.add.reduceat(counts, first), shard[first])

    for shard, keys, counts in parts:
        held.append((shard, keys, counts))
        size += len(keys)
        if size > limit:
            yield flush()
            held, size = [], 0
    if size:
        yield flush()


def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, sorted keys, summed counts) of the shards in a task's blob rows."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            keys = np.cumsum(unsqueeze(row["keys"], row["n"], np.uint64), dtype=np.uint64)
            held.setdefault(row["shard"], []).append((keys, unsqueeze(row["counts"], row["n"], np.int64)))
    for shard in sorted(held):
        yield shard, *tally(*(np.concatenate(x) for x in zip(*held.pop(shard), strict=True)))


def discounts(seen: list[int]) -> list[float]:
    """Discounts for counts 1, 2 and 3 or more, from how many keys have counts 1 to 4."""
    n1, n2, n3, n4 = (max(int(n), 0) for n in seen)
    share = n1 / (n1 + 2 * n2) if n1 else 0.0
    out = []
    for k, (here, above) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        out.append(min(max(k - (k + 1) * share * above / here, 0.1) if here else k * 0.5, float(k)))
    return out


def discounted(counts: np.ndarray, cut: list[float]) -> np.ndarray:
    return np.maximum(counts - np.array([0.0, *cut])[np.minimum(counts, 3)], 0.0)


def of_counts(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3 and 4."""
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5].tolist()
