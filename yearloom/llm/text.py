"""Texts as byte arrays: cutting batches, finding words, hashing them without a Python loop.

A text is never turned into Python strings here.  A block of documents is one
array of UTF-8 bytes with the offsets of its documents; null texts are empty.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once in a task; a longer text is a block of its own.
BLOCK_BYTES = 2_000_000

#: Odd multiplier of the polynomial word hash and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)

ASCII_SPACES = (9, 10, 11, 12, 13, 32)


def lower_table() -> np.ndarray:
    """Byte to byte: A-Z to a-z, all else unchanged."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def alnum_mask() -> np.ndarray:
    """Word bytes after lower-casing: 0-9, a-z and every byte beyond ASCII."""
    mask = np.zeros(256, dtype=bool)
    mask[48:58] = mask[97:123] = mask[128:] = True
    return mask


def nonspace_mask() -> np.ndarray:
    """Every byte but the six ASCII white-space characters."""
    mask = np.ones(256, dtype=bool)
    mask[list(ASCII_SPACES)] = False
    return mask


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in record batches of at most ``limit`` bytes of text, a longer text alone.

    After the last one the task's freed memory goes back to the system: workers live on.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(False).astype(np.int64))
        first, before = 0, 0
        while first < batch.num_rows:
            last = max(int(np.searchsorted(size, before + limit, side="right")), first + 1)
            yield batch.slice(first, last - first)
            first, before = last, int(size[last - 1])
    give_back()


def give_back() -> None:
    """Returns freed memory to the system where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each one starts and the last one ends."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0]:bounds[-1]], bounds - bounds[0]


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the result."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """64-bit hashes of byte ranges of one array, by prefix sums of a polynomial."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def ranges(self, data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """A hash of ``data[first:last]`` for each pair; equal bytes give equal hashes."""
        if len(data) >= len(self.up):
            self.up, self.down = powers(_BASE, len(data)), powers(_BACK, len(data))
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:len(data)], out=sums[1:])
        return mix((sums[last] - sums[first]) * self.down[first] + (last - first).astype(np.uint64))


def find_words(data: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of word bytes, and the first word of each document.

    Words never cross documents.  The third array has one more entry than there
    are documents: document ``i`` owns words ``[w[i], w[i + 1])``.
    """
    inside = word_byte[data]
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = inside
    cut = offsets[(offsets >= 0) & (offsets < len(data))]
    opens = before.copy()
    opens[cut] = False
    first = np.flatnonzero(inside & ~opens[:-1])
    after = np.zeros(len(data) + 1, dtype=bool)
    after[:-1] = inside
    after[offsets] = False
    last = np.flatnonzero(inside & ~after[1:]) + 1
    return first, last, np.searchsorted(first, offsets)


def runs(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. within each run of the given lengths, one after another."""
    counts = np.asarray(counts, dtype=np.int64)
    total = int(counts.sum())
    starts = np.repeat(np.cumsum(counts) - counts, counts)
    return np.arange(total, dtype=np.int64) - starts


def segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values[bounds[i]:bounds[i + 1]]``; 0 for empty ranges."""
    total = np.zeros(len(values) + 1, dtype=np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
