"""Token ids of whole texts: every distinct chunk is encoded once per worker.

Both tokenizers split a text before merging and never merge across a split, so the
ids of a text are the ids of its chunks in order.  Chunks are cut here at ASCII white
space by the tokenizers' own rule; texts where that cut could differ (special tokens
written out, rare white space) are encoded whole.
"""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from yearloom.llm import text as tx

#: Texts with one of these go through the tokenizer whole: special tokens, white space beyond ASCII.
RARE = re.compile("<\\||[\x1c-\x1f\x85\xa0  -     　]")

#: Distinct chunks remembered in a worker (about 25 bytes each); beyond it the memory starts
#: anew, results are the same.
REMEMBERED = 3_000_000


def load(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def chunk_bounds(data: np.ndarray, offsets: np.ndarray, spaced: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of chunks and the first chunk of each document.

    ``spaced``: one blank goes with the word after it and white space is kept as
    chunks of its own (byte-level tokenizers); otherwise white space is dropped.
    """
    nonspace = tx.nonspace_mask()
    if not spaced:
        return tx.find_words(data, offsets, nonspace)
    n = len(data)
    space = ~nonspace[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    previous_space = np.zeros(n, dtype=bool)
    previous_space[1:] = space[:-1]
    next_word = np.zeros(n, dtype=bool)
    next_word[:-1] = ~space[1:]
    next_word &= ~edge[1:]
    after_blank = np.zeros(n, dtype=bool)
    after_blank[1:] = data[:-1] == 32
    starts = edge[:-1] | (space & ~previous_space) | (space & next_word) | (~space & previous_space & ~after_blank)
    first = np.flatnonzero(starts)
    last = np.append(first[1:], n)
    return first, last, np.searchsorted(first, offsets)


def byte_classes() -> np.ndarray:
    """0 white space, 1 letter, 2 digit, 3 other, 4 anything that is not surely one of these."""
    kinds = np.full(256, 3, np.uint8)
    kinds[list(tx.ASCII_SPACES)] = 0
    kinds[65:91] = kinds[97:123] = 1
    kinds[48:58] = 2
    kinds[39] = kinds[:9] = kinds[14:32] = kinds[127:] = 4
    return kinds


def letters(data: np.ndarray) -> np.ndarray:
    """Classes of bytes; the two bytes of an accented Latin letter are letters."""
    kinds = byte_classes()[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    follow = data[lead + 1]
    lead = lead[(follow != 0x97) & (follow != 0xB7)]
    kinds[lead] = kinds[lead + 1] = 1
    return kinds


def piece_starts(data: np.ndarray) -> np.ndarray:
    """Where the word tokenizer's pieces begin: runs of letters, single digits, runs of others."""
    kinds = letters(data)
    before = np.zeros(len(kinds), np.uint8)
    before[1:] = kinds[:-1]
    return (kinds != 0) & ((kinds != before) | (kinds == 2))


def plain_chunks(data: np.ndarray, first: np.ndarray, last: np.ndarray, spaced: bool) -> np.ndarray:
    """Chunks that may be encoded in one string with others."""
    if spaced:
        words = np.zeros(len(data) + 1, np.int64)
        np.cumsum(tx.nonspace_mask()[data], out=words[1:])
        return words[last] > words[first]
    odd = np.zeros(len(data) + 1, np.int64)
    np.cumsum(letters(data) == 4, out=odd[1:])
    return odd[last] == odd[first]


class Encoder:
    """Ids of all documents of a block; remembers chunks over blocks and tasks."""

    def __init__(self, path: str, spaced: bool, remembered: int = REMEMBERED):
        self.tokenizer, self.spaced, self.remembered = load(path), spaced, remembered
        self.hasher = tx.Hasher()
        words = self.tokenizer.get_vocab()
        self.units = np.zeros(max(words.values()) + 1, np.int64)
        for word, i in words.items():
            self.units[i] = len(word) if spaced else word.endswith("</w>")
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.sizes = np.zeros(0, np.uint32)
        self.starts = np.zeros(0, np.uint32)
        self.pool = np.zeros(0, np.uint16 if len(self.units) <= 1 << 16 else np.uint32)

    def one_by_one(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all strings, one after another, and how many each has."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for x in found for i in x), np.uint32, int(counts.sum())), counts

    def joined(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """As ``one_by_one``, from few long strings: the ids are cut by what they stand for.

        An id of a byte-level vocabulary stands for as many bytes as its entry has
        characters; in the other vocabulary an id that ends a piece is marked.  Cuts
        that miss the end of a chunk send the whole group to ``one_by_one``.
        """
        if self.spaced:
            parts = [c if c[0] == 32 else b"\n" + c for c in chunks]
            stops = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
            starts = stops - np.fromiter(map(len, chunks), np.int64, len(chunks))
        else:
            parts = [b" " + c for c in chunks]
            stops = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
            pieces = np.concatenate([[0], np.cumsum(piece_starts(np.frombuffer(b"".join(parts), np.uint8)))])[stops]
            starts, stops = np.concatenate([[0], pieces[:-1]]), pieces
        text = b"".join(parts).decode()
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        reached = np.concatenate([[0], np.cumsum(self.units[ids])])
        left = np.searchsorted(reached, starts, side="left" if self.spaced else "right") - (not self.spaced)
        right = np.searchsorted(reached, stops, side="left")
        if not self.spaced:
            left = np.concatenate([[0], right[:-1]])
        if len(ids) == 0 or reached[-1] != stops[-1] or (reached[left] != starts).any() or (reached[right] != stops).any():
            return self.one_by_one([c.decode() for c in chunks])
        sizes = right - left
        return ids[np.repeat(left, sizes) + tx.runs(sizes)], sizes

    def learn(self, data: np.ndarray, keys: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
        raw = data.tobytes()
        chunks = [raw[a:b] for a, b in zip(first.tolist(), last.tolist(), strict=True)]
        plain = plain_chunks(data, first, last, self.spaced)
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        found, at = [], int(plain.sum())
        for k in range(0, at, 4_000):
            found.append(self.joined([chunks[i] for i in order[k:min(k + 4_000, at)].tolist()]))
        for k in range(at, len(order), 4_000):
            found.append(self.one_by_one([chunks[i].decode() for i in order[k:k + 4_000].tolist()]))
        counts = np.concatenate([x[1] for x in found])
        sizes, starts = np.empty(len(order), np.uint32), np.empty(len(order), np.uint32)
        sizes[order], starts[order] = counts, np.cumsum(counts) - counts + len(self.pool)
        self.pool = np.concatenate([self.pool, *(x[0].astype(self.pool.dtype) for x in found)])
        at = np.searchsorted(self.keys, keys)
        self.keys, self.sizes, self.starts = (
            np.insert(old, at, new) for old, new in ((self.keys, keys), (self.sizes, sizes), (self.starts, starts)))

    def block(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents, one after another, and each document's first (one more entry)."""
        data, offsets = tx.text_bytes(texts)
        rare = [i for i, t in enumerate(texts) if t.is_valid and RARE.search(t.as_py())] if self._odd(data) else []
        first, last, owner = chunk_bounds(data, offsets, self.spaced)
        hashes = self.hasher.ranges(data, first, last)
        if len(self.keys) > self.remembered:
            self.forget()
        distinct, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), dtype=bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == distinct[inside]
        if not known.all():
            new = sample[~known]
            self.learn(data, distinct[~known], first[new], last[new])
            at = np.searchsorted(self.keys, distinct)
        sizes, starts = self.sizes[at][which].astype(np.int64), self.starts[at][which].astype(np.int64)
        ids = self.pool[np.repeat(starts, sizes) + tx.runs(sizes)].astype(np.uint32)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        bounds = ends[owner]
        return self._whole(texts, rare, ids, bounds) if rare else (ids, bounds)

    def _odd(self, data: np.ndarray) -> bool:
        """Whether a rare sequence may occur, by its first two bytes."""
        one, two = data[:-1], data[1:]
        odd = (one == 60) & (two == 124)
        if self.spaced:
            odd |= (one == 0xC2) & ((two == 0x85) | (two == 0xA0)) | (one == 0xE1) & (two == 0x9A)
            odd |= (one == 0xE2) & ((two == 0x80) | (two == 0x81)) | (one == 0xE3) & (two == 0x80)
        return bool(odd.any() or (self.spaced and ((data >= 28) & (data < 32)).any()))

    def _whole(self, texts, rare, ids, bounds):
        fixed, counts = self.one_by_one([texts[i].as_py() for i in rare])
        ends = np.cumsum(counts)
        pieces, sizes, done = [], np.diff(bounds), 0
        for k, i in enumerate(rare):
            pieces += [ids[bounds[done]:bounds[i]], fixed[ends[k] - counts[k]:ends[k]]]
            sizes[i], done = counts[k], i + 1
        pieces.append(ids[bounds[done]:])
        return np.concatenate(pieces), np.concatenate([[0], np.cumsum(sizes)])


def with_end(ids: np.ndarray, bounds: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same ids with ``end`` appended to every document."""
    grown = bounds + np.arange(len(bounds))
    out = np.empty(int(grown[-1]), np.uint32)
    stops = grown[1:] - 1
    keep = np.ones(len(out), dtype=bool)
    keep[stops] = False
    out[keep], out[stops] = ids, end
    return out, grown


def encoder(path: str, spaced: bool) -> Encoder:
    """The encoder of this worker process: Spark uses a worker for many tasks."""
    kept = sys.modules.setdefault("_yearloom_worker", types.ModuleType("_yearloom_worker")).__dict__
    if (path, spaced) not in kept:
        kept[path, spaced] = Encoder(path, spaced)
    return kept[path, spaced]


def encoded(batches: Iterator[pa.RecordBatch], path: str, spaced: bool, end: int):
    """For each block of documents: its rows, their ids with the end id, each document's first."""
    held = encoder(path, spaced)
    held.hasher = tx.Hasher()
    for block in tx.blocks(batches):
        yield block, *with_end(*held.block(block.column("text")), end)
    held.hasher = tx.Hasher()  # what stays in the worker is the chunks' ids alone
    tx.give_back()
