"""Benchmark decontamination with an FM-index per shard of training text.

Words are runs of 0-9, a-z (A-Z lower-cased) and characters beyond ASCII.  The phrases
are the windows of ten consecutive words of benchmark items.  A task indexes its text
shard by shard: the alphabet is the phrases' words, any other word breaks the sequence, and
stretches between breaks too short for any phrase are left out, as none can occur there.
Each phrase is found by backward search through wavelet-matrix ranks, its occurrences are
located by walking to sampled suffix positions, and overlapping occurrences merge into spans.
"""

from __future__ import annotations

import dataclasses
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yearloom.llm import shared
from yearloom.llm import text as tx

WINDOW = 10

#: Bytes of benchmark text whose phrases are searched together; a block is searched for one such set
#: after another, and what they find is put together before anything is cut.
PHRASE_BYTES = 8_000_000

#: Every so many positions of the text keep their place in the index.
SAMPLE = 16

SPANS = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))


class Words:
    """Hashes of all words of a block of texts, and where they are."""

    def __init__(self, hasher: tx.Hasher, column: pa.Array):
        self.data, self.offsets = tx.text_bytes(column)
        lowered = tx.lower_table()[self.data]
        self.first, self.last, self.owner = tx.find_words(lowered, self.offsets, tx.alnum_mask())
        self.hashes = hasher.ranges(lowered, self.first, self.last)


class Phrases:
    """The distinct windows of items as rows of word numbers, aligned to the right."""

    ARRAYS = ("vocabulary", "rows", "item", "bounds", "names", "name_bounds")

    def __init__(self, vocabulary, rows, item, bounds, names, name_bounds):
        self.vocabulary, self.rows, self.item, self.bounds = vocabulary, rows, item, bounds
        self.names, self.name_bounds = names, name_bounds
        self.lengths = (rows > 0).sum(axis=1)

    @classmethod
    def of(cls, names: pa.Array, texts: pa.Array, window: int) -> Phrases:
        """The phrases of items; one without a name is searched but never named."""
        words = Words(tx.Hasher(), texts)
        vocabulary, numbers = np.unique(words.hashes, return_inverse=True)
        counts = np.diff(words.owner)
        sizes = np.minimum(counts, window)
        each = np.where(counts > 0, counts - sizes + 1, 0)
        owner = np.repeat(np.arange(len(texts), dtype=np.int32), each)
        first = words.owner[owner] + tx.runs(each)
        rows = np.zeros((len(owner), window), np.int32)
        for k in range(window):  # aligned to the right
            place = k - (window - sizes[owner])
            there = place >= 0
            rows[there, k] = numbers[first[there] + place[there]] + 1
        order = np.lexsort(rows.T[::-1]) if len(rows) else np.zeros(0, np.int64)
        rows, owner = rows[order], owner[order]
        fresh = np.ones(len(rows), bool)
        fresh[1:] = (rows[1:] != rows[:-1]).any(axis=1)
        pairs = np.unique((np.cumsum(fresh) - 1) * np.int64(max(len(texts), 1)) + owner) if len(rows) else np.zeros(0, np.int64)
        phrase, item = np.divmod(pairs, max(len(texts), 1))
        known = names.is_valid().to_numpy(zero_copy_only=False)
        named = known[item] if len(item) else np.zeros(0, bool)
        spelled, name_bounds = tx.text_bytes(names)
        rows = rows[fresh]
        return cls(vocabulary, rows, item[named].astype(np.int32), np.searchsorted(phrase[named], np.arange(len(rows) + 1)), spelled, name_bounds)

    def write(self, folder: str, number: int) -> None:
        for name in self.ARRAYS:
            out = io.BytesIO()
            np.save(out, getattr(self, name), allow_pickle=False)
            shared.write_file(f"{folder}/{number}-{name}", [out.getbuffer()])

    @classmethod
    def read(cls, folder: str, number: int) -> Phrases:
        """Mapped where the folder is mounted, read elsewhere."""
        found = []
        for name in cls.ARRAYS:
            system, path = shared.located(f"{folder}/{number}-{name}")
            if isinstance(system, pafs.LocalFileSystem):
                found.append(np.load(path, mmap_mode="r"))
            else:
                with system.open_input_file(path) as source:
                    found.append(np.load(io.BytesIO(source.read_buffer()), allow_pickle=False))
        return cls(*found)

    def name(self, item: int) -> str:
        return self.names[self.name_bounds[item]:self.name_bounds[item + 1]].tobytes().decode()

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers, 0 for words of no phrase."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes by doubling; each 0 is a break, smaller than words and unlike any other break."""
    breaks = text == 0
    rank = np.where(breaks, np.cumsum(breaks) - 1, text + breaks.sum())
    step, n = 1, len(text)
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[:-step] = rank[step:] + 1
        order = np.lexsort((ahead, rank))
        a, b = rank[order], ahead[order]
        fresh = np.ones(n, np.int64)
        fresh[0] = 0
        fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh)
        step *= 2
        if rank[order[-1]] == n - 1 or step >= n:
            return order


class FMIndex:
    """Backward search and location over a sequence of word numbers that ends with a break."""

    def __init__(self, text: np.ndarray, largest: int, sample: int = SAMPLE):
        order = suffix_array(text)
        self.last = text[order - 1]  # the symbol before each suffix
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=largest + 1))])
        starts = np.zeros(len(text), dtype=bool)
        starts[0] = True
        starts[1:] = text[:-1] == 0
        self.sampled = starts[order] | (order % sample == 0)
        self.places = order[self.sampled]
        self.sampled_before = np.concatenate([[0], np.cumsum(self.sampled)])
        self.levels, self.zeros = [], []
        current = self.last
        for level in reversed(range(max(int(largest).bit_length(), 1))):
            ones = (current >> level & 1).astype(bool)
            self.levels.append(np.concatenate([[0], np.cumsum(ones)]))
            self.zeros.append(int((~ones).sum()))
            current = np.concatenate([current[~ones], current[ones]])
        self.size = len(text)

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place of the last column."""
        low, high = np.zeros(len(at), np.int64), at
        for k, (ones, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            bit = (symbols >> (len(self.levels) - 1 - k) & 1).astype(bool)
            low = np.where(bit, zeros + ones[low], low - ones[low])
            high = np.where(bit, zeros + ones[high], high - ones[high])
        return high - low

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases that occur, and the range of suffixes that begin with each."""
        which = np.arange(len(phrases))
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        for column in reversed(range(phrases.shape[1])):
            symbols = phrases[which, column]
            here = symbols > 0
            low, high = (np.where(here, self.smaller[symbols] + self.rank(symbols, x), x) for x in (low, high))
            left = low < high
            which, low, high = which[left], low[left], high[left]
        return which, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: steps back to the nearest sampled one."""
        out = np.empty(len(rows), np.int64)
        waiting, steps = np.arange(len(rows)), 0
        while len(waiting):
            found = self.sampled[rows]
            out[waiting[found]] = self.places[self.sampled_before[rows[found]]] + steps
            waiting, rows = waiting[~found], rows[~found]
            symbols = self.last[rows]
            rows = self.smaller[symbols] + self.rank(symbols, rows)
            steps += 1
        return out


def indexed_text(numbers: np.ndarray, owner: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of phrase words of at least ``least`` words, each with a break after it, and their word positions."""
    inside = np.zeros(len(numbers) + 2, dtype=bool)
    inside[1:-1] = numbers > 0
    edge = np.zeros(len(numbers) + 1, dtype=bool)
    edge[owner] = True
    opens = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    closes = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    long = closes - opens >= least
    opens, sizes = opens[long], (closes - opens)[long]
    at = np.repeat(opens, sizes + 1) + tx.runs(sizes + 1)
    text = np.zeros(len(at), np.int64)
    words = np.ones(len(at), dtype=bool)
    words[np.cumsum(sizes + 1) - 1] = False
    text[words] = numbers[at[words]]
    return text, at


def occurrences(words: Words, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(first word, phrase) of every occurrence of every phrase."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(phrases.rows):
        return none
    text, at = indexed_text(phrases.numbers(words.hashes), words.owner, int(phrases.lengths.min()))
    if not len(text):
        return none
    present = np.zeros(len(phrases.vocabulary) + 1, bool)
    present[text] = True
    present[0] = True  # stands for no word
    able = np.flatnonzero(present[phrases.rows].all(axis=1))
    if not len(able):
        return none
    index = FMIndex(text, len(phrases.vocabulary))
    which, low, high = index.search(np.asarray(phrases.rows[able], dtype=np.int64))
    sizes = high - low
    places = index.locate(np.repeat(low, sizes) + tx.runs(sizes))
    return at[places], np.repeat(able[which], sizes)


def hits(words: Words, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which words are hit, and the (document, item) pairs found."""
    first, phrase = occurrences(words, phrases)
    change = np.zeros(len(words.first) + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, first + phrases.lengths[phrase], -1)
    document = np.searchsorted(words.owner, first, side="right") - 1
    pairs = np.unique(document * max(len(phrases.rows), 1) + phrase)
    document, phrase = np.divmod(pairs, max(len(phrases.rows), 1))
    sizes = phrases.bounds[phrase + 1] - phrases.bounds[phrase]
    item = phrases.item[np.repeat(phrases.bounds[phrase], sizes) + tx.runs(sizes)]
    return np.cumsum(change[:-1]) > 0, np.repeat(document, sizes), item


def merged(words: Words, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Removal spans: document, first word and the word after the last, runs of hit words."""
    padded = np.zeros(len(hit) + 2, dtype=bool)
    padded[1:-1] = hit
    edge = np.zeros(len(hit) + 1, dtype=bool)
    edge[words.owner] = True
    first = np.flatnonzero(padded[1:-1] & (~padded[:-2] | edge[:-1]))
    last = np.flatnonzero(padded[1:-1] & (~padded[2:] | edge[1:])) + 1
    return np.searchsorted(words.owner, first, side="right") - 1, first, last


@dataclasses.dataclass
class PhraseSets:
    """Where the benchmark's phrases lie, in sets that tasks hold one at a time (a single one throughout)."""

    folder: str
    count: int

    def each(self) -> Iterator[Phrases]:
        for number in range(self.count):
            if self.count > 1 or not hasattr(self, "_only"):
                found = Phrases.read(self.folder, number)
                if self.count > 1:
                    yield found
                    continue
                self._only = found
            yield self._only


def phrase_sets(benchmark: DataFrame, window: int, limit: int = PHRASE_BYTES) -> PhraseSets:
    """Writes the benchmark's phrases to files, in as many sets as its size asks for; tasks make them.

    Rows without text have none; those without item_id are searched like others.
    """
    spark = benchmark.sparkSession
    rows = benchmark.where("text is not null").select(F.col("item_id").cast("string").alias("item"), "text").distinct()
    sets = -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // limit)
    found = PhraseSets(shared.folder(spark, "phrases"), sets)
    if not sets:
        return found
    folder = found.folder

    def write(group: pa.Table) -> pa.Table:
        number = group.column("part")[0].as_py()
        order = group.sort_by([("item", "ascending"), ("text", "ascending")])
        names, texts = (pa.concat_arrays(order.column(c).chunks) if order.num_rows else pa.array([], pa.string()) for c in ("item", "text"))
        Phrases.of(names, texts, window).write(folder, number)
        return pa.table({"part": pa.array([number], pa.int32())})

    dealt = rows.select(F.pmod(F.xxhash64("item", "text"), F.lit(sets)).cast("int").alias("part"), "item", "text")
    made = {r.part for r in dealt.groupBy("part").applyInArrow(write, "part int").collect()}
    for number in set(range(sets)) - made:
        Phrases.of(pa.array([], pa.string()), pa.array([], pa.string()), window).write(folder, number)
    return found


def found_in(words: Words, sets: PhraseSets) -> tuple[np.ndarray, list[set[str]]]:
    """Which words are hit by a phrase of any set, and each text's items."""
    hit = np.zeros(len(words.first), dtype=bool)
    items: list[set[str]] = [set() for _ in range(len(words.owner) - 1)]
    for phrases in sets.each():
        own, document, item = hits(words, phrases)
        hit |= own
        names = {k: phrases.name(k) for k in np.unique(item).tolist()}
        for i, k in zip(document.tolist(), item.tolist(), strict=True):
            items[i].add(names[k])
    return hit, items


def mark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, limit: int = PHRASE_BYTES,
         keep_text: bool = True) -> DataFrame:
    """The documents with ``n_words``, ``spans`` (word ranges hit, the last word excluded) and ``items``.

    ``items`` are the sorted distinct item_ids, as strings, with occurring windows; items
    without an id hit words but are not among them.  An item of fewer words than a window,
    but not none, is one window.  Null and empty texts have no words and no hits; repeated
    rows are marked alike; an empty benchmark marks nothing.  A column of the input with the
    name of an added one is replaced.
    """
    added = ["n_words", "spans", "items"]
    out = docs.drop(*added).withColumns({
        "n_words": F.lit(0).cast("long"), "spans": F.array().cast(SPANS), "items": F.array().cast("array<string>")})
    schema = out.schema if keep_text else out.drop("text").schema
    return docs.drop(*added).mapInArrow(_marker(phrase_sets(benchmark, window, limit), schema.names), schema)


def _marker(sets: PhraseSets, names: list[str]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = tx.Hasher()
        for block in tx.blocks(batches):
            words = Words(hasher, block.column("text"))
            hit, items = found_in(words, sets)
            holder, first, last = merged(words, hit)
            base = words.owner[holder]
            spans = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(holder, np.arange(block.num_rows + 1)), pa.int32()),
                pa.StructArray.from_arrays([pa.array(first - base), pa.array(last - base)], ["first", "last"]))
            columns = {name: block.column(name) for name in block.schema.names}
            columns |= {"n_words": pa.array(np.diff(words.owner)), "spans": spans,
                        "items": pa.array([sorted(own) for own in items], pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([columns[name] for name in names], names=names)

    return task


def cut_spans(block: pa.RecordBatch, sets: PhraseSets, hasher: tx.Hasher) -> tuple[list, np.ndarray]:
    """Texts without their spans, until no window of any set occurs, and whether any word is left in those that were cut."""
    texts = block.column("text").to_pylist()
    emptied = np.zeros(block.num_rows, dtype=bool)
    todo = np.arange(block.num_rows)
    column = block.column("text")
    while len(todo):
        words = Words(hasher, column)
        hit, _ = found_in(words, sets)
        holder, first, last = merged(words, hit)
        changed = np.unique(holder)
        raw = words.data.tobytes()
        for i in changed.tolist():
            at, pieces = int(words.offsets[i]), []
            for a, b in zip(first[holder == i].tolist(), last[holder == i].tolist(), strict=True):
                pieces.append(raw[at:words.first[a]])
                at = int(words.last[b - 1])
            pieces.append(raw[at:words.offsets[i + 1]])
            texts[todo[i]] = b"".join(pieces).decode()
            emptied[todo[i]] = hit[words.owner[i]:words.owner[i + 1]].all()
        todo = todo[changed]
        column = pa.array([texts[i] for i in todo], pa.string())
    return texts, emptied


def remove(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, limit: int = PHRASE_BYTES) -> DataFrame:
    """The documents, benchmark passages cut out of their texts; ``n_chars``, if there, follows.

    Cutting is repeated while the joined rest holds a window of any set, so the result does
    not depend on the sets.  A document left without words by the cut goes; all others, null
    and empty texts included, stay.
    """
    return docs.mapInArrow(_remover(phrase_sets(benchmark, window, limit)), docs.schema)


def _remover(sets: PhraseSets):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = tx.Hasher()
        for block in tx.blocks(batches):
            texts, emptied = cut_spans(block, sets, hasher)
            columns = {name: block.column(name) for name in block.schema.names}
            columns["text"] = pa.array(texts, block.schema.field("text").type)
            if "n_chars" in columns:
                kind = block.schema.field("n_chars").type
                same = pc.equal(columns["text"], block.column("text"))
                columns["n_chars"] = pc.if_else(pc.fill_null(same, True), columns["n_chars"], pc.utf8_length(columns["text"]).cast(kind))
            yield pa.RecordBatch.from_arrays(list(columns.values()), schema=block.schema).filter(pa.array(~emptied))

    return task


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: counts of words, hit words and items, and a digest of the items."""
    found = mark(docs.select("doc_id", "text"), benchmark, window, keep_text=False)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["last"] - s["first"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
