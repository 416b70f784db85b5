"""Language identification of mixed text: scripts, word scores, Viterbi labels.

Words are runs of letters.  Each word is scored under every language by a naive Bayes
model of its character n-grams (one to four bytes within the word and its edges), counted
over all training texts into a fixed table of hashed n-grams.  The script of a word's
letters first narrows the candidates to the languages that use it.  The labels of a text
are the best path over its words, where a change of language costs a penalty.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.llm import shared
from yearloom.llm import text as tx

#: Size of the table of hashed n-grams; bounds the model whatever the corpus.
TABLE_BITS = 16

#: Bytes of the n-grams.
ORDERS = (1, 2, 3, 4)

#: Cost, in natural log units, of changing the language between two words.
SWITCH = 8.0

#: Log score, in natural log units, that a word may count for or against a language.
WORD_CAP = 12.0

#: A language needs so many training words in a script to be a candidate for it.
SCRIPT_SHARE = 0.001

#: Bytes of text labelled at once, for up to so many languages; with more of them less, as the scores
#: of all words under all languages are held meanwhile.
BLOCK_BYTES, BLOCK_LANGUAGES, LEAST_BYTES = 1_000_000, 16, 20_000

#: Languages of a file of the model (256 kB each).
FILE_LANGUAGES = 64

UNDETERMINED = "und"

# Code points (first, last) by script.
SCRIPTS = (
    ("latin", 0x0041, 0x024F),
    ("greek", 0x0370, 0x03FF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F),
    ("indic", 0x0900, 0x0DFF),
    ("thai", 0x0E00, 0x0EFF),
    ("georgian", 0x10A0, 0x10FF),
    ("ethiopic", 0x1200, 0x139F),
    ("khmer", 0x1780, 0x17FF),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x1F00, 0x1FFF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
)

SCRIPT_NAMES = tuple(dict.fromkeys(name for name, _, _ in SCRIPTS)) + ("other",)

#: Words of a stretch of the Viterbi search; stretches of all texts are searched side by side.
STRETCH = 256

LABELS = ("doc_id long, held_out boolean, lang_pred string, score double, "
          "spans array<struct<lang: string, first: long, last: long>>")


@dataclasses.dataclass
class Model:
    """Which scripts each language uses; the log shares of hashed n-grams lie in files, some languages each."""

    languages: list[str]
    folder: str
    scripts: np.ndarray  # scripts x languages, true for candidates

    def parts(self) -> Iterator[np.ndarray]:
        """Log shares, languages x table, file by file; mapped where the folder is mounted."""
        for number in range(-(-len(self.languages) // FILE_LANGUAGES)):
            yield shared.read_array(f"{self.folder}/{number}", np.float32).reshape(-1, 1 << TABLE_BITS)

    @property
    def weights(self) -> np.ndarray:
        return np.concatenate([*self.parts()]) if self.languages else np.zeros((0, 1 << TABLE_BITS), np.float32)

    def block_bytes(self) -> int:
        return max(BLOCK_BYTES * BLOCK_LANGUAGES // max(BLOCK_LANGUAGES, len(self.languages)), LEAST_BYTES)


class Words:
    """The words of a block of texts, and its distinct ones."""

    def __init__(self, hasher: tx.Hasher, column: pa.Array):
        self.column = column
        data, self.offsets = tx.text_bytes(column)
        lowered = tx.lower_table()[data]
        accent = np.flatnonzero(lowered[:-1] == 0xC3) + 1 if len(lowered) else np.zeros(0, np.int64)
        accent = accent[(lowered[accent] >= 0x80) & (lowered[accent] <= 0x9E) & (lowered[accent] != 0x97)]
        lowered[accent] += 0x20  # capital Latin letters with accents
        letter = np.zeros(256, dtype=bool)
        letter[97:123] = letter[128:] = True
        self.data = lowered
        self.first, self.last, self.owner = tx.find_words(lowered, self.offsets, letter)
        _, self.sample, self.which = np.unique(hasher.ranges(lowered, self.first, self.last), return_index=True, return_inverse=True)

    def n_grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Table places of the n-grams of all distinct words, and the word of each."""
        first, sizes = self.first[self.sample], (self.last - self.first)[self.sample] + 2
        ends = np.cumsum(sizes)
        padded = np.full(int(sizes.sum()), 0x5F, np.uint8)
        word = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        place = tx.runs(sizes)
        inside = (place > 0) & (place < sizes[word] - 1)
        padded[inside] = self.data[(first[word] + place - 1)[inside]]
        left = ends[word] - np.arange(len(padded))  # bytes up to the end of the word
        del place, inside
        value, places, words = np.zeros(len(padded), np.uint64), [], []
        for k in range(max(ORDERS)):
            value[:len(padded) - k] |= padded[k:].astype(np.uint64) << np.uint64(8 * k)
            if k + 1 in ORDERS:
                whole = left > k
                mixed = tx.mix(value[whole] + (np.uint64(k + 1) << np.uint64(56)))
                places.append((mixed >> np.uint64(64 - TABLE_BITS)).astype(np.int32))
                words.append(word[whole])
        return np.concatenate(places), np.concatenate(words)

    def scripts(self) -> np.ndarray:
        """The script of the first letter of each distinct word."""
        at = self.first[self.sample]
        padded = np.concatenate([self.data, np.zeros(3, np.uint8)]).astype(np.int64)
        a, b, c = padded[at], padded[at + 1] & 63, padded[at + 2] & 63
        point = np.select([a < 0x80, a < 0xE0, a < 0xF0], [a, (a & 31) << 6 | b, (a & 15) << 12 | b << 6 | c], 0x10FFFF)
        starts = np.array([s for _, s, _ in SCRIPTS])
        stops = np.array([s for _, _, s in SCRIPTS])
        number = np.array([SCRIPT_NAMES.index(name) for name, _, _ in SCRIPTS])
        k = np.maximum(np.searchsorted(starts, point, side="right") - 1, 0)
        return np.where((starts[k] <= point) & (point <= stops[k]), number[k], len(SCRIPT_NAMES) - 1)

    def lettered(self) -> np.ndarray:
        """Which texts hold a letter of any script."""
        ascii_words = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum((self.data >= 97) & (self.data < 123), out=ascii_words[1:])
        plain = ascii_words[self.offsets[1:]] > ascii_words[self.offsets[:-1]]
        for i in np.flatnonzero(~plain & (np.diff(self.owner) > 0)).tolist():
            plain[i] = any(ch.isalpha() for ch in self.column[i].as_py())
        return plain


def learning_fold(folds: int = 4, fold: int = 2):
    """Whether a document is held out, by the checksum of its id; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds == fold


def fit(train: DataFrame) -> Model:
    """Counts the n-grams of all texts of ``train`` by ``lang``; rows without text or lang teach nothing."""
    table = 1 << TABLE_BITS

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, counts = tx.Hasher(), {}

        def told() -> Iterator[pa.RecordBatch]:
            for name, own in counts.items():
                places_used = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(places_used), pa.string()), pa.array(places_used.astype(np.int32)), pa.array(own[places_used])],
                    names=["lang", "place", "n"])
            counts.clear()

        for block in tx.blocks(batches, limit=BLOCK_BYTES):
            words = Words(hasher, block.column("text"))
            places, word = words.n_grams()
            scripts = words.scripts()
            langs = block.column("lang").dictionary_encode()
            owner = np.repeat(langs.indices.to_numpy(zero_copy_only=False), np.diff(words.owner))
            for k, name in enumerate(langs.dictionary.to_pylist()):
                if name not in counts and len(counts) >= FILE_LANGUAGES:
                    yield from told()
                seen = np.bincount(words.which[owner == k], minlength=len(words.sample))
                own = counts.setdefault(name, np.zeros(table + len(SCRIPT_NAMES), np.int64))
                own[:table] += np.bincount(places, weights=seen[word], minlength=table).astype(np.int64)
                own[table:] += np.bincount(scripts, weights=seen, minlength=len(SCRIPT_NAMES)).astype(np.int64)
        yield from told()

    counts = (
        train.where("text is not null and lang is not null").select("text", F.col("lang").cast("string").alias("lang"))
        .mapInArrow(task, "lang string, place int, n long").groupBy("lang", "place").agg(F.sum("n").alias("n"))
    )
    spark = train.sparkSession
    languages = sorted(r[0] for r in train.where("text is not null and lang is not null").select(
        F.col("lang").cast("string").alias("lang")).distinct().collect())
    folder, width = shared.folder(spark, "languages"), table + len(SCRIPT_NAMES)
    model = Model(languages, folder, np.ones((len(SCRIPT_NAMES), len(languages)), dtype=bool))
    if not languages:
        return model

    def write(group: pa.Table) -> pa.Table:
        """The weights of a file's languages; returns their words by script."""
        part = group.column("part")[0].as_py()
        here = min(FILE_LANGUAGES, len(languages) - part * FILE_LANGUAGES)
        totals = np.zeros((here, width))
        known = group.filter(group.column("place").is_valid())
        totals[known.column("number").to_numpy() - part * FILE_LANGUAGES, known.column("place").to_numpy()] = known.column("n").to_numpy()
        grams = totals[:, :table] + 0.5
        weights = np.log(grams / grams.sum(axis=1, keepdims=True)) / len(ORDERS)
        shared.write_array(f"{folder}/{part}", weights.astype("<f4"))
        return pa.table({"number": pa.array(part * FILE_LANGUAGES + np.arange(here), pa.int32()),
                         "scripts": pa.array(totals[:, table:].tolist(), pa.list_(pa.float64()))})

    numbered = spark.createDataFrame(list(enumerate(languages)), "number int, lang string")
    told = numbered.join(counts, "lang", "left").select(
        F.floor(F.col("number") / FILE_LANGUAGES).cast("int").alias("part"), "number", "place", "n")
    scripts = np.zeros((len(languages), len(SCRIPT_NAMES)))
    for row in told.groupBy("part").applyInArrow(write, "number int, scripts array<double>").collect():
        scripts[row.number] = row.scripts
    used = scripts > SCRIPT_SHARE * np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    model.scripts = used.T.copy()
    model.scripts[~model.scripts.any(axis=1)] = True  # a script that nobody uses rules nobody out
    return model


def word_scores(words: Words, model: Model) -> np.ndarray:
    """Scores of the distinct words under each language, at most ``WORD_CAP`` below the best candidate."""
    places, word = words.n_grams()
    out = np.stack([np.bincount(word, weights=w[places], minlength=len(words.sample)) for part in model.parts() for w in part], axis=1)
    allowed = model.scripts[words.scripts()]
    best = np.where(allowed, out, -np.inf).max(axis=1, keepdims=True)
    return np.where(allowed, np.maximum(out - best, -WORD_CAP), -2 * WORD_CAP)


def best_path(scores: np.ndarray, owner: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """The language of each word on the best path through its text.

    ``scores``: words x languages, all texts one after another; ``owner``: each text's
    first word.  Texts are cut into stretches, the values of the best paths between all first
    and last languages of a stretch are found side by side, and joined text by text; then each
    stretch is searched once more from the language it is entered with.  The result is that of
    one search over the whole text.
    """
    n_languages = scores.shape[1]
    per_text = -(-np.diff(owner) // STRETCH)
    text = np.repeat(np.arange(len(per_text)), per_text)
    starts = owner[text] + tx.runs(per_text) * STRETCH
    sizes = np.minimum(owner[text + 1] - starts, STRETCH)
    order = np.argsort(-sizes, kind="stable")
    active = np.searchsorted(-sizes[order], -np.arange(STRETCH), side="left")  # stretches longer than t
    state = np.full((len(starts), n_languages, n_languages), -np.inf)
    state[:, np.arange(n_languages), np.arange(n_languages)] = 0.0
    for t in range(int(sizes.max(initial=0))):
        live = state[:active[t]]
        switch = live.max(axis=2, keepdims=True) - penalty
        np.maximum(live, switch, out=live)
        live += scores[starts[order[:active[t]]] + t][:, None, :]
    spans = np.empty_like(state)
    spans[order] = state
    first_stretch = np.concatenate([[0], np.cumsum(per_text)])
    reached = np.zeros((len(per_text), n_languages))
    came = np.zeros((len(starts), n_languages), np.int64)
    for k in range(int(per_text.max(initial=0))):
        rows = np.flatnonzero(per_text > k)
        paths = reached[rows][:, :, None] + spans[first_stretch[rows] + k]
        came[first_stretch[rows] + k] = paths.argmax(axis=1)
        reached[rows] = paths.max(axis=1)
    entry, final = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    current = reached.argmax(axis=1)
    for k in reversed(range(int(per_text.max(initial=0)))):
        rows = np.flatnonzero(per_text > k)
        at = first_stretch[rows] + k
        final[at] = current[rows]
        entry[at] = came[at, current[rows]]
        current[rows] = entry[at]
    own = np.arange(n_languages)
    back = np.zeros((len(scores), n_languages), np.int32 if n_languages > 1 << 15 else np.int16)
    state = np.where(entry[order][:, None] == own, 0.0, -np.inf)
    for t in range(int(sizes.max(initial=0))):
        live = state[:active[t]]
        at = starts[order[:active[t]]] + t
        leader = live.argmax(axis=1)
        switch = np.take_along_axis(live, leader[:, None], axis=1) - penalty
        back[at] = np.where(live >= switch, own, leader[:, None])
        np.maximum(live, switch, out=live)
        live += scores[at]
    labels = np.zeros(len(scores), np.int64)
    for t in reversed(range(int(sizes.max(initial=0)))):
        here = np.flatnonzero(sizes > t)
        at = starts[here] + t
        labels[at] = final[here]
        final[here] = back[at, final[here]]
    return labels


class Labeler:
    """Labels blocks of texts."""

    def __init__(self, model: Model):
        self.model, self.hasher = model, tx.Hasher()

    def block(self, column: pa.Array) -> tuple[list[str], np.ndarray, pa.Array]:
        """The language, its share of the words' bytes, and labelled spans of words, for each text."""
        words, names = Words(self.hasher, column), self.model.languages
        n = len(column)
        if not names or not len(words.first):
            return [UNDETERMINED] * n, np.zeros(n), pa.array([[]] * n, LABEL_SPANS)
        labels = best_path(word_scores(words, self.model)[words.which], words.owner)
        text = np.repeat(np.arange(n), np.diff(words.owner))
        shares = np.zeros((n, len(names)))
        np.add.at(shares, (text, labels), words.last - words.first)
        best, lettered = shares.argmax(axis=1), words.lettered()
        score = np.where(lettered, shares.max(axis=1) / np.maximum(shares.sum(axis=1), 1), 0.0)
        change = np.ones(len(labels), dtype=bool)
        change[1:] = (labels[1:] != labels[:-1]) | (text[1:] != text[:-1])
        change &= lettered[text]
        first = np.flatnonzero(change)
        end = np.append(first[1:], len(labels))
        last = np.minimum(end, words.owner[text[first] + 1])
        base = words.owner[text[first]]
        spans = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(text[first], np.arange(n + 1)), pa.int32()),
            pa.StructArray.from_arrays([pa.array([names[i] for i in labels[first]], pa.string()), pa.array(first - base), pa.array(last - base)],
                                       ["lang", "first", "last"]))
        return [names[i] if has else UNDETERMINED for i, has in zip(best.tolist(), lettered.tolist(), strict=True)], score, spans


LABEL_SPANS = pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int64()), ("last", pa.int64())]))


def label(docs: DataFrame, model: Model) -> DataFrame:
    """Every text's language, the share of its words' bytes with that label, and the labelled spans.

    A span is a range of words (runs of letters), the last excluded.  Texts that are null or
    hold no letter are ``und`` with score 0 and no spans, as is every text if the model has
    learned no language; ties go to the first language by name; repeated rows are labelled
    alike.  ``docs`` has doc_id, text and held_out; other columns are not read.
    """
    sent = shared.sent(docs.sparkSession, model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeler = Labeler(shared.received(sent))
        for block in tx.blocks(batches, limit=labeler.model.block_bytes()):
            names, score, spans = labeler.block(block.column("text"))
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("held_out"), pa.array(names, pa.string()), pa.array(score), spans],
                names=["doc_id", "held_out", "lang_pred", "score", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "held_out").mapInArrow(task, LABELS)


def keep_identified(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The documents, unchanged, of which one language has at least ``least`` of the words' bytes."""
    sent = shared.sent(docs.sparkSession, model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeler = Labeler(shared.received(sent))
        for block in tx.blocks(batches, limit=labeler.model.block_bytes()):
            names, score, _ = labeler.block(block.column("text"))
            kept = np.array([n != UNDETERMINED for n in names]) & (score >= least)
            yield block.filter(pa.array(kept))

    return docs.mapInArrow(task, docs.schema)


def fit_and_label(docs: DataFrame) -> DataFrame:
    """Learns from the documents of three folds and labels all."""
    marked = docs.select("doc_id", "text", "lang", learning_fold().alias("held_out"))
    return label(marked, fit(marked.where("not held_out"))).drop("spans")
