"""Interpolated modified Kneser-Ney model of words, counted in Spark, read by memory mapping.

Words get whole-number ids in the order of their hashes.  The model is a set of sorted
arrays in the shared folder: hashes and counts of words, in shards of about equal numbers of
words, and (word before, word) pairs with their counts, in shards of about equal numbers of
tokens.  Scoring tasks map the arrays and look all words and pairs of a block up at once; no
task and no driver holds the model, or a number for each of its shards but in a mapped file.

    p(w | v) = max(c(vw) - D, 0) / c(v) + (D1 n1(v) + D2 n2(v) + D3 n3(v)) / c(v) * p(w)
    p(w)     = max(n(w) - D', 0) / n + (D1' m1 + D2' m2 + D3' m3) / n * 1 / (V + 1)

``n(w)`` counts the words seen before ``w``, ``n1(v)`` .. ``n3(v)`` the words seen once,
twice or more often after ``v``.  An unknown word has the share of one word in the last
term, so the probabilities after any word sum to 1 over the V words and one unknown.
"""

from __future__ import annotations

import dataclasses
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.llm import ngram_counts as nc
from yearloom.llm import shared
from yearloom.llm import text as tx

#: Stands for the end of a text among word hashes; a word with the same hash would be taken for it.
END = np.uint64(0x5851F42D4C957F2D)

#: Words of a shard; the statistics of so many are held at once.
SHARD_WORDS = 1 << 20

#: Bits of the key of a pair.
KEY_BITS = 64

#: Arrays a task keeps open, and bytes of those that it had to read because their folder is not mounted.
MOST_OPEN = 2_000
MOST_READ = 256_000_000

SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")


def tokens(hasher: tx.Hasher, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, each text with its end, and each text's first token."""
    data, offsets = tx.text_bytes(column)
    lowered = tx.lower_table()[data]
    first, last, owner = tx.find_words(lowered, offsets, tx.nonspace_mask())
    bounds = owner + np.arange(len(owner))
    out = np.full(int(bounds[-1]), END, np.uint64)
    words = np.ones(len(out), dtype=bool)
    words[bounds[1:] - 1] = False
    out[words] = hasher.ranges(lowered, first, last)
    return out, bounds


class Sharded:
    """A sorted array of unsigned keys in files, with arrays alongside; opened when needed, the longest unused closed."""

    def __init__(self, folder: str, name: str):
        self.folder, self.name = folder, name
        sizes, tokens = shared.read_array(f"{folder}/{name}-sizes", np.int64).reshape(2, -1)
        self.bases = np.concatenate([[0], np.cumsum(sizes)])
        self.token_bases = np.concatenate([[0], np.cumsum(tokens)])
        self.open: OrderedDict[tuple[str, int], np.ndarray] = OrderedDict()
        self.read = 0

    def part(self, what: str, shard: int, kind) -> np.ndarray:
        found = self.open.get((what, shard))
        if found is None:
            found = self.open[what, shard] = shared.read_array(f"{self.folder}/{self.name}-{what}-{shard:06d}", kind)
            self.read += _own_bytes(found)
            while len(self.open) > MOST_OPEN or (self.read > MOST_READ and len(self.open) > 1):
                self.read -= _own_bytes(self.open.popitem(last=False)[1])
        else:
            self.open.move_to_end((what, shard))
        return found

    def find(self, keys: np.ndarray, shard: np.ndarray) -> np.ndarray:
        """Places of keys over all shards, -1 where absent; ``shard`` must not decrease."""
        out = np.full(len(keys), -1, np.int64)
        for s, a, b in stretches(shard):
            if self.bases[s + 1] > self.bases[s]:
                own = self.part("keys", s, np.uint64)
                at = np.searchsorted(own, keys[a:b])
                there = own[np.minimum(at, len(own) - 1)] == keys[a:b]
                out[a:b][there] = at[there] + self.bases[s]
        return out

    def take(self, what: str, places: np.ndarray, kind) -> np.ndarray:
        """Values at places whose shards do not decrease; 0 at places of -1."""
        out = np.zeros(len(places), kind)
        shard = np.searchsorted(self.bases, places, side="right") - 1
        for s, a, b in stretches(shard):
            if s >= 0:
                out[a:b] = self.part(what, s, kind)[places[a:b] - self.bases[s]]
        return out


def _own_bytes(values: np.ndarray) -> int:
    """Bytes an array takes of a task's memory: none if it is mapped."""
    return 0 if isinstance(values, np.memmap) else values.nbytes


def stretches(shard: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, first, after the last) of each run of equal values."""
    if len(shard):
        first = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
        yield from zip(shard[first].tolist(), first.tolist(), np.append(first[1:], len(shard)).tolist(), strict=True)


@dataclasses.dataclass
class Model:
    """What a task needs to know of the model; the arrays stay in the files.

    ``cells`` are the shards words are first counted in, when nobody knows how many different
    ones there are; runs of cells make the ``word_shards``.
    """

    folder: str
    train_docs: int
    cells: int
    words: int = 0
    train_tokens: int = 0
    word_shards: int = 1
    pair_shards: int = 1
    word_bits: int = 1
    before_bits: int = 1
    cuts: list = None
    word_cuts: list = None
    ends: list = None

    def cell(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> np.uint64(32)) * np.uint64(self.cells) >> np.uint64(32)).astype(np.int64)

    def word_shard(self, hashes: np.ndarray) -> np.ndarray:
        return self.cell(hashes) * self.word_shards // self.cells

    def vocabulary(self) -> Sharded:
        return Sharded(self.folder, "words")

    def sized(self) -> Model:
        """The same with shards and keys of pairs that fit the numbers of words and tokens.

        A key is the id of the word and as many low bits of the one before as there is room
        for.  The words before in a shard are neighbours, no more than it has tokens, so that
        these bits tell them apart if there are four times as many numbers.
        """
        tokens = self.train_tokens + self.train_docs
        word_bits = max(self.words.bit_length(), 1)
        before_bits = KEY_BITS - word_bits
        shards = max(nc.shards_for(tokens), -(-tokens // max(1 << before_bits >> 2, 1)))
        return dataclasses.replace(self, word_bits=word_bits, before_bits=before_bits, pair_shards=shards)

    def pair_keys(self, before: np.ndarray, count: np.ndarray, earlier: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shards of pairs in order, of about equal numbers of tokens, frequent first words split by the second; and keys in them.

        ``earlier``: tokens of all words with smaller ids than the first word.
        """
        share = (earlier + count * (word / max(self.words, 1))) / max(self.train_tokens + self.train_docs, 1)
        shard = np.minimum((share * self.pair_shards).astype(np.int64), self.pair_shards - 1)
        low = before.astype(np.uint64) & np.uint64((1 << self.before_bits) - 1)
        return shard, low << np.uint64(self.word_bits) | word.astype(np.uint64)

    def words_of(self, keys: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words before, all of which follow ``first``, and of the words of the keys of a shard."""
        low = (keys >> np.uint64(self.word_bits)).astype(np.int64)
        before = first + ((low - first) & ((1 << self.before_bits) - 1))
        return before, (keys & np.uint64((1 << self.word_bits) - 1)).astype(np.int64)


class Lookup:
    """Ids and pairs of a block of texts, for counting and for scoring alike."""

    def __init__(self, model: Model):
        self.model, self.hasher = model, tx.Hasher()
        self.vocabulary = model.vocabulary()

    def block(self, column: pa.Array):
        """Ids (or -1), counts and tokens of earlier words, of the block's different words and, last, of a text's start;
        per token the place of its word and of the one before among these; per text its first token."""
        model = self.model
        hashes, bounds = tokens(self.hasher, column)
        distinct, which = np.unique(hashes, return_inverse=True)
        ids = self.vocabulary.find(distinct, model.word_shard(distinct))
        known = np.flatnonzero(ids >= 0)
        counts, earlier = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        counts[known] = self.vocabulary.take("counts", ids[known], np.int64)
        shard = np.searchsorted(self.vocabulary.bases, ids[known], side="right") - 1
        earlier[known] = self.vocabulary.take("earlier", ids[known], np.int64) + self.vocabulary.token_bases[shard]
        before = np.concatenate([[0], which])[:-1]
        before[bounds[:-1]] = len(ids)
        return (np.append(ids, model.words), np.append(counts, model.train_docs), np.append(earlier, model.train_tokens),
                which, before, bounds)

    def first_before(self, shard: int) -> int:
        """An id a few before the first word of a shard's pairs."""
        model, bases = self.model, self.vocabulary.token_bases
        token = max(shard * (model.train_tokens + model.train_docs) // model.pair_shards - 2, 0)
        if token >= model.train_tokens:
            return max(model.words - 4, 0)
        s = int(np.searchsorted(bases, token, side="right")) - 1
        at = int(np.searchsorted(self.vocabulary.part("earlier", s, np.int64), token - bases[s], side="right")) - 1
        return max(int(self.vocabulary.bases[s]) + at - 4, 0)


def _places(before: np.ndarray, which: np.ndarray) -> np.ndarray:
    """A number for each pair of places in a block."""
    return before.astype(np.uint64) << np.uint64(32) | which.astype(np.uint64)


def _parted(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)


def held_out(folds: int = 5, fold: int = 1):
    """Whether a document is held out, by the checksum of its id; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds == fold


def _listed(rows: DataFrame, folder: str, name: str, shards: int) -> tuple[int, int]:
    """Writes the sizes and tokens of all shards, (shard, n, tokens), to the file that ``Sharded`` reads; their sums."""
    path = f"{folder}/{name}-sizes"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((2, shards), np.int64)
        for batch in batches:
            for k, column in enumerate(("n", "tokens")):
                found[k][batch.column("shard").to_numpy()] = batch.column(column).to_numpy()
        shared.write_array(path, found)
        yield pa.RecordBatch.from_pydict({"n": [int(found[0].sum())], "tokens": [int(found[1].sum())]})

    done = rows.repartition(1).mapInArrow(task, "n long, tokens long").agg(F.sum("n"), F.sum("tokens")).first()
    if done[0] is None:  # Spark runs no task over a table it knows to be empty
        shared.write_array(path, np.zeros((2, shards), np.int64))
    return done[0] or 0, done[1] or 0


def fit(train: DataFrame) -> Model:
    """Counts words and pairs of all texts of ``train`` into files of the shared folder."""
    spark = train.sparkSession
    folder = shared.folder(spark, "word-model")
    size = train.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    docs = size[1]
    model = Model(folder, docs, nc.shards_for((size[0] or 0) // 8 + docs))
    cell = model.cell

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = tx.Hasher()
        parts = (nc.tally(tokens(hasher, block.column("text"))[0]) for block in tx.blocks(batches))
        yield from nc.collected((cell(keys), keys, counts) for keys, counts in parts)

    def merge_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, keys, counts in nc.merged(batches):
            yield nc.to_blobs(keys, counts, np.full(len(keys), shard))

    def write_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, keys, counts in nc.merged(batches):
            shared.write_array(f"{folder}/words-keys-{shard:06d}", keys)
            shared.write_array(f"{folder}/words-counts-{shard:06d}", counts)
            shared.write_array(f"{folder}/words-earlier-{shard:06d}", np.cumsum(counts) - counts)
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "n": [len(keys)], "tokens": [int(counts.sum())]})

    counted = shared.stored(
        train.select("text").mapInArrow(count_words, nc.BLOBS).repartitionById(model.cells, "shard")
        .mapInArrow(merge_words, nc.BLOBS), "word-model-words")
    words = counted.agg(F.sum("n")).first()[0] or 0
    model.word_shards = min(model.cells, max(1, -(-words // SHARD_WORDS)))
    shard = F.floor(F.col("shard").cast("long") * model.word_shards / model.cells).cast("int").alias("shard")
    written = (
        counted.select(shard, "n", "keys", "counts").repartitionById(model.word_shards, "shard")
        .mapInArrow(write_words, "shard int, n long, tokens long")
    )
    model.words, model.train_tokens = _listed(written, folder, "words", model.word_shards)
    return _count_pairs(train, model.sized())


def _count_pairs(train: DataFrame, model: Model) -> Model:
    folder = model.folder

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(model)

        def part(block: pa.RecordBatch):
            ids, counts, earlier, which, before, _ = lookup.block(block.column("text"))
            pairs, n = nc.tally(_places(before, which))
            b, w = _parted(pairs)
            return *model.pair_keys(ids[b], counts[b], earlier[b], ids[w]), n

        yield from nc.collected(part(block) for block in tx.blocks(batches))

    def write_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(model)
        for shard, keys, counts in nc.merged(batches):
            shared.write_array(f"{folder}/pairs-keys-{shard:06d}", keys)
            shared.write_array(f"{folder}/pairs-counts-{shard:06d}", np.minimum(counts, 255).astype(np.uint8))
            large = counts >= 255
            shared.write_array(f"{folder}/pairs-large-{shard:06d}", np.stack([np.flatnonzero(large), counts[large]]))
            yield from _word_statistics(lookup, shard, keys, counts)

    facts = shared.stored(
        train.select("text").mapInArrow(count_pairs, nc.BLOBS).repartitionById(model.pair_shards, "shard")
        .mapInArrow(write_pairs, FACTS), "word-model-facts")
    sizes = facts.where("kind = 0")
    _listed(sizes.select(F.col("part").alias("shard"), "n", F.lit(0).cast("long").alias("tokens")), folder, "pairs", model.pair_shards)
    model.cuts = nc.discounts(_sums(sizes, *[F.col("of")[k] for k in range(4)]))

    def write_statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = model.vocabulary()
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                s = row["shard"]
                if s not in held:
                    held[s] = np.zeros((4, int(vocabulary.bases[s + 1] - vocabulary.bases[s])), np.int64)
                at = np.cumsum(nc.unsqueeze(row["places"], row["n"], np.uint64)).astype(np.int64)
                for k, name in ((0, "n1"), (1, "n2"), (2, "n3")) if row["kind"] == 1 else ((3, "n1"),):
                    held[s][k][at] += nc.unsqueeze(row[name], row["n"], np.uint32)
        for s, (n1, n2, n3, followed) in held.items():
            counts = vocabulary.part("counts", s, np.int64)
            rest = (model.cuts[0] * n1 + model.cuts[1] * n2 + model.cuts[2] * n3) / counts
            shared.write_array(f"{folder}/words-rest-{s:06d}", rest)
            shared.write_array(f"{folder}/words-followed-{s:06d}", followed)
            yield pa.RecordBatch.from_pydict({"of": [nc.of_counts(followed)], "total": [int(followed.sum())]})

    words = (
        facts.where("kind in (1, 2)").select("kind", "shard", "n", "places", "n1", "n2", "n3")
        .repartitionById(model.word_shards, "shard").mapInArrow(write_statistics, "of array<long>, total long")
    )
    *of, total = _sums(words, *[F.col("of")[k] for k in range(4)], F.col("total"))
    start = _sums(facts.where("kind = 3"), F.col("n"), F.col("s2"), F.col("s3"))
    rest = sum(d * n for d, n in zip(model.cuts, start, strict=True)) / max(model.train_docs, 1)
    model.word_cuts = nc.discounts(of)
    model.ends = [total, of, rest]
    return model


def _sums(rows: DataFrame, *columns) -> list[int]:
    return [x or 0 for x in rows.agg(*[F.sum(c) for c in columns]).first()]


#: kind 0: a shard of pairs; 1: statistics of first words; 2: of second words; 3: of text starts.
FACTS = ("kind int, part int, shard int, n long, of array<long>, places binary, n1 binary, n2 binary, n3 binary, "
         "s2 long, s3 long")


def _word_statistics(lookup: Lookup, part: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What a shard of pairs says of words: how many different words follow and precede each."""
    model, bases = lookup.model, lookup.vocabulary.bases
    rows = [dict(kind=0, part=part, n=len(keys), of=nc.of_counts(counts))]
    before, word = model.words_of(keys, lookup.first_before(part))
    order = np.argsort(before, kind="stable")
    before, counts = before[order], counts[order]
    inner = int(np.searchsorted(before, model.words))
    rows.append(dict(kind=3, n=int((counts[inner:] == 1).sum()), s2=int((counts[inner:] == 2).sum()), s3=int((counts[inner:] > 2).sum())))

    def add(kind: int, ids: np.ndarray, columns: list[np.ndarray]) -> None:
        for s, a, b in stretches(np.searchsorted(bases, ids, side="right") - 1):
            places = np.diff((ids[a:b] - bases[s]).astype(np.uint64), prepend=np.uint64(0))
            names = zip(("n1", "n2", "n3"), columns, strict=False)
            rows.append(dict(kind=kind, shard=s, n=b - a, places=nc.squeeze(places),
                             **{name: nc.squeeze(x[a:b].astype(np.uint32)) for name, x in names}))

    first = np.flatnonzero(np.concatenate([[True], before[1:inner] != before[:inner - 1]])) if inner else np.zeros(0, np.int64)
    if inner:
        of_first = [np.add.reduceat((counts[:inner] == 1).astype(np.int64), first),
                    np.add.reduceat((counts[:inner] == 2).astype(np.int64), first),
                    np.add.reduceat((counts[:inner] > 2).astype(np.int64), first)]
        add(1, before[first], of_first)
    words, seen = np.unique(word, return_counts=True)
    add(2, words, [seen])
    schema = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("shard", pa.int32()), ("n", pa.int64()),
                        ("of", pa.list_(pa.int64())), ("places", pa.binary()), ("n1", pa.binary()), ("n2", pa.binary()),
                        ("n3", pa.binary()), ("s2", pa.int64()), ("s3", pa.int64())])
    for at in range(0, len(rows), 1_000):
        yield pa.RecordBatch.from_pylist(rows[at:at + 1_000], schema=schema)


class Scorer(Lookup):
    """Log10 probabilities of whole texts."""

    def __init__(self, model: Model):
        super().__init__(model)
        self.table = Sharded(model.folder, "pairs")

    def pair_counts(self, keys: np.ndarray, shard: np.ndarray) -> np.ndarray:
        places = self.table.find(keys, shard)
        found = np.flatnonzero(places >= 0)
        out = np.zeros(len(keys), np.int64)
        out[found] = self.table.take("counts", places[found], np.uint8)
        for i in found[out[found] == 255].tolist():
            s = int(np.searchsorted(self.table.bases, places[i], side="right") - 1)
            at, counts = self.table.part("large", s, np.int64).reshape(2, -1)
            out[i] = counts[np.searchsorted(at, places[i] - self.table.bases[s])]
        return out

    def texts(self, column: pa.Array):
        """Per text: tokens, known tokens, the unigram base and the model's log10 probability."""
        model = self.model
        ids, counts, earlier, which, before, bounds = self.block(column)
        base = np.log10((counts + 0.5) / (model.train_tokens + 0.5 * (model.words + 1)))
        known = np.flatnonzero(ids[:-1] >= 0)
        total, of, start_rest = model.ends
        lower = np.full(len(ids), 1.0 / (model.words + 1))
        rest = np.zeros(len(ids))
        rest[-1] = start_rest
        if total:
            lower *= sum(d * n for d, n in zip(model.word_cuts, [of[0], of[1], self._third()], strict=True)) / total
            followed = self.vocabulary.take("followed", ids[known], np.int64)
            lower[known] += nc.discounted(followed, model.word_cuts) / total
            rest[known] = self.vocabulary.take("rest", ids[known], np.float64)
        probability = lower[which]
        live = np.flatnonzero((ids[before] >= 0) & (counts[before] > 0))
        probability[live] *= rest[before[live]]
        seen = live[ids[which[live]] >= 0]
        pairs, back = np.unique(_places(before[seen], which[seen]), return_inverse=True)
        b, w = _parted(pairs)
        shard, keys = model.pair_keys(ids[b], counts[b], earlier[b], ids[w])
        probability[seen] += (nc.discounted(self.pair_counts(keys, shard), model.cuts) / counts[b])[back]
        return (np.diff(bounds), tx.segment_sums((ids >= 0)[which].astype(np.int64), bounds),
                tx.segment_sums(base[which], bounds), tx.segment_sums(np.log10(probability), bounds))

    def _third(self) -> int:
        """Words that follow three or more different ones."""
        of = self.model.ends[1]
        return self.model.words - of[0] - of[1]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Every text's tokens and log10 probabilities; null and empty texts are their end alone.

    ``docs`` has doc_id, text and held_out; repeated rows are scored alike.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for block in tx.blocks(batches):
            n, known, base, log10 = scorer.texts(block.column("text"))
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("held_out"), pa.array(n), pa.array(known),
                 pa.array(np.full(len(n), model.train_tokens)), pa.array(base), pa.array(log10)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "held_out").mapInArrow(task, SCORES)


def fit_and_score(docs: DataFrame) -> DataFrame:
    """Learns from the documents of four folds and scores all: one row per row of ``docs``, as in ``SCORES``.

    Null and empty texts are their end alone, in learning and scoring; a null id falls into the
    fold of the empty text.  Repeated rows are learned as often as they occur and scored alike;
    an empty table gives an empty result; other columns are not read.
    """
    marked = docs.select("doc_id", "text", held_out().alias("held_out"))
    return score(marked, fit(marked.where("not held_out")))
