"""Quality by perplexity under a Kneser-Ney model of characters, learned from trusted text.

The model is a table of n-grams of one to four characters with interpolated modified
Kneser-Ney probabilities and back-off weights, made by Spark joins of counts.  Texts do not
move: each block of documents asks for its distinct n-grams, the questions are joined with
the shards of the table, and the answers come back in files of many blocks, which a second
pass over the same blocks reads.  The shards grow with the table, the tasks that answer for
a shard and the files of answers with the texts.  A block that finds no answers (its table was split
differently the second time) takes them from the table's files, with the same result.

A document is kept if its perplexity, less a fixed allowance per text, does not exceed a
high quantile of the trusted documents of its language that the model has not learned from,
and if the same holds for its most surprising stretch of a few characters.
"""

from __future__ import annotations

import dataclasses
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearloom.llm import ngram_counts as nc
from yearloom.llm import shared
from yearloom.llm import text as tx

#: Characters of the longest n-grams.
ORDER = 4

#: Bytes of text in a block.
BLOCK_BYTES = 3_000_000

#: N-grams of a shard of the table, bytes of text whose questions a task answers, and of those a file of answers is for.
SHARD_GRAMS = 1 << 18
TASK_BYTES = 16_000_000
FILE_BYTES = 64_000_000

#: Trusted documents the model learns from, those with the smallest hash of their id.
MOST_TRUSTED = 20_000

#: Share of the trusted texts, those with the smallest hashes, that only the thresholds are taken from.
HELD_OUT = 0.2

#: Held-out documents a language needs for a threshold of its own.
LEAST_TRUSTED = 30

#: Held-out documents a language with fewer needs for a median, to which the usual distance from medians is added.
LEAST_MEDIAN = 5

#: Quantile of the trusted documents' perplexity, and how far beyond it, in nats a character, is still kept.
QUANTILE = 0.995
MARGIN = 0.05

#: Nats of a text that count for nothing: short texts vary most, and a few odd words do not make one bad.
SLACK = 25.0

#: Characters of the stretches whose worst one is judged as well: about a word.
STRETCH = 8

#: What is taken off the worst stretch, in nats a character, for each doubling of the number of stretches it is the worst of.
DOUBLING = 0.1

#: Stand for the start and the end of a text; no text holds these code points.
START, END = 0x110000, 0x110001

#: Keys of a dense table of n-grams; beyond it they are sorted.
DENSE = 1 << 25

#: Values that must both not exceed their thresholds.
JUDGED = ("surprise", "stretch")

SCORES = "doc_id long, lang string, n_chars_scored long, log_perplexity double, surprise double, stretch double"


class Grams:
    """The distinct n-grams of a block of texts, by order, and the longest one that ends at each character.

    ``at``: the number of the longest n-gram that ends at each place of the padded sequence;
    ``keys[m]``: 64-bit hashes of the distinct m-grams; ``parent[m]`` and ``tail[m]``: the
    numbers of their first and last m - 1 characters.  ``scored`` marks the places of
    characters and ends, ``bounds`` each text's first of them.
    """

    def __init__(self, column: pa.Array, order: int = ORDER):
        data, offsets = tx.text_bytes(column)
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.int32).copy()
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        points[(points >= 48) & (points <= 57)] = 48
        sizes = np.diff(chars) + order
        ends = np.cumsum(sizes)
        sequence = np.full(int(sizes.sum()), START, np.int32)
        sequence[ends - 1] = END
        inner = tx.runs(sizes) >= order - 1
        self.scored = inner.copy()
        self.bounds = np.concatenate([[0], np.cumsum(sizes - (order - 1))])
        inner[ends - 1] = False
        sequence[inner] = points
        del data, points, inner
        self.symbols, self.at = _numbered(sequence, END + 1)
        first, width = self.at, len(self.symbols)
        self.keys = [None, tx.mix(self.symbols.astype(np.uint64) + np.uint64(1 << 32))]
        self.parent, self.tail = [None, None], [None, None]
        for m in range(2, order + 1):
            joint = np.zeros(len(first), np.int64)  # the first place of a block is a start
            joint[1:] = self.at[:-1]
            joint *= width
            joint += first
            distinct, number = _numbered(joint, len(self.keys[m - 1]) * width)
            del joint
            prefix, last = np.divmod(distinct, width)
            tail = np.empty(len(distinct), np.int32)
            tail[number] = self.at
            self.at = number
            self.parent.append(prefix)
            self.tail.append(tail)
            self.keys.append(tx.mix(self.keys[m - 1][prefix] * np.uint64(0x9E3779B97F4A7C15) + self.symbols[last].astype(np.uint64)))

    def name(self) -> int:
        """A number for the block, from its contents."""
        counts = np.bincount(self.at).astype(np.uint64)
        parts = np.concatenate([tx.mix(self.keys[-1] ^ counts), tx.mix(self.bounds.astype(np.uint64))])
        return int(parts.sum(dtype=np.uint64, keepdims=True).view(np.int64)[0])

    def questions(self) -> np.ndarray:
        """All distinct n-grams of all orders, sorted by key."""
        return np.unique(np.concatenate(self.keys[1:]))


def _numbered(values: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and the number of each value among them."""
    if limit > DENSE:
        distinct, number = np.unique(values, return_inverse=True)
        return distinct, number.astype(np.int32)
    seen = np.zeros(limit, dtype=bool)
    seen[values] = True
    distinct = np.flatnonzero(seen)
    number = np.zeros(limit, np.int32)
    number[distinct] = np.arange(len(distinct), dtype=np.int32)
    return distinct, number[values]


@dataclasses.dataclass
class Model:
    """Where the table's files are and what an unseen character costs; among how many tasks the questions
    to a shard are divided, and in how many files the answers come."""

    folder: str
    shards: int
    unseen: float
    slices: int = 1
    files: int = 1

    def shard(self, keys: np.ndarray) -> np.ndarray:
        return ((keys >> np.uint64(32)) * np.uint64(self.shards) >> np.uint64(32)).astype(np.int64)

    def answer(self, shard: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log probabilities and back-off weights of sorted keys of a shard; not a number where absent."""
        own = shared.read_array(f"{self.folder}/keys-{shard:06d}", np.uint64)
        out = np.full(len(keys), np.nan, np.float32), np.full(len(keys), np.nan, np.float32)
        if len(own):
            at = np.minimum(np.searchsorted(own, keys), len(own) - 1)
            found = own[at] == keys
            for values, name in zip(out, ("log", "rest"), strict=True):
                values[found] = shared.read_array(f"{self.folder}/{name}-{shard:06d}", np.float32)[at[found]]
        return out


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return tx.blocks(batches, limit=BLOCK_BYTES)


def _counts(trusted: DataFrame, order: int) -> DataFrame:
    """Longest n-grams of all texts with counts; the keys of their last m characters, g1 .. , and of those without the last, c2 .."""
    names = [f"g{m}" for m in range(1, order + 1)] + [f"c{m}" for m in range(2, order + 1)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            grams = Grams(block.column("text"), order)
            n = np.bincount(grams.at[grams.scored], minlength=len(grams.keys[order]))
            gram = np.flatnonzero(n)
            columns = {"n": n[gram]}
            for m in range(order, 0, -1):
                columns[f"g{m}"] = grams.keys[m][gram].view(np.int64)
                if m > 1:
                    columns[f"c{m}"] = grams.keys[m - 1][grams.parent[m][gram]].view(np.int64)
                    gram = grams.tail[m][gram]
            yield pa.RecordBatch.from_arrays([pa.array(columns[c]) for c in ["n", *names]], names=["n", *names])

    rows = trusted.select("text").mapInArrow(task, ", ".join(f"{c} long" for c in ["n", *names]))
    return rows.groupBy(*names).agg(F.sum("n").alias("n"))


def table(trusted: DataFrame, order: int = ORDER) -> tuple[DataFrame, float, int]:
    """The model's rows (key, log, rest), the log probability of a character never seen, and the number of n-grams."""
    levels = [None] * order + [shared.stored(_counts(trusted, order), "quality-counts")]
    for m in range(order - 1, 0, -1):  # below the top, how many different characters come before
        names = [f"g{k}" for k in range(1, m + 1)] + [f"c{k}" for k in range(2, m + 1)]
        levels[m] = shared.stored(levels[m + 1].groupBy(*names).agg(F.count("*").alias("n")), "quality-counts")
    cuts = []
    for m in range(1, order + 1):
        seen = levels[m].agg(*[F.sum((F.col("n") == k).cast("long")) for k in (1, 2, 3, 4)], F.sum("n"), F.count("*")).first()
        cuts.append((nc.discounts([x or 0 for x in seen[:4]]), seen))

    def kept(m: int):
        one, two, three = (F.lit(d) for d in cuts[m - 1][0])
        n = F.col("n")
        return F.greatest(n - F.when(n == 1, one).when(n == 2, two).otherwise(three), F.lit(0.0))

    def weight(m: int):
        one, two, three = cuts[m - 1][0]
        n = F.col("n")
        return F.sum(F.when(n == 1, one).when(n == 2, two).otherwise(three)) / F.sum("n")

    (one, two, three), seen = cuts[0]
    total, words = float(seen[4] or 0), seen[5]
    spread = (one * (seen[0] or 0) + two * (seen[1] or 0) + three * (words - (seen[0] or 0) - (seen[1] or 0))) / total if total else 1.0
    floor = spread / (words + 1)
    below = levels[1].select(F.col("g1").alias("key"), (kept(1) / max(total, 1.0) + floor).alias("p"))
    grams, rests = [below], []
    for m in range(2, order + 1):
        contexts = levels[m].groupBy(F.col(f"c{m}").alias("context")).agg(F.sum("n").alias("total"), weight(m).alias("rest"))
        rests.append(contexts.select(F.col("context").alias("key"), "rest"))
        below = shared.stored(
            levels[m].join(contexts, F.col(f"c{m}") == F.col("context")).join(below, F.col(f"g{m - 1}") == F.col("key"))
            .select(F.col(f"g{m}").alias("key"), (kept(m) / F.col("total") + F.col("rest") * F.col("p")).alias("p")), "quality-grams")
        grams.append(below)
    rows = None
    for part, name in [*((g, "p") for g in grams), *((r, "rest") for r in rests)]:
        part = part.select("key", *[F.ln(name).alias(x) if y == name else F.lit(None).cast("double").alias(x)
                                    for x, y in (("log", "p"), ("rest", "rest"))])
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy("key").agg(F.max("log").alias("log"), F.max("rest").alias("rest")), math.log(floor), sum(seen[5] for _, seen in cuts)


def fit(docs: DataFrame, trusted_ids: DataFrame, order: int = ORDER) -> Model:
    """Learns from the documents with the given ids; the table goes to files, one set per shard."""
    spark = docs.sparkSession
    folder = shared.folder(spark, "quality-model")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    trusted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(trusted_ids), "doc_id").where("text is not null")
    rows, unseen, grams = table(trusted, order)
    shards = max(16, -(-grams // SHARD_GRAMS))
    model = Model(folder, shards, unseen, max(1, -(-size // (shards * TASK_BYTES))), max(1, -(-size // FILE_BYTES)))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(list(batches), ROWS)
        keys = held.column("key").to_numpy().view(np.uint64)
        order = np.argsort(keys)
        owner = model.shard(keys[order])
        for shard in np.unique(owner).tolist():
            own = order[owner == shard]
            shared.write_array(f"{folder}/keys-{shard:06d}", keys[own])
            for name in ("log", "rest"):
                shared.write_array(f"{folder}/{name}-{shard:06d}", held.column(name).to_numpy()[own].astype(np.float32))
            yield pa.RecordBatch.from_pydict({"shard": [shard], "n": [len(own)]})

    # the shard of a key, as Model.shard has it: its upper half, as a share of 2**32
    shard = F.shiftright(F.shiftrightunsigned("key", 32) * model.shards, 32).cast("int")
    written = rows.repartitionById(model.shards, shard).mapInArrow(write, "shard long, n long").collect()
    for s in set(range(model.shards)) - {r.shard for r in written}:
        shared.write_array(f"{folder}/keys-{s:06d}", np.zeros(0, np.uint64))
    return model


ROWS = pa.schema([("key", pa.int64()), ("log", pa.float64()), ("rest", pa.float64())])


def answers(docs: DataFrame, model: Model, order: int = ORDER) -> str:
    """Joins the blocks' n-grams with the shards of the table; returns the folder of the answers."""
    folder = shared.folder(docs.sparkSession, "quality-answers")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            grams = Grams(block.column("text"), order)
            keys = grams.questions()
            blobs = nc.to_blobs(keys, None, model.shard(keys))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(blobs.num_rows, grams.name())), *blobs.columns],
                                             names=["block", "shard", "n", "keys"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            found = [model.answer(r["shard"], np.cumsum(nc.unsqueeze(r["keys"], r["n"], np.uint64), dtype=np.uint64)) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("shard"), batch.column("n"), pa.array([nc.squeeze(x) for x, _ in found], pa.binary()),
                 pa.array([nc.squeeze(x) for _, x in found], pa.binary())], names=["block", "shard", "n", "log", "rest"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        last = None
        for row in (r for batch in batches for r in batch.to_pylist()):
            if last != (row["block"], row["shard"]):  # equal blocks ask twice
                held.setdefault(row["block"], []).append([nc.unsqueeze(row[c], row["n"], np.float32) for c in ("log", "rest")])
            last = row["block"], row["shard"]
        if held:
            write_answers(folder, model.files, {name: np.concatenate([x[k] for k in (0, 1) for x in parts]) for name, parts in held.items()})
            yield pa.RecordBatch.from_pydict({"block": list(held)})

    task = F.col("shard") * model.slices + F.pmod("block", F.lit(model.slices)).cast("int")
    file = F.pmod("block", F.lit(model.files)).cast("int")
    (
        docs.select("text").mapInArrow(ask, "block long, shard int, n long, keys binary")
        .repartitionById(model.shards * model.slices, task)
        .mapInArrow(answer, "block long, shard int, n long, log binary, rest binary")
        .repartitionById(model.files, file).sortWithinPartitions("block", "shard").mapInArrow(write, "block long").agg(F.count("*")).collect()
    )
    return folder


def write_answers(folder: str, files: int, blocks: dict[int, np.ndarray]) -> None:
    """One file of the answers to some blocks, all of the same remainder: their number, names, places and sizes, then the values."""
    sizes = np.array([len(x) for x in blocks.values()], np.int64)
    first = 8 + 24 * len(blocks) + 4 * (np.cumsum(sizes) - sizes)
    head = np.concatenate([[len(blocks)], list(blocks), first, sizes]).astype(np.int64)
    shared.write_file(f"{folder}/{next(iter(blocks)) % files:06d}", [head, *blocks.values()])


def read_answers(folder: str, files: int, name: int) -> np.ndarray | None:
    """The answers to a block, None where it is not known."""
    path = f"{folder}/{name % files:06d}"
    try:
        n = int(shared.read_range(path, np.int64, 0, 1)[0])
    except FileNotFoundError:
        return None
    names, first, sizes = shared.read_range(path, np.int64, 8, 3 * n).reshape(3, n)
    at = np.flatnonzero(names == name)
    return shared.read_range(path, np.float32, int(first[at[0]]), int(sizes[at[0]])) if len(at) else None


def block_values(grams: Grams, model: Model, folder: str) -> np.ndarray:
    """Log probability of each character of the texts, their ends included."""
    keys = grams.questions()
    raw = read_answers(folder, model.files, grams.name())
    if raw is not None and len(raw) == 2 * len(keys):
        log, rest = raw.reshape(2, -1)
    else:
        shard = model.shard(keys)
        parts = [model.answer(s, keys[shard == s]) for s in np.unique(shard).tolist()]
        log, rest = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    value = None
    for m in range(1, len(grams.keys)):
        at = np.searchsorted(keys, grams.keys[m])
        own = log[at].astype(np.float64)
        if m == 1:
            value = np.where(np.isnan(own), model.unseen, own)
        else:
            weight = rest[np.searchsorted(keys, grams.keys[m - 1])][grams.parent[m]].astype(np.float64)
            value = np.where(np.isnan(own), np.where(np.isnan(weight), 0.0, weight) + value[grams.tail[m]], own)
    return value[grams.at[grams.scored]]


def block_scores(grams: Grams, model: Model, folder: str) -> tuple[np.ndarray, np.ndarray]:
    """Characters scored (the end of the text included) and log probability of each text."""
    return np.diff(grams.bounds), tx.segment_sums(block_values(grams, model, folder), grams.bounds)


def surprise(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """What is judged: nats a character beyond the allowance of a text."""
    return np.maximum(-total - SLACK, 0.0) / n


def worst_stretch(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Nats a character of each text's worst ``STRETCH`` characters, less what its length explains."""
    sums = np.concatenate([[0.0], np.cumsum(-values)])
    n = np.diff(bounds)
    if not len(n):
        return np.zeros(0)
    first = np.maximum(np.arange(1, len(sums)) - STRETCH, np.repeat(bounds[:-1], n))
    worst = np.maximum.reduceat(sums[1:] - sums[first], bounds[:-1])
    return worst / STRETCH - DOUBLING * np.log2(np.maximum(n - STRETCH + 1, 1))


def judged(grams: Grams, model: Model, folder: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Characters scored, log probability, surprise and worst stretch of each text."""
    values = block_values(grams, model, folder)
    n, total = np.diff(grams.bounds), tx.segment_sums(values, grams.bounds)
    return n, total, surprise(n, total), worst_stretch(values, grams.bounds)


def score(docs: DataFrame, model: Model, folder: str) -> DataFrame:
    """doc_id, lang, n_chars_scored, log_perplexity (nats a character), surprise and stretch of every document; null for no text."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            n, total, whole, worst = judged(Grams(block.column("text")), model, folder)
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("lang"), pa.array(n - 1), pa.array(-total / n, mask=n == 1),
                 pa.array(whole, mask=n == 1), pa.array(worst, mask=n == 1)],
                names=["doc_id", "lang", "n_chars_scored", "log_perplexity", "surprise", "stretch"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text").mapInArrow(task, SCORES)


def trusted_documents(labels: DataFrame) -> DataFrame:
    """Ids whose labels all say good quality and none toxic."""
    good = F.min(F.when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 1).otherwise(0))
    return labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(good.alias("good")).where("good = 1").select("doc_id")


def folds(docs: DataFrame, trusted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ids the model learns from, and ids held out of it, whatever their number; equal texts lie on one side."""
    own = docs.where("text <> ''").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h")).join(trusted, "doc_id")
    own = shared.stored(own.groupBy("doc_id").agg(F.min("h").alias("h")), "quality-trusted")
    edge = F.lit(own.select("h").distinct().agg(F.percentile_approx("h", HELD_OUT, 10_000)).first()[0]).cast("long")
    learned = own.where(F.col("h") > edge).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_TRUSTED)
    return learned, own.where(F.col("h") <= edge).select("doc_id")


def by_language(values: dict, other: float | None) -> Column:
    """The value of a row's language, as a column."""
    out = F.lit(other).cast("double")
    for lang, own in values.items():
        out = F.when(F.col("lang").eqNullSafe(F.lit(lang)), F.lit(own)).otherwise(out)
    return out


def thresholds(scores: DataFrame, held: DataFrame) -> tuple[dict, dict]:
    """The highest kept values of each of ``JUDGED``, by language, and for languages with too few held-out documents.

    Surprise follows its language, so a median and the usual distance say enough of one with
    few; worst stretches are rare strings, whose tail only many documents show.
    """
    own = scores.where("surprise is not null").join(held, "doc_id")

    def high(value):
        return F.percentile_approx(value, QUANTILE, 100_000) + MARGIN

    found = own.groupBy("lang").agg(F.count("*").alias("n"), F.percentile_approx("surprise", 0.5, 100_000).alias("middle"), *[high(c).alias(c) for c in JUDGED])
    found = found.where(F.col("n") >= LEAST_MEDIAN).collect()
    away = F.col("surprise") - by_language({r.lang: r.middle for r in found}, None)
    *other, distance = own.agg(*[high(c) for c in JUDGED], high(away)).first()
    cuts = {c: {r.lang: r[c] for r in found if r.n >= LEAST_TRUSTED} for c in JUDGED}
    cuts["surprise"] |= {r.lang: r.middle + distance for r in found if r.n < LEAST_TRUSTED}
    return cuts, dict(zip(JUDGED, other, strict=True))


@dataclasses.dataclass
class Judge:
    """A fitted classifier for one table of documents."""

    model: Model
    folder: str
    cuts: dict
    other: dict

    def cut(self, what: str, lang: str | None) -> float:
        return self.cuts[what].get(lang, math.inf if self.other[what] is None else self.other[what])


def fit_judge(docs: DataFrame, labels: DataFrame) -> tuple[Judge, DataFrame]:
    """The classifier of ``docs``, and the scores of all documents."""
    learned, held = folds(docs, trusted_documents(labels))
    model = fit(docs, learned)
    folder = answers(docs, model)
    scores = shared.stored(score(docs, model, folder), "quality-scores")
    return Judge(model, folder, *thresholds(scores, held)), scores


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, lang, n_chars_scored, log_perplexity, surprise, stretch, threshold,
    stretch_threshold, kept.

    Null and empty texts have no perplexity and are not kept.  Languages (a null one is one
    too) with few held-out documents take their median and the usual distance from medians,
    those with hardly any a threshold over all held-out ones; without any
    trusted document every text is kept, its threshold null.  Repeated rows are judged alike;
    an empty table gives an empty result.
    """
    judge, scores = fit_judge(docs, labels)
    cuts = [by_language(judge.cuts[c], judge.other[c]).alias(name) for c, name in zip(JUDGED, ("threshold", "stretch_threshold"), strict=True)]
    within = [F.coalesce(F.col(cut), F.lit(math.inf)) >= F.col(c) for c, cut in zip(JUDGED, ("threshold", "stretch_threshold"), strict=True)]
    return scores.select("*", *cuts).withColumn("kept", F.coalesce(within[0] & within[1], F.lit(False)))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that ``classify`` keeps, unchanged, filtered where they are."""
    judge, _ = fit_judge(docs, labels)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            n, _, whole, worst = judged(Grams(block.column("text")), judge.model, judge.folder)
            langs = block.column("lang").cast(pa.string()).to_pylist()
            cuts = [np.array([judge.cut(c, lang) for lang in langs]) for c in JUDGED]
            yield block.filter(pa.array((n > 1) & (whole <= cuts[0]) & (worst <= cuts[1])))

    return docs.mapInArrow(task, docs.schema)
