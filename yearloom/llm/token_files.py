"""Token ids in binary files: frequency-ranked, variable-length, separate control bytes.

A file holds a range of documents in ascending doc_id order.  Ids are replaced by their
rank by frequency in the file, so most fit one byte.  Each rank takes 1 to 4 bytes; the
byte counts, two bits each, stand apart as control bytes for four ranks.  A reader looks
a control byte up in a table of its four lengths and gathers all ranks at once.

Layout, little-endian: ``magic, documents, ids, distinct ids, documents without id`` (int64),
the ids by rank (uint32), doc_ids (int64), ids per document (int64), control bytes, data
bytes.  Documents without a doc_id come first, with 0 in the place of theirs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from yearloom.llm import shared
from yearloom.llm import tokens as tk

MAGIC = 0x32304B54  # "TK02"
HEAD_BYTES = 40

#: Ids after which a task starts a new file.
FILE_IDS = 4_000_000

#: Characters of a text that decide in which file it goes, where doc_ids are equal.
DEALT_BY = 64

WRITTEN = "file string, part int, piece int, documents long, ids long"
READ = "file string, doc_id long, before long, n_tokens long, ids_crc32 long"


def length_table() -> np.ndarray:
    """Byte counts of the four ranks that a control byte stands for."""
    codes = np.arange(256)
    return np.stack([(codes >> shift & 3) + 1 for shift in (0, 2, 4, 6)], axis=1).astype(np.int64)


def encode(ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Control bytes and data bytes of ranks below 2**32."""
    ranks = ranks.astype("<u4")
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[:len(ranks)] = extra
    four = padded.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    kept = np.arange(4, dtype=np.uint8) <= extra[:, None]
    return control, ranks.view(np.uint8).reshape(-1, 4)[kept]


def decode(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The ranks again, by table lookup."""
    lengths = length_table()[control].reshape(-1)[:n]
    starts = np.cumsum(lengths) - lengths
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    ranks = padded[starts].astype(np.uint32)
    for byte in (1, 2, 3):
        wide = np.flatnonzero(lengths > byte)
        ranks[wide] |= padded[starts[wide] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return ranks


def pack_file(doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray, nameless: int = 0) -> list[np.ndarray]:
    """The parts of a file; its first ``nameless`` documents have no doc_id."""
    seen = np.bincount(ids, minlength=1)  # as long as the vocabulary
    distinct = np.flatnonzero(seen)
    by_rank = distinct[np.lexsort((distinct, -seen[distinct]))]
    rank = np.empty(len(seen), np.uint32)
    rank[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    control, data = encode(rank[ids])
    head = np.array([MAGIC, len(doc_ids), len(ids), len(by_rank), nameless], "<i8")
    return [head, by_rank.astype("<u4"), doc_ids.astype("<i8"), counts.astype("<i8"), control, data]


def unpack_head(content: bytes) -> tuple[int, int, int, int]:
    """Documents, ids, distinct ids and documents without a doc_id."""
    magic, *numbers = np.frombuffer(content, "<i8", HEAD_BYTES // 8).tolist()
    if magic != MAGIC:
        raise ValueError("not a token file")
    return tuple(numbers)


def unpack_file(content: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """doc_ids, ids per document and all ids of a file, and how many of its first documents have no doc_id."""
    documents, ids, distinct, nameless = unpack_head(content)
    at = HEAD_BYTES
    by_rank = np.frombuffer(content, "<u4", distinct, at)
    at += 4 * distinct
    doc_ids = np.frombuffer(content, "<i8", documents, at)
    counts = np.frombuffer(content, "<i8", documents, at + 8 * documents)
    at += 16 * documents
    control = np.frombuffer(content, np.uint8, -(-ids // 4), at)
    data = np.frombuffer(content, np.uint8, offset=at + len(control))
    return doc_ids, counts, by_rank[decode(control, data, ids)], nameless


def write(docs: DataFrame, folder: str, tokenizer: str, end: int, file_ids: int = FILE_IDS) -> DataFrame:
    """Writes the ids of all documents in ascending doc_id order; returns the files' manifest.

    Documents are dealt by ranges of doc_id (equal ones by the beginnings of their texts)
    and sorted; a task writes one file after another.  Rows without a doc_id come first.
    Equal doc_ids are ordered by text; null texts are the end id alone; an empty table
    leaves no file.  Other columns are not read.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]] = []
        size = piece = 0

        def flush() -> pa.RecordBatch:
            doc_ids, counts, ids = (np.concatenate([x[k] for x in held]) for k in range(3))
            name = f"ids-{part:06d}-{piece:06d}.tok"
            shared.write_file(f"{folder}/{name}", pack_file(doc_ids, counts, ids, sum(x[3] for x in held)))
            return pa.RecordBatch.from_pydict(
                {"file": [name], "part": pa.array([part], pa.int32()), "piece": pa.array([piece], pa.int32()),
                 "documents": [len(doc_ids)], "ids": [len(ids)]})

        for block, ids, bounds in tk.encoded(batches, tokenizer, False, end):
            named = block.column("doc_id")
            held.append((pc.fill_null(named, 0).to_numpy(zero_copy_only=False), np.diff(bounds), ids, named.null_count))
            size += len(ids)
            if size >= file_ids:
                yield flush()
                held, size, piece = [], 0, piece + 1
        if held:
            yield flush()

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id", F.substring("text", 1, DEALT_BY)).sortWithinPartitions("doc_id", "text")
    )
    return shared.stored(ordered.mapInArrow(task, WRITTEN), "token-files")


def starts(folder: str, manifest: DataFrame) -> DataFrame:
    """Per file the ids of all files before it, from the files' own heads."""

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = []
            for name in batch.column("file").to_pylist():
                system, path = shared.located(f"{folder}/{name}")
                with system.open_input_file(path) as source:
                    ids.append(unpack_head(source.read(HEAD_BYTES))[1])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("file", "part", "piece")), pa.array(ids, pa.int64())],
                                             names=["file", "part", "piece", "ids"])

    found = shared.stored(manifest.select("file", "part", "piece").mapInArrow(heads, "file string, part int, piece int, ids long"), "token-heads")
    of_part = found.groupBy("part").agg(F.sum("ids").alias("sum"))  # one row a task
    parts = of_part.select("part", F.coalesce(F.sum("sum").over(Window.orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("ids").over(Window.partitionBy("part").orderBy("piece").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    return found.select("file", "part", inside.alias("inside")).join(parts, "part").select(
        "file", (F.col("base") + F.col("inside")).alias("base"))


def read(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                doc_ids, counts, ids, nameless = unpack_file(content.as_buffer())
                ends = np.cumsum(counts)
                raw = ids.astype("<u4", copy=False)
                crcs = [zlib.crc32(raw[a:b]) for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
                name = path.as_py().rpartition("/")[2]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(ends)), pa.array(doc_ids, mask=np.arange(len(ends)) < nameless), pa.array(ends - counts),
                     pa.array(counts), pa.array(crcs, pa.int64())], names=["file", "doc_id", "before", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(folder)
    return (
        files.select("path", "content").mapInArrow(task, READ).join(starts(folder, manifest), "file")
        .select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
    )


def round_trip(docs: DataFrame, tokenizer: str, end: int) -> DataFrame:
    """Writes the files of all documents to the shared folder and reads them back."""
    spark = docs.sparkSession
    folder = shared.folder(spark, "tokens")
    manifest = write(docs, folder, tokenizer, end)
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read(spark, folder, manifest)
