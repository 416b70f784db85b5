"""Files in the folder all executors share, through whatever file system its address names."""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow.fs as pafs
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession

from yearloom.session import scratch_path


def folder(spark: SparkSession, name: str) -> str:
    """A new folder's address in the shared folder, made by whoever writes first."""
    path = scratch_path(spark, name)
    return path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}"


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows written to a new shared table and read again: work done once, lineage cut."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def located(address: str) -> tuple[pafs.FileSystem, str]:
    if address.startswith("file:") and not address.startswith("file://"):
        address = "file://" + address.removeprefix("file:")
    return pafs.FileSystem.from_uri(address)


def write_file(address: str, parts: list) -> None:
    """Writes a file whole or not at all: tasks that run twice leave the same file."""
    system, path = located(address)
    system.create_dir(os.path.dirname(path), recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(draft) as out:
        for part in parts:
            out.write(part.tobytes() if isinstance(part, np.ndarray) else part)
    system.move(draft, path)


def write_array(address: str, values: np.ndarray) -> None:
    write_file(address, [values] if values.size else [])


def read_array(address: str, kind) -> np.ndarray:
    """The array in a file: memory-mapped where the file system is mounted, read elsewhere."""
    system, path = located(address)
    if isinstance(system, pafs.LocalFileSystem):
        return np.memmap(path, dtype=kind, mode="r") if os.path.getsize(path) else np.zeros(0, kind)
    with system.open_input_file(path) as source:
        return np.frombuffer(source.read_buffer(), dtype=kind)


def read_range(address: str, kind, start: int, n: int) -> np.ndarray:
    """``n`` values from byte ``start`` of a file on: memory-mapped where the file system is mounted, read elsewhere."""
    system, path = located(address)
    if isinstance(system, pafs.LocalFileSystem):
        return np.memmap(path, dtype=kind, mode="r", offset=start, shape=(n,)) if n else np.zeros(0, kind)
    with system.open_input_file(path) as source:
        return np.frombuffer(source.read_at(n * np.dtype(kind).itemsize, start), dtype=kind)


def sent(spark: SparkSession, value) -> Broadcast:
    """Broadcasts an object with its class, so workers need not import it; the caller bounds its size."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(value: Broadcast):
    return cloudpickle.loads(value.value)
