"""Session set-up and the shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
RUN_CONF = "spark.yearloom.run"


def local_session(cores: str = "8", app: str = "yearloom", **conf: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        "spark.sql.adaptive.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; a local one only if unset.

    A local folder is accepted for a local master alone: on a cluster executors
    could not see it, so a missing setting is an error there.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="yearloom-")
    spark.conf.set(CHECKPOINT_CONF, folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder, inside the folder of the run if there is one."""
    return os.path.join(spark.conf.get(RUN_CONF, None) or shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for the scratch tables of a run, removed at its end; nothing lazy may outlive it."""
    before = spark.conf.get(RUN_CONF, None)
    folder = os.path.join(shared_folder(spark), f"run-{uuid.uuid4().hex}")
    spark.conf.set(RUN_CONF, folder)
    try:
        yield folder
    finally:
        if before is None:
            spark.conf.unset(RUN_CONF)
        else:
            spark.conf.set(RUN_CONF, before)
        discard(spark, folder)


def discard(spark: SparkSession, path: str) -> None:
    """Removes a table this run has written and no longer reads."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss, unlike a local one."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint()
