"""Intermediate tables in the folder that driver and executors share.

The cluster names that folder in ``spark.checkpoint.dir``; a session without it
(tests on one machine) gets a temporary folder, set as its checkpoint folder.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


#: Bytes of a batch that is sent to Python, where the session has Spark's own bound (64 MB).
BATCH_BYTES, DEFAULT = 8 << 20, "67108864b"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path for a table or for mapped files in the shared folder.

    Operators that use it read whole texts in Python, so it also bounds batches by bytes.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == DEFAULT:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='tessera-')}"
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: its lineage ends there."""
    return _written(df, shared_path(df.sparkSession, name))


def _written(df: DataFrame, path: str) -> DataFrame:
    spark = df.sparkSession
    with short_plans(spark):
        df.write.parquet(path)
    give_back()
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing(df: DataFrame, name: str):
    """``written`` for a table that is needed within the block only: its files are deleted after it."""
    path = shared_path(df.sparkSession, name)
    yield _written(df, path)
    store, base = fs.FileSystem.from_uri(path)
    store.delete_dir(base)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores after it as it takes to be no column of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Shuffle files go as soon as the query that made them ends, not when the driver's collector finds them unused."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, True)
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def short_plans(spark: SparkSession, length: int = 1 << 14):
    """Descriptions of plans are cut off at ``length`` characters: the driver keeps those of a thousand jobs, and every version of each."""
    name = "spark.sql.maxPlanStringLength"
    before = spark.conf.get(name)
    spark.conf.set(name, length)
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def planned_once(spark: SparkSession):
    """Plans aren't changed while they run: one with a large literal is described, with all of it, for every version."""
    name = "spark.sql.adaptive.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, False)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def give_back() -> None:
    """Hand the process's freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def lean(work):
    """``work`` over a task's batches, and then ``give_back``: workers are kept for later tasks."""

    def run(batches):
        yield from work(batches)
        give_back()

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
