"""The shared folder for intermediate results."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """Folder the cluster names for checkpoints.

    A temporary folder stands in only where all tasks run in this process.
    """
    context = spark.sparkContext
    named = spark.conf.get(SETTING, None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {SETTING} to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="muster-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named


def new_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def intermediate(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what was cut inside.

    For jobs that end with a write: frames that outlive the block must not
    rest on anything cut in it.  A block holds what its own thread cuts; work
    on other threads, as the callback of a stream, opens its own.
    """
    folders: list[str] = []
    token = _open.set(folders)
    try:
        yield
    finally:
        _open.reset(token)
        for folder in folders:
            delete(spark, folder)


def delete(spark: SparkSession, folder: str) -> None:
    path, files = file_system(spark, folder)
    files.delete(path, True)


def file_system(spark: SparkSession, folder: str):
    """The folder as Hadoop names it, and the file system that has it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


# Folders cut in the innermost open ``intermediate`` block of this thread.
_open: ContextVar[list[str] | None] = ContextVar("open_block", default=None)


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back.

    For frames that are read several times or must not change when a lost
    executor makes Spark compute them again.  A written table also tells Spark
    its size, by which it chooses between broadcast and shuffle.
    """
    return measured_cut(df)[0]


def measured_cut(df: DataFrame) -> tuple[DataFrame, int]:
    """``cut``, and the bytes of the written table."""
    spark = df.sparkSession
    folder = new_folder(spark, "cut")
    block = _open.get()
    if block is not None:
        block.append(folder)
    df.write.parquet(folder)
    path, files = file_system(spark, folder)
    size = files.getContentSummary(path).getLength()
    return spark.read.schema(df.schema).parquet(folder), size
