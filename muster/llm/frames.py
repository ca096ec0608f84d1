"""What the operators share: reading tables, text batches, names, row keys."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of fewer rows from now on, unless the session has set a size of its own.

    Spark's default of ten thousand long documents a batch takes memory several
    times over, in a task's JVM and in its Python worker.
    """
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, str(rows))


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, so that other columns cannot clash."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))


def utf8(column: pa.Array) -> Iterator[bytes]:
    """The values of a string column as bytes, null as empty."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
