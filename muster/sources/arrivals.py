"""Rows as they arrive, folded to the latest version of each key."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muster.sources.scratch import cut, delete, file_system, intermediate

_ORDER = T.StructType([T.StructField("_seq", T.LongType()), T.StructField("_batch", T.LongType())])


class Arrivals:
    """What a stream has to remember, as Parquet under one folder.

    New versions of rows are added to the current generation.  ``compact`` writes
    a next generation, which counts from the moment Spark has marked its folder as
    complete; so a run that dies while compacting changes nothing.  One stream
    writes at a time.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, keys: Sequence[str]):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.schema = schema
        self.stored = T.StructType([*schema.fields, *_ORDER.fields])
        self.keys = list(keys)

    def add(self, rows: DataFrame, seq: int, batch: int) -> None:
        """Versions that arrived in a batch, one for each key.  Adding them again changes nothing."""
        order = {"_seq": F.lit(seq).cast("long"), "_batch": F.lit(batch).cast("long")}
        self._write(rows.select(*self.schema.fieldNames()).withColumns(order), self._generation(), "append")

    def latest(self) -> DataFrame:
        """The last version of each key, by run and batch.

        An aggregate: its partial step keeps one version for each key and task.
        """
        rows = self._versions().where(F.col(self.keys[0]).isNotNull())
        others = [name for name in self.schema.fieldNames() if name not in self.keys]
        last = F.max(F.struct(*_ORDER.fieldNames(), *others)).alias("_last")
        return rows.groupBy(*self.keys).agg(last).select(*self.keys, "_last.*").select(*self.stored.fieldNames())

    def compact(self, keep) -> None:
        """Keep the last versions that ``keep``, a function of frames, lets stay."""
        generation = self._generation()
        if generation is None:
            return
        with intermediate(self.spark):
            kept = cut(keep(self.latest()).select(*self.stored.fieldNames()))
            self._write(kept, generation + 1, "overwrite")
        for old in self._generations():
            if old <= generation:
                delete(self.spark, self._path(old))

    def _versions(self) -> DataFrame:
        generation = self._generation()
        if generation is None:
            return self.spark.createDataFrame([], self.stored)
        return self.spark.read.schema(self.stored).parquet(self._path(generation))

    def _write(self, rows: DataFrame, generation: int | None, mode: str) -> None:
        rows.write.mode(mode).parquet(self._path(generation or 0))

    def _path(self, generation: int) -> str:
        return f"{self.folder}/generation-{generation}"

    def _generation(self) -> int | None:
        """The last complete generation."""
        for generation in sorted(self._generations(), reverse=True):
            marker, files = file_system(self.spark, f"{self._path(generation)}/_SUCCESS")
            if files.exists(marker):
                return generation
        return None

    def _generations(self) -> list[int]:
        path, files = file_system(self.spark, self.folder)
        if not files.exists(path):
            return []
        names = [status.getPath().getName() for status in files.listStatus(path)]
        return [int(found[1]) for found in map(re.compile(r"generation-(\d+)$").match, names) if found]
