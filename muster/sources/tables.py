"""Reading and querying tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from muster.sources import schemas


def load_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(schemas.INPUTS[name]).parquet(f"{root}/{name}")


def load_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: load_table(spark, root, name) for name in schemas.INPUTS}


def run_sql(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Ad-hoc query; ``{name}`` in the text stands for a table of that name."""
    return spark.sql(sql, **tables)


class LazyTables(Mapping):
    """Tables that are looked up by name and built on first use."""

    def __init__(self, builders):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name](self)
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self):
        return len(self._builders)
