"""Files handed to others, and read back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.operators.personalization import slugs


def write_report(df: DataFrame, path: str, tab: str) -> bool:
    """CSV report under the name of its tab; an empty one is not written."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").option("header", True).csv(f"{path}/{tab}")
    return True


def read_report(spark: SparkSession, path: str, tab: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(f"{path}/{tab}")


def write_personalization(
    dataset: DataFrame, columns: Sequence[str], prefix: str, path: str
) -> None:
    """One compressed dataset per payload column, a folder for each: the
    identity and the column, under their own names."""
    named = slugs(columns, prefix)
    identity = next(name for name in dataset.columns if name not in columns)
    for column, slug in named.items():
        writer = dataset.select(identity, column).write.mode("overwrite")
        writer.option("header", True).option("compression", "gzip").csv(f"{path}/{slug}")


def read_personalization(spark: SparkSession, path: str, slug: str, schema: str) -> DataFrame:
    """One of the datasets; its header must name the schema's columns."""
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    return reader.csv(f"{path}/{slug}")


def write_recipient_group(df: DataFrame, path: str) -> None:
    """Set a group's members to exactly these: one id per line."""
    df.select(F.col("cons_id").cast("string")).write.mode("overwrite").text(path)


def read_group(spark: SparkSession, path: str) -> DataFrame:
    """Members of a group; blank lines, and so a blank file, hold none."""
    lines = spark.read.text(path).select(F.trim("value").alias("cons_id"))
    return lines.where(F.length("cons_id") > 0)


def write_identity_map(df: DataFrame, path: str) -> None:
    """Pairs of ids, for the service to know people by the mailing's own id."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_identity_map(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return read_report(spark, path, "", schema)
