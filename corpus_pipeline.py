"""A training corpus from raw documents, stage by stage.

Each stage gets what its predecessor kept, written as Parquet and read again;
all but the last return the columns of the documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.llm import neardup_texts, packing, pii, suffix_dedup, toxicity
from muster.llm.frames import bound_batches, free_name, read_table
from muster.sources.scratch import cut

PACKING_MEMORY = 32 << 20  # the stages before leave their executors little


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose nearest labelled examples aren't toxic."""
    bound_batches(spark)
    return toxicity.without_toxic(docs, read_table(spark, sf_dir, "labels", "doc_id", "toxic"))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; rows without id stay.

    Rows that repeat an id are documents of their own where their texts differ;
    of rows equal in id and text, one stays.
    """
    bound_batches(spark)
    number = free_name(docs, "row_number")
    repeated = cut(docs.groupBy("doc_id").count().where("doc_id IS NOT NULL AND count > 1").select("doc_id"))
    numbered = docs.withColumn(number, F.col("doc_id"))
    if not repeated.isEmpty():
        single = numbered.join(repeated, "doc_id", "left_anti").select(*numbered.columns)
        numbered = single.unionByName(_numbered_texts(docs, repeated, number))
    found = neardup_texts.near_duplicates(numbered.select(F.col(number).alias("doc_id"), "text"))
    dropped = cut(found.where(~F.col("kept")).select(F.col("doc_id").alias(number)))
    return numbered.join(dropped, number, "left_anti").select(*docs.columns)


def _numbered_texts(docs: DataFrame, repeated: DataFrame, number: str) -> DataFrame:
    """One row for each text of the ids, under numbers that no document has."""
    rows = docs.join(repeated, "doc_id", "left_semi")
    row = F.min(F.struct(*docs.columns)).alias("row")
    texts = rows.groupBy(F.col("doc_id"), F.col("text")).agg(row).select("row.*").select(*docs.columns)
    last = docs.agg(F.max("doc_id").alias("last")).first().last
    return cut(texts.withColumn(number, F.lit(last + 1) + F.monotonically_increasing_id()))


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of fifty words or more that an earlier document has."""
    bound_batches(spark)
    return suffix_dedup.cut_repeats(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    bound_batches(spark)
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenised documents in windows of 2048."""
    bound_batches(spark)
    return packing.pack(docs, with_ids=False, memory=PACKING_MEMORY)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", remove_toxic),
    ("near_dedup", remove_near_duplicates),
    ("suffix_dedup", remove_repeats),
    ("pii", mask_personal_data),
    ("packing", pack),
]

# Scores of a fitted model and a tokenizer's ids cannot be said in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = cut(docs)
    return docs
