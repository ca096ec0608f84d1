"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from muster.llm import (
    best_fit,
    byte_bpe,
    hard_negatives,
    importance,
    licenses,
    neardup_texts,
    neardup_vectors,
    oracle,
    packing,
    pii,
    suffix_dedup,
    topk,
    toxicity,
    warc,
)
from muster.llm.frames import bound_batches, read_table
from muster.sources.scratch import new_folder


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return suffix_dedup.digest(suffix_dedup.repeated_spans(docs))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup_vectors.near_duplicates(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(read_table(spark, sf_dir, "documents", "doc_id", "text")))


def op4_pack_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack(docs, with_ids=False)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return byte_bpe.round_trip(docs)


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return topk.exact_top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup_texts.near_duplicates(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity.toxicity(docs, read_table(spark, sf_dir, "labels", "doc_id", "toxic")).drop("evidence")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return licenses.digest(licenses.scan_licenses(docs))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    warc.write_archives(read_table(spark, sf_dir, "pages", "page_id", "url", "html"), folder)
    return warc.digest(warc.assemble(warc.read_records(spark, folder, with_payload=False)))


def op11_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return best_fit.pack(docs, with_ids=False)


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return importance.resample(docs, read_table(spark, sf_dir, "benchmark", "item_id", "text"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    noisy = vectors.withColumn("label", F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"))
    return hard_negatives.mine(noisy, F.col("vec_id") % 100 == 0).drop("positive_rank")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = (
        op1_suffix_dedup, op2_embedding_dedup, op3_pii, op4_pack_windows, op5_byte_bpe, op6_exact_top_k,
        op7_minhash_dedup, op8_toxicity, op9_license_scan, op10_warc, op11_best_fit, op12_importance,
        op13_hard_negatives, pipeline,
    )
    return {f.__name__: f for f in registered}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
