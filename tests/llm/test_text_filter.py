import pytest
from pyspark.sql import functions as F

from muster.llm import suffix_dedup as dedup
from tests.llm.test_suffix_dedup import covered, frame, marked, planted


def test_texts_without_a_key_are_not_shuffled(spark):
    texts = spark.range(2000).select(F.when(F.col("id") < 1990, F.col("id")).alias("doc_id"), F.col("id").alias("tag"), F.lit("x").alias("text"))
    keys = spark.range(0, 2000, 100).select(F.col("id").alias("doc_id"), F.col("id").alias("tag"), F.lit("y").alias("more"))
    asked = dedup._possible(texts, keys, ["doc_id", "tag"], "possible")
    assert asked.columns == [*texts.columns, "possible"] and asked.count() == 2000
    found = {r.doc_id for r in asked.where("possible").collect()}
    assert {r.doc_id for r in keys.collect()} <= found and len(found) <= 25
    plan = dedup._matching_texts(texts, keys, ["doc_id", "tag"], 2 << 20)._jdf.queryExecution().optimizedPlan().toString()
    assert "getbit" in plan
    both = dedup._matching_texts(texts, keys, ["doc_id", "tag"], 2 << 20, "left")
    assert both.count() == 2000 and both.where("more IS NOT NULL").count() == 20


@pytest.mark.parametrize("bits", [1 << 24, 64])
def test_results_with_filtered_texts(spark, monkeypatch, bits):
    monkeypatch.setattr(dedup, "SMALL_BYTES", 0)
    monkeypatch.setattr(dedup, "FILTER_BITS", bits)
    texts, _ = planted(7, 90)
    docs = frame(spark, texts)
    docs = docs.unionByName(spark.createDataFrame([(None, "no id " * 60, "p"), (1000, None, "p")], docs.schema))
    assert marked(dedup.digest(dedup.repeated_spans(docs)).collect()) == {i: m for i, m in covered(texts).items() if m}
    marks = covered(texts)
    got = dedup.cut_repeats(docs)
    assert got.columns == docs.columns
    left = {r.doc_id: r.text for r in got.collect()}
    assert left[None] == "no id " * 60 and left[1000] is None and len(left) == 92
    assert {i: left[i].lower().split() for i in texts} == {i: [w for k, w in enumerate(words) if k not in marks[i]] for i, words in texts.items()}
