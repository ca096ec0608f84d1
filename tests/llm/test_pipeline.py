
from tokenizers import Tokenizer
import public_tokenizers

import corpus_pipeline
from muster.llm import neardup_texts, pii, suffix_dedup, toxicity
from muster.sources.scratch import cut
from tests.llm.test_bpe_packing import check_pieces

SMALL = "/root/testdata/sf0.001"


def stages_of(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    results = [docs]
    for _, stage in corpus_pipeline.STAGES:
        results.append(cut(stage(spark, results[-1], folder)))
    return results


def test_stages(spark):
    docs, clean, single, unrepeated, masked, packed = stages_of(spark, SMALL)
    for frame in (clean, single, unrepeated, masked):
        assert frame.columns == docs.columns and frame.dtypes == docs.dtypes
    ids = [{r.doc_id for r in f.select("doc_id").collect()} for f in (docs, clean, single, unrepeated, masked, packed)]
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    rejected = {r.doc_id for r in toxicity.toxicity(docs, labels).where("predicted = 1").collect()}
    assert ids[1] == ids[0] - rejected
    kept = {r.doc_id for r in neardup_texts.near_duplicates(clean).where("kept").collect()}
    assert ids[2] == kept == ids[3] == ids[4] == ids[5]
    assert suffix_dedup.repeated_spans(unrepeated).count() == 0
    assert pii.find_pii(masked).where("size(spans) > 0").count() == 0

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    found = {r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1] for r in masked.collect()}
    assert check_pieces(packed.selectExpr("*", "CAST(NULL AS ARRAY<INT>) AS ids").collect(), found) == 0
    assert sorted(map(tuple, packed.drop("sequence_id", "offset", "start", "length", "ids_crc32").distinct().collect())) == sorted(
        map(tuple, corpus_pipeline.run(spark, SMALL).drop("sequence_id", "offset", "start", "length", "ids_crc32").distinct().collect())
    )


def test_odd_rows_stay(spark, tmp_path):
    rows = [(None, "no id", "a"), (None, None, "b"), (1, None, "c"), (2, "", "d"), (2, "", "d"), (3, "one two", "e"),
            (3, "three four", "f"), (4, "one two", "g")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, kept STRING")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id BIGINT, toxic INT").write.parquet(f"{tmp_path}/labels.parquet")
    frames = stages_of(spark, str(tmp_path))
    assert sorted(map(tuple, frames[4].collect()), key=repr) == sorted(
        [(None, "no id", "a"), (None, None, "b"), (1, None, "c"), (2, "", "d"), (3, "three four", "f"),
         (4, "one two", "g")], key=repr
    )
    assert frames[5].select("doc_id").distinct().count() == 5


def test_texts_of_one_id_are_documents_of_their_own(spark, tmp_path):
    """An id that holds a third of all rows loses its copies and nothing else."""
    texts = [" ".join(f"w{i}x{k}" for k in range(12)) for i in range(20)]
    rows = [(7, t, "hot") for t in texts] + [(7, texts[0], "hot")] * 5 + [(100 + i, t, "x") for i, t in enumerate(texts[:4])]
    rows += [(200 + i, f"clean {i} " + "y z " * i, "x") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, kept STRING")
    left = corpus_pipeline.remove_near_duplicates(spark, docs, str(tmp_path))
    assert left.columns == docs.columns
    got = sorted((r.doc_id, r.text) for r in left.collect() if r.doc_id < 200)
    assert got == sorted([(100 + i, t) for i, t in enumerate(texts[:4])] + [(7, t) for t in texts[4:]])


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id BIGINT, text STRING, lang STRING").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id BIGINT, toxic INT").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
