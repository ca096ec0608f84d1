import numpy as np
import public_tokenizers

from muster.llm import packing
from muster.llm.pretokens import words_of

TEXTS = [
    "word, another. third! fourth? fifth; sixth: seventh", "é, ß. 日本! ʰ, ª. x,, y.. it's, 'tis. z.'s a,s ,a .", ", . ! ? ; :",
    "word, , another. \n, a,\nb. c, d,", "1, 2. a1, b2. ́, é, ́. Ⅷ, ²,", "", ",", "a,", " a, ",
]


def test_ids_of_words_with_a_mark_are_those_of_the_pattern():
    from tokenizers import Tokenizer

    path = public_tokenizers.path(packing.TOKENIZER)
    whole = Tokenizer.from_file(path)
    for memory in (1, 1 << 20):
        for text, ids in zip(TEXTS, packing.Tokens(path, memory).encode(TEXTS), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_a_word_with_a_mark_needs_no_pattern(monkeypatch):
    asked = []
    monkeypatch.setattr(packing, "words_of", lambda text: asked.append(text) or words_of(text))
    list(packing.Tokens(public_tokenizers.path(packing.TOKENIZER)).encode([" " + TEXTS[0]]))
    assert len([a for a in asked if len(a) > 2]) == 0


def test_memory_of_stretches_is_a_parameter(spark, monkeypatch):
    """The pipeline's workers remember less than those that only pack."""
    import corpus_pipeline

    given = []
    pack = packing.pack
    monkeypatch.setattr(packing, "pack", lambda *a, **b: given.append(b) or pack(*a, **b))
    docs = spark.createDataFrame([(1, "a b, c")], "doc_id BIGINT, text STRING")
    assert corpus_pipeline.pack(spark, docs, "").count() == 2
    assert given[0]["memory"] < packing.MEMORY_BYTES
