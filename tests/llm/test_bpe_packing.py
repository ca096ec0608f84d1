import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from muster.llm import byte_bpe, packing
from muster.llm.frames import bound_batches
from muster.llm.pretokens import Memory, spelt, stretch_of, stretches, words_of
from tests.llm.conftest import EDGE_TEXTS


@pytest.fixture(scope="module")
def reference():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


def test_memory_keeps_what_one_call_needs():
    asked = []
    memory = Memory(lambda keys: [asked.append(k) or k.upper() for k in keys], limit=2)
    for call in ("abca", "ad", "ae", "fgh", "a", "", "bb"):
        assert memory.values([list(call), [], ["a"]]) == [list(call.upper()), [], ["A"]]
    assert asked == list("abcdefghb")


@pytest.mark.parametrize("memory", [0, 400, 1 << 25])
def test_ids_do_not_depend_on_what_is_kept(monkeypatch, tokenizer, memory):
    monkeypatch.setattr(packing, "MEMORY_BYTES", memory)
    spaces = ["a  b", "a \n b", " \n", "a\n  b", "a\n b", "x \x1c y", "a\u3000 b", " ", " a ", "a  ", "\t \t x", "a ", "a\xa0 \x85b"]
    texts = [t or "" for t in EDGE_TEXTS] + spaces + ["it's 'll they'll, \"quoted\" <|endoftext|> x", "naïve Straße 日本 語"]
    encode = packing.Tokens(public_tokenizers.path(packing.TOKENIZER)).encode
    for _ in range(2):
        got = [np.frombuffer(ids, "<u4").tolist() for ids in encode(texts * 3)]
        assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts * 3]


@given(st.text(alphabet=" ab\n\t1,.'s\x1cé日", max_size=30))
def test_stretches_hold_the_words_of_their_text(text):
    parts = stretches(text)
    if parts is not None:
        assert [w for part in parts for w in words_of(spelt(part))] == words_of(text)
        assert all(spelt(stretch_of(w)) == w for w in words_of(text))


def test_batches_are_bounded_unless_the_session_has_its_own(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for given_size, kept in (("10000", "1000"), ("77", "77")):
            spark.conf.set(name, given_size)
            bound_batches(spark)
            assert spark.conf.get(name) == kept
    finally:
        spark.conf.set(name, before)


def test_codec_equals_tiktoken(reference):
    words = ["aaaaaaaaa", "aaaaaaaa", "abababab", " hello", "zzz" * 40, "é" * 9, "日本語", "!!!???", "x"]
    codec = byte_bpe.Codec(public_tokenizers.path(byte_bpe.RANKS))
    for word, (ids, spelt) in zip(words, codec._code_words(words), strict=True):
        assert spelt == word.encode()
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(word), word


def test_round_trip(spark, edge_docs, no_docs, small_docs, reference):
    for docs in (edge_docs, small_docs):
        texts = sorted((r.doc_id or -1, r.text or "") for r in docs.collect())
        got = sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in byte_bpe.round_trip(docs).collect())
        want = []
        for number, text in texts:
            ids = reference.encode_ordinary(text)
            want.append((
                number, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256(text.encode()).hexdigest(),
            ))
        assert got == sorted(want)
    assert byte_bpe.round_trip(no_docs).count() == 0


def test_encode_and_decode(edge_docs, reference):
    encoded = byte_bpe.encode(edge_docs)
    texts = {r.doc_id: r.text or "" for r in edge_docs.collect()}
    for row in encoded.collect():
        assert row.ids == reference.encode_ordinary(texts[row.doc_id])
    for row in byte_bpe.decode(encoded).collect():
        assert bytes(row.bytes).decode() == texts[row.doc_id]


def check_pieces(rows, ids_of):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
        ids = np.array(ids_of[r.doc_id][r.start : r.start + r.length], "<u4")
        assert r.doc_tokens == len(ids_of[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids.tobytes())
        assert r.ids is None or r.ids == ids.tolist()
    assert set(by_doc) == set(ids_of)
    for number, own in by_doc.items():
        place = 0
        for r in sorted(own, key=lambda r: r.start):
            assert (r.start, r.length > 0) == (place, True)
            place += r.length
        assert place == len(ids_of[number])
    padding = 0
    for own in by_sequence.values():
        place = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == place
            place += r.length
        assert place <= packing.WINDOW
        if place & (place - 1):
            padding += packing.WINDOW - place
    return padding


def test_pack(edge_docs, no_docs, small_docs, tokenizer):
    unique = edge_docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    for docs in (unique, small_docs):
        ids = {
            r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]
            for r in docs.collect()
        }
        assert check_pieces(packing.pack(docs).collect(), ids) == 0
    assert packing.pack(no_docs).count() == 0
    assert packing.pack(edge_docs).where("doc_id IS NULL").count() > 0


@given(st.lists(st.integers(1, 5000), max_size=60))
def test_plan_covers_everything_without_padding(sizes):
    held, filled = {}, {}
    for doc, start, length, sequence, offset in packing.plan(sizes):
        held.setdefault(doc, []).append((start, length))
        filled.setdefault(sequence, []).append((offset, length))
    assert [sum(n for _, n in held[d]) for d in range(len(sizes))] == sizes
    for own in filled.values():
        total = sum(n for _, n in own)
        assert total == 2048 or total & (total - 1) == 0
        place = 0
        for offset, length in sorted(own):
            assert offset == place
            place += length


def test_most_remainders_stay_whole():
    sizes = np.random.default_rng(3).integers(1, 2048, 4000).tolist()
    cuts = sum(1 for _ in packing.plan(sizes)) - len(sizes)
    line = int(np.sum(sizes)) // 2048
    assert cuts < 1.1 * line


def test_nnls_meets_the_optimality_conditions():
    rng = np.random.default_rng(1)
    for _ in range(20):
        matrix, target = rng.random((12, 30)), 10 * rng.random(12)
        x = packing.nnls(matrix, target)
        slope = matrix.T @ (target - matrix @ x)
        assert (x >= 0).all() and (slope <= 1e-6).all() and np.abs(slope[x > 1e-9]).max(initial=0) < 1e-6
