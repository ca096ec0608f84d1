import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from muster.llm import importance
from tests.llm.conftest import EDGE_TEXTS

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SMALL = {chr(i): chr(i + 32) for i in range(65, 91)}


def brute_buckets(text):
    words = WORDS.findall("".join(SMALL.get(c, c) for c in text or ""))
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return [zlib.crc32(run.encode()) % 10000 for run in runs], len(words)


def buckets_of(texts):
    found = [[] for _ in texts]
    for text, buckets in importance.features(pa.array([t.encode() for t in texts], pa.large_binary())):
        assert (np.diff(text) >= 0).all()
        for i, bucket in zip(text.tolist(), buckets.tolist()):
            found[i].append(bucket)
    return [sorted(f) for f in found]


LONG = ["x" * n for n in (1, 4, 255, 256, 257, 511, 512, 513, 3000)] + ["a " * 500 + "é" * 700 + " b" * 40]


@pytest.mark.parametrize("slice_, stretch", [(1 << 22, 1 << 18), (64, 20), (7, 3), (1, 1)])
def test_features_equal_zlib(monkeypatch, slice_, stretch):
    monkeypatch.setattr(importance, "SLICE", slice_)
    monkeypatch.setattr(importance, "STRETCH", stretch)
    texts = [t or "" for t in EDGE_TEXTS] + LONG + ["Ab-C  d'E\x7f9", "", "日本 Ñ語"]
    assert buckets_of(texts) == [sorted(brute_buckets(t)[0]) for t in texts]
    assert buckets_of([]) == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=1400), min_size=1, max_size=8))
def test_checksums_of_any_bytes(spans):
    ends = np.cumsum([len(s) for s in spans])
    letters = np.frombuffer(b"".join(spans), dtype=np.uint8)
    found = importance.checksums(letters, ends - [len(s) for s in spans], ends)
    assert found.tolist() == [zlib.crc32(s) for s in spans]


def brute(docs, target):
    own = [(number, *brute_buckets(text)) for number, text in docs]
    s, t = np.zeros(10000, int), np.zeros(10000, int)
    for _, buckets, _ in own:
        np.add.at(s, buckets, 1)
    for text in target:
        np.add.at(t, brute_buckets(text)[0], 1)
    total_s, total_t = int(s.sum()), int(t.sum())
    gain = [
        math.floor(1000 * math.log((int(t[b]) + 1) * (total_s + 10000) / ((int(s[b]) + 1) * (total_t + 10000))))
        for b in range(10000)
    ]
    rows = []
    for number, buckets, n_words in own:
        weight = sum(gain[b] for b in buckets)
        score = None
        if number is not None:
            h = int(hashlib.sha256(f"42:{number}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([number, len(buckets), weight, score, n_words])
    drawn = sorted(
        (r for r in rows if r[0] is not None and r[4] >= 20), key=lambda r: (-r[3], r[0], -r[2], -r[1])
    )
    ranks = {id(r): place + 1 for place, r in enumerate(drawn[: 5 * len(drawn) // 100])}
    return sorted(((*r[:4], ranks.get(id(r))) for r in rows), key=repr)


def got(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def test_equals_brute_force(spark, small_docs):
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    texts = [(r.doc_id, r.text) for r in small_docs.collect()]
    want = brute(texts, [r.text for r in target.collect()])
    assert sum(r[4] is not None for r in want) >= 5
    for parts in (1, 7):
        assert got(importance.resample(small_docs.repartition(parts), target)) == want


def test_odd_rows(spark, edge_docs, no_docs):
    target = edge_docs.select("doc_id", "text", "labels")
    texts = [(r.doc_id, r.text) for r in edge_docs.collect()]
    found = importance.resample(edge_docs, target, target_id_col="doc_id")
    assert got(found) == brute(texts, [t for _, t in texts])
    nothing = importance.resample(no_docs, target, target_id_col="doc_id")
    assert nothing.count() == 0
    found = importance.resample(edge_docs, no_docs, target_id_col="doc_id")
    assert got(found) == brute(texts, [])


def test_ties_and_repeated_rows(spark):
    rows = [(5, "w " * 30)] * 40 + [(7, "w " * 30)] * 20 + [(None, "v " * 30), (9, None), (9, "w " * 19)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(5)
    target = spark.createDataFrame([(1, "w w w")], "item_id BIGINT, text STRING")
    found = importance.resample(docs, target)
    assert got(found) == brute(rows, ["w w w"])
    assert sorted(r.rank for r in found.collect() if r.rank) == [1, 2, 3]
