import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from muster.llm import best_fit


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


def check_plan(histogram, runs, sequences, window):
    """Every piece has one place, and sequences are gapless and short enough."""
    numbers, held = {}, {}
    for length, first, n, sequence, offset in runs:
        numbers.setdefault(length, []).append((first, n))
        for k in range(n):
            held.setdefault(sequence + k, []).append((offset, length))
    assert set(numbers) == {n for n, k in histogram.items() if k}
    for length, own in numbers.items():
        at = 0
        for first, n in sorted(own):
            assert first == at and n > 0
            at += n
        assert at == histogram[length]
    assert sorted(held) == list(range(sequences))
    for own in held.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= window


def by_item(histogram, window):
    """Best-fit decreasing, one piece at a time."""
    rooms: list[int] = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fitting = [(room, i) for i, room in enumerate(rooms) if room >= length]
            if fitting:
                rooms[min(fitting)[1]] -= length
            else:
                rooms.append(window - length)
    return len(rooms)


@settings(max_examples=150, deadline=None)
@given(
    st.dictionaries(st.integers(1, 64), st.integers(0, 300), max_size=40),
    st.integers(1, 12),
)
def test_plan_holds_every_piece_once(histogram, groups):
    runs, sequences = best_fit.plan(histogram, window=64, groups=groups)
    check_plan(histogram, runs, sequences, 64)
    runs, alone = best_fit._plan(histogram, 64, groups)
    check_plan(histogram, runs, alone, 64)
    assert sequences >= -(-sum(n * k for n, k in histogram.items()) // 64)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 5), max_size=20))
def test_runs_equal_best_fit_by_item(histogram):
    assert best_fit._plan(histogram, 64, 0)[1] == by_item(histogram, 64)
    assert best_fit.plan(histogram, 64)[1] <= by_item(histogram, 64)


def test_configurations_beat_best_fit():
    lengths = np.random.default_rng(1).integers(500, 900, 20_000)
    histogram = dict(Counter(lengths.tolist()))
    runs, sequences = best_fit.plan(histogram)
    check_plan(histogram, runs, sequences, 2048)
    assert sequences < 0.93 * best_fit._plan(histogram, 2048, 0)[1]


def test_configurations_solve_the_linear_programme():
    # Optimum by hand: every 1025 with a 1023, every 512 with three others.
    found = best_fit.configurations([1025, 1023, 512], [400, 400, 800], 2048)
    assert sum(repeats for _, repeats in found) == 600
    # The only way to fill is 683 + 683 + 682.
    found = best_fit.configurations([683, 682], [2000, 1000], 2048)
    assert [(counts.tolist(), repeats) for counts, repeats in found] == [([2, 1], 1000)]


def test_plan_grows_with_lengths_not_with_pieces():
    histogram = {n: 10**9 + n for n in range(1, 2049, 7)}
    runs, sequences = best_fit.plan(histogram)
    total = sum(n * k for n, k in histogram.items())
    assert len(runs) < 20_000
    assert sequences * 2048 < 1.02 * total
    covered = Counter()
    for length, _, n, _, _ in runs:
        covered[length] += n
    assert covered == histogram


def check_rows(rows, ids_of, window):
    documents, sequences = {}, {}
    for r in rows:
        documents.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
        own = np.array(ids_of[r.doc_id][r.start : r.start + r.length], "<u4")
        assert zlib.crc32(own.tobytes()) == r.ids_crc32 and r.ids == own.tolist()
    assert set(documents) == set(ids_of)
    for number, own in documents.items():
        size, at = len(ids_of[number]), 0
        for k, r in enumerate(sorted(own, key=lambda r: r.start)):
            assert (r.piece, r.start) == (k, at)
            assert r.length == window or (k == 0 and r.length == size % window)
            at += r.length
        assert at == size
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return len(sequences)


def test_pack(edge_docs, no_docs, small_docs, tokenizer):
    unique = edge_docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    for docs, window in ((unique, 2048), (small_docs.repartition(7), 2048), (small_docs, 100)):
        ids = {
            r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
            for r in docs.collect()
        }
        used = check_rows(best_fit.pack(docs, window=window).collect(), ids, window)
        assert used <= 1.02 * sum(map(len, ids.values())) / window + 1
    assert best_fit.pack(no_docs).count() == 0


def test_odd_rows(edge_docs):
    rows = best_fit.pack(edge_docs, with_ids=False).collect()
    assert sum(r.doc_id is None for r in rows) == 1
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    empty = [r for r in rows if r.doc_id in (0, 1)]
    assert [(r.piece, r.start, r.length, r.ids_crc32) for r in empty] == [(0, 0, 1, zlib.crc32(bytes(4)))] * 2
    assert sum(r.doc_id == 3 for r in rows) == 2


def test_packing_does_not_depend_on_tasks(small_docs):
    counts = {
        best_fit.pack(small_docs.repartition(n), with_ids=False).select("sequence_id").distinct().count()
        for n in (1, 9)
    }
    assert len(counts) == 1


def test_memory_of_stretches_is_the_operators_own():
    from muster.llm.packing import TOKENIZER, Tokens

    held = [Tokens(best_fit.public_tokenizers.path(TOKENIZER), n) for n in (1, best_fit.MEMORY_BYTES)]
    for known in held:
        list(known.encode(["some words", "others", "more of them"]))
    assert [bool(known.old) for known in held] == [True, False]


def test_the_query_bounds_its_batches(spark, tmp_path):
    from muster.llm.queries import op11_best_fit

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs = spark.createDataFrame([(1, "a b, c"), (2, None)], "doc_id BIGINT, text STRING")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "10000")
        assert op11_best_fit(spark, str(tmp_path)).count() == 2
        assert spark.conf.get(name) == "1000"
    finally:
        spark.conf.set(name, before)
