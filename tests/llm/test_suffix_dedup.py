import random

import numpy as np
import pytest

from muster.llm import suffix_dedup as dedup


def spell(rng, n):
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def planted(seed=1, docs=60):
    rng = random.Random(seed)
    passages = [spell(rng, n) for n in (50, 51, 64, 90, 200)]
    texts = {}
    for i in range(docs):
        words = spell(rng, rng.randrange(0, 200))
        for p in rng.sample(range(5), rng.randrange(3)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = passages[p]
        texts[i] = words
    return texts, passages


def covered(texts):
    """Words in a run of 50 that a document of smaller id holds, by brute force."""
    seen, marks = set(), {}
    for i in sorted(texts):
        words = texts[i]
        windows = [tuple(words[a : a + 50]) for a in range(len(words) - 49)]
        marks[i] = {a + k for a, w in enumerate(windows) if w in seen for k in range(50)}
        seen.update(windows)
    return marks


def marked(spans):
    out = {}
    for r in spans:
        out.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
    return out


def frame(spark, texts, partitions=4):
    rng = random.Random(9)
    rows = [(i, "".join(w.upper() + rng.choice([" ", "\n", "  "]) for w in words), "s") for i, words in texts.items()]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, print STRING").repartition(partitions)


@pytest.mark.parametrize("task_rows", [100_000, 7])
def test_marks_equal_brute_force(spark, monkeypatch, task_rows):
    monkeypatch.setattr(dedup, "_TASK_ROWS", task_rows)
    texts, _ = planted()
    spans = dedup.digest(dedup.repeated_spans(frame(spark, texts))).collect()
    want = {i: m for i, m in covered(texts).items() if m}
    assert marked(spans) == want
    assert all(r.source_doc_id < r.doc_id and r.n_words >= 50 for r in spans)


def test_hot_passage_and_copies(spark):
    rng = random.Random(3)
    passage, copy = spell(rng, 70), spell(rng, 120)
    texts = {i: [*spell(rng, 30), *passage, *spell(rng, 30)] for i in range(200)}
    texts |= {i: copy for i in range(300, 360)}
    got = marked(dedup.digest(dedup.repeated_spans(frame(spark, texts))).collect())
    assert got == {i: m for i, m in covered(texts).items() if m}


def test_cutting_loses_no_content_and_keeps_the_rest(spark):
    texts, passages = planted(2)
    docs = frame(spark, texts)
    left = {r.doc_id: r.text.lower().split() for r in dedup.cut_repeats(docs).collect()}
    marks = covered(texts)
    assert left == {i: [w for k, w in enumerate(words) if k not in marks[i]] for i, words in texts.items()}


def test_odd_rows(spark, edge_docs, no_docs):
    long_ = " ".join(f"x{i}" for i in range(80))
    rows = [(1, long_, "a"), (1, long_, "b"), (2, long_, "c"), (None, long_, "d"), (3, None, "e"), (4, "", "f"), (5, "w " * 40_000, "g"), (6, "w " * 39_000, "h")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, spans STRING")
    spans = dedup.digest(dedup.repeated_spans(docs)).collect()
    assert [(r.doc_id, r.source_doc_id, r.start_word, r.end_word) for r in spans if r.doc_id < 5] == [(2, 1, 0, 80)]
    got = dedup.cut_repeats(docs)
    assert got.columns == docs.columns
    texts = {(r.doc_id, r.spans): r.text for r in got.collect()}
    assert len(texts) == 8 and texts[2, "c"] == "" and texts[None, "d"] == long_ and texts[1, "b"] == long_
    assert texts[3, "e"] is None and texts[4, "f"] == ""
    assert dedup.cut_repeats(edge_docs).count() == edge_docs.count()
    assert dedup.cut_repeats(no_docs).count() == 0


def test_minimisers_are_chosen_by_content():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 9, 500).astype(np.uint64)
    places = dedup.minimisers(values, 7)
    for a in range(500 - 6):
        assert a + int(np.argmin(values[a : a + 7])) in places
    assert len(dedup.minimisers(values[:5], 7)) == 0


def test_frequent_line_with_differing_context(spark):
    """Two documents share 25 words before a line that 300 others hold as well."""
    rng = random.Random(4)
    anchors = [0]
    while min(anchors) < 25:  # all of them in the line
        line, lead = spell(rng, 30), spell(rng, 25)
        words = dedup.word_hashes(" ".join([*lead, *line]).encode())
        anchors = dedup.minimisers(dedup.sequence_hashes(words, dedup.GRAM))
    texts = {i: [*spell(rng, 25), *line, *spell(rng, 30)] for i in range(300)}
    for i in rng.sample(range(300), 2):
        texts[i][:25] = lead
    got = marked(dedup.digest(dedup.repeated_spans(frame(spark, texts))).collect())
    want = {i: m for i, m in covered(texts).items() if m}
    assert [len(m) for m in want.values()] == [55] and got == want


def test_passage_repeated_in_one_document(spark):
    rng = random.Random(5)
    varied, same = spell(rng, 55), spell(rng, 55)
    texts = {1: [*spell(rng, 20), *varied, *spell(rng, 20), *same, *spell(rng, 20)]}
    texts[2] = [w for _ in range(20) for w in [*varied, *spell(rng, 45)]]
    filler = spell(rng, 45)
    texts[3] = [w for _ in range(20) for w in [*same, *filler]]
    got = marked(dedup.digest(dedup.repeated_spans(frame(spark, texts))).collect())
    want = {i: m for i, m in covered(texts).items() if m}
    assert [len(m) for m in want.values()] == [20 * 55, 20 * 55] and got == want


def test_passage_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(dedup, "_TASK_ROWS", 20)
    monkeypatch.setattr(dedup, "SMALL_BYTES", 0)
    rng = random.Random(6)
    passage = spell(rng, 60)
    texts = {i: [*spell(rng, 40), *passage, *spell(rng, 40)] for i in range(300)}
    spans = dedup.digest(dedup.repeated_spans(frame(spark, texts))).collect()
    assert marked(spans) == {i: m for i, m in covered(texts).items() if m}
    assert len(spans) == 299 and {r.source_doc_id for r in spans} == {0}


def test_tables_that_grow_with_the_input_are_not_broadcast(spark):
    keys = spark.range(3)
    plans = [dedup._matching(spark.range(9), keys, "id", n)._jdf.queryExecution().logical().toString() for n in (1000, 2 << 20)]
    assert ["ResolvedHint" in plan or "UnresolvedHint" in plan for plan in plans] == [True, False]
