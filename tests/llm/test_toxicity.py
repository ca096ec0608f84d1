import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from muster.llm import toxicity as tox

BAD = ["slurry", "vilest", "grotty"]


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    plain = [f"{a}{b}" for a in ("ban", "lor", "tem", "vis") for b in ("an", "ero", "ilium", "ota", "unda")]
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(plain, k=rng.randrange(20, 60))
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                words[rng.randrange(len(words))] = rng.choice(BAD) + rng.choice(["", "s", "ing"])
        rows.append((i, " ".join(words), i % 3))
        labels.append((i, int(toxic)))
    return rows, labels


def frames(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, score INT").repartition(3)
    return docs, spark.createDataFrame(labels, "doc_id BIGINT, toxic INT")


def test_held_out_rows_are_recognised(spark):
    rows, labels = corpus()
    docs, known = frames(spark, rows, labels)
    got = tox.toxicity(docs, known).join(known, "doc_id").collect()
    assert len(got) == 600
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    apart = [r for r in got if r.held_out]
    assert sum(r.predicted == r.toxic for r in apart) >= 0.98 * len(apart)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    learnt = {i for i, _ in labels if zlib.crc32(str(i).encode()) % 3 != 1}
    assert all(set(r.evidence) <= learnt for r in got)


def test_labels_of_held_out_rows_change_nothing(spark):
    rows, labels = corpus(300)
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in labels]
    one, other = (
        {r.doc_id: r.score for r in tox.toxicity(*frames(spark, rows, known)).collect()} for known in (labels, turned)
    )
    assert one == other


def test_nearest_equals_brute_force():
    rng = np.random.default_rng(5)

    def vector():
        v = {int(t): float(rng.random()) for t in rng.choice(30, rng.integers(1, 6), replace=False)}
        size = sum(w * w for w in v.values()) ** 0.5
        return {t: w / size for t, w in v.items()}

    def arrays(v):
        return np.array(sorted(v)), np.array([v[t] for t in sorted(v)])

    examples = [vector() for _ in range(300)] + [{0: 1.0}] * 50
    index = tox.BlockMaxIndex([arrays(e) for e in examples], 30, block=8)
    for n in range(60):
        query = vector() if n else {0: 1.0}
        scores = sorted(
            (-sum(w * e.get(t, 0.0) for t, w in query.items()), i) for i, e in enumerate(examples) if i != 3
        )
        places, cosines = index.nearest(*arrays(query), 12, without=3)
        want = [(i, -s) for s, i in scores[:12] if s < 0]
        assert [round(float(s), 9) for s in cosines] == [round(s, 9) for _, s in want]
        if n == 0:
            assert list(places) == [i for i, _ in want]


def spelt_out(rows, labels):
    """Scores by id: idf over all rows, all words of all examples, every cosine."""
    texts, known = {i: t or "" for i, t, _ in rows}, dict(labels)
    learnt = [i for i in sorted(known) if i in texts and zlib.crc32(str(i).encode()) % 3 != 1]
    words = {i: Counter(re.findall(r"[^\W\d_]+", t.lower())) for i, t in texts.items()}
    with_label = [words[i] for i in learnt if known[i]]
    without = [words[i] for i in learnt if not known[i]]

    def weight(term):
        cells = []
        for side, other in ((with_label, without), (without, with_label)):
            seen = sum(term in c for c in side)
            both = (seen + sum(term in c for c in other)) / len(learnt)
            cells += [(seen, len(side), both), (len(side) - seen, len(side), 1 - both)]
        ratio = sum(n * math.log(n / size / share) for n, size, share in cells if n)
        speaks = cells[0][0] / cells[0][1] > cells[2][0] / cells[2][1]
        idf = math.log((1 + len(rows)) / (1 + sum(term in c for c in words.values()))) + 1
        return idf * (tox.FLOOR + (math.sqrt(max(ratio, 0)) if speaks else 0))

    weights = {t: weight(t) for t in set().union(*(words[i] for i in learnt))}

    def vector(i):
        v = {t: (1 + math.log(n)) * weights[t] for t, n in words[i].items() if t in weights}
        size = math.sqrt(sum(w * w for w in v.values()))
        return {t: w / size for t, w in v.items()}

    vectors = {i: vector(i) for i in texts}
    base = len(with_label) / len(learnt)

    def vote(i):
        cosines = [(sum(w * vectors[j].get(t, 0) for t, w in vectors[i].items()), j) for j in learnt if j != i]
        near = sorted(((s, j) for s, j in cosines if s > 0), reverse=True)[: tox.NEIGHBOURS]
        return (sum(s * known[j] for s, j in near) + base) / (sum(s for s, _ in near) + 1)

    votes, y = np.array([vote(i) for i in learnt]), np.array([float(known[i]) for i in learnt])
    slope, offset = tox._logistic(votes, y, np.ones(len(y)))
    return {
        i: 1 / (1 + math.exp(-slope * vote(i) - offset)) for i in texts if i not in learnt and vectors[i]
    }


def test_scores_equal_all_cosines_spelt_out(spark):
    rows, labels = corpus(240, seed=3)
    rows = [(i, t + (f" einzig{'abcdefghij'[i % 10]}{'xyz'[i % 3]}ö" if i % 2 else ""), s) for i, t, s in rows]
    want = spelt_out(rows, labels)
    got = {r.doc_id: r for r in tox.toxicity(*frames(spark, rows, labels)).collect()}
    assert len(want) > 50
    assert all(abs(got[i].score - score) < 1e-9 for i, score in want.items())
    assert all(got[i].evidence for i in want)


def test_words_are_runs_of_letters():
    for text in ("One2two_three\x85four\x1cfive It's", "ÀB straße–İx\u00a0² a1b", "", "\x00a\x7fb"):
        assert tox.words_of(text) == re.findall(r"[^\W\d_]+", text.lower())


def test_bounded_sample_keeps_both_labels(spark):
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(400)], "doc_id BIGINT, label INT")
    for sample, sizes in ((40, (20, 20)), (200, (160, 40)), (1000, (360, 40))):
        chosen, share = tox._chosen(labels, sample)
        assert tuple(chosen.where(f"label = {y}").count() for y in (0, 1)) == sizes
        assert share == (360 / sizes[0], 40 / sizes[1])
    rows, known = corpus(600)
    docs, known = frames(spark, rows, known)
    model = tox.fit(docs, known, sample=60)
    assert len(model.ids) == 60 and model.labels.sum() == 30
    assert 0.1 < model.base < 0.3


def test_repeated_ids_are_one_example(spark):
    rows, labels = corpus(120)
    docs, known = frames(spark, [*rows, *[(0, f"other words {n}", 0) for n in range(300)]], labels)
    model = tox.fit(docs, known, sample=100)
    assert len(model.ids) == len(set(model.ids)) <= 100


def test_odd_rows(spark, edge_docs, no_docs):
    rows, labels = corpus(200)
    docs, known = frames(spark, [*rows, (None, "slurry", 1), (0, rows[0][1], 9), (900, None, 0), (901, "", 0)],
                         [*labels, (None, 1), (5, None), (6, 1), (6, 0), (7777, 1)])
    got = tox.toxicity(docs, known).collect()
    assert len(got) == 204 and {r.score for r in got if r.doc_id in (900, 901)} != {None}
    left = tox.without_toxic(docs, known)
    assert left.columns == docs.columns
    assert left.count() == sum(r.predicted == 0 for r in got)
    for few in (known.where("doc_id < 0"), known.where("toxic = 1"), known.where("toxic = 0")):
        assert tox.toxicity(edge_docs, few).count() == edge_docs.count()
    assert {r.score for r in tox.toxicity(edge_docs, known.where("doc_id < 0")).collect()} == {0.0}
    assert tox.toxicity(no_docs, known).count() == 0


def test_sample_data(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    apart = tox.toxicity(docs, labels).join(labels, "doc_id").where("held_out")
    found, toxic, wrong, blank = apart.agg(
        F.sum(F.expr("int(predicted = 1 AND toxic = 1)")),
        F.sum("toxic"),
        F.sum(F.expr("int(predicted = 1 AND toxic = 0)")),
        F.sum(F.expr("int(size(evidence) = 0)")),
    ).first()
    assert (toxic, blank) == (144, 0)
    assert found >= 126 and wrong <= 9, (found, wrong)
