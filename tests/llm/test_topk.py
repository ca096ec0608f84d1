import math

import numpy as np
import pytest

from muster.llm import topk


def brute(rows, queries, k):
    vectors = [
        (i, [math.floor(256 * float(x)) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    result = []
    for q in queries:
        own = [v for i, v in vectors if i == q]
        if not own:
            continue
        scores = sorted((-sum(a * b for a, b in zip(min(own), v)), i) for i, v in vectors if i != q)
        result += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(result)


def run(spark, rows, queries, k, kind="FLOAT", **options):
    frame = spark.createDataFrame(rows, f"vec_id BIGINT, embedding ARRAY<{kind}>, rank INT").repartition(3)
    wanted = frame.where(frame.vec_id.isin(list(queries)))
    return sorted(tuple(r) for r in topk.exact_top_k(frame, wanted, k, **options).collect())


def test_against_brute_force_with_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4) / 4]) for i in range(150)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(200, 260)]
    rows += [(300, None), (301, [1.0, None]), (302, [float("nan")]), (303, [float("inf")]), (304, []), (305, [1.0]),
             (306, [1.0] * 7), (None, [1.0]), (5, [1.0, 1.0, 1.0, 1.0]), (7, rows[7][1])]
    queries = [0, 5, 7, 9, 200, 210, 300, 304, 305, 306, 999]
    frame_rows = [(*r, 1) for r in rows]
    for k in (1, 5, 400):
        assert run(spark, frame_rows, queries, k) == brute(rows, queries, k)
    assert run(spark, frame_rows, queries, 5, block=3) == brute(rows, queries, 5)


def test_large_components_stay_exact(spark):
    rows = [(1, [3e14, 1.0]), (2, [3e14 / 256, 2.0]), (3, [1.0, 1.0]), (4, [-3e10, 5.0]), (5, [2.0**20, 3.0])]
    got = run(spark, [(*r, 1) for r in rows], [1, 3, 4], 4, "DOUBLE")
    limit = 2**63 - 1
    want = [(q, n, i, max(-limit, min(limit, s))) for q, n, i, s in brute(rows, [1, 3, 4], 4)]
    assert [(q, s) for q, _, _, s in got] == [(q, s) for q, _, _, s in want]


def test_empty(spark):
    assert run(spark, [], [1], 5) == []
    assert run(spark, [(1, [1.0], 1)], [1], 5) == []
