import numpy as np
import pytest
from pyspark.sql import functions as F

from muster.llm import hard_negatives as hard

LIMIT = 2**63 - 1
SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, rank INT, id STRING"


def whole(vector):
    return [int(np.floor(256 * float(x))) for x in vector]


def brute(rows, is_anchor, positives=5, negatives=10):
    good = [
        (i, label, whole(v)) for i, v, label, *_ in rows
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]

    def score(a, b):
        return min(max(sum(x * y for x, y in zip(a, b)), -LIMIT), LIMIT)

    found = []
    for i in sorted({i for i, *_ in good if is_anchor(i)}):
        _, label, vector = min(row for row in good if row[0] == i)
        others = [(-score(vector, v), j, other) for j, other, v in good if j != i]
        same = sorted((s, j) for s, j, other in others if other == label)[:positives]
        for place, (s, j) in enumerate(same):
            fits = sorted((t, n) for t, n, other in others if other != label and 30 * -s <= 100 * -t <= 90 * -s)
            found += [(i, j, r + 1, n, -s, -t, place + 1) for r, (t, n) in enumerate(fits[:negatives])]
    return sorted(found)


def mined(spark, rows, parts=3, **options):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return sorted(tuple(r) for r in hard.mine(frame, F.col("vec_id") % 10 == 0, **options).collect())


def made(n, width, labels, seed, spread=0.5):
    """Clustered vectors of which some repeat."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, width))
    rows = []
    for i in range(n):
        label = int(rng.integers(labels))
        vector = (centres[label] + spread * rng.normal(size=width)).astype(np.float32).tolist()
        if i % 9 == 1:
            vector = rows[-1][1]
        rows.append((i, vector, label, 1, "x"))
    return rows


@pytest.mark.parametrize("width", [1, 3, 64, 65, 200])
def test_bounds_always_hold(width):
    rng = np.random.default_rng(width)
    rows = np.floor(256 * rng.normal(size=(400, width)) * rng.choice([0, 1e-3, 1, 50], (400, 1)))
    queries = np.floor(256 * rng.normal(size=(30, width)) * rng.choice([0, 1, 9], (30, 1)))
    padded = hard.padded_width(width)
    codes, alignments, residuals = hard.coded(rows, padded)
    least, most = hard.Queries(queries, padded).intervals(codes, alignments, residuals)
    exact = queries @ rows.T
    assert (least <= exact).all() and (exact <= most).all()


def test_rotation_keeps_lengths_and_angles():
    rows = np.random.default_rng(2).normal(size=(20, 128))
    for level in range(hard.LEVELS):
        turned = hard.rotated(rows, level)
        assert np.allclose(turned @ turned.T, rows @ rows.T)


def test_most_rows_are_passed_over():
    rng = np.random.default_rng(5)
    rows = np.floor(256 * rng.normal(size=(4000, 64)))
    queries = rows[:20] + np.floor(40 * rng.normal(size=(20, 64)))
    codes, alignments, residuals = hard.coded(rows, 64)
    least, most = hard.Queries(queries, 64).intervals(codes, alignments, residuals)
    bound = np.sort(least, axis=1)[:, -5:][:, 0]
    assert (most >= bound[:, None]).mean() < 0.4
    lengths = np.sqrt((rows**2).sum(axis=1)) * np.sqrt((queries**2).sum(axis=1))[:, None]
    assert ((most - least) / 2 / lengths).mean() < 0.17


@pytest.mark.parametrize("width, block, parts", [(64, 2048, 3), (8, 4, 5), (70, 7, 1)])
def test_equals_brute_force(spark, width, block, parts):
    rows = made(300, width, 4, width)
    want = brute(rows, lambda i: i % 10 == 0)
    assert len(want) > 100
    assert mined(spark, rows, parts, block=block) == want


def test_other_counts(spark):
    rows = made(120, 16, 3, 8)
    assert mined(spark, rows, positives=2, negatives=3) == brute(rows, lambda i: i % 10 == 0, 2, 3)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = made(60, 4, 2, 1)
    rows += [
        (None, [1.0] * 4, 0, 1, None), (70, None, 0, 1, None), (71, [1.0, None, 0.0, 0.0], 0, 1, "x"),
        (72, [nan] * 4, 1, 1, "x"), (73, [inf, 0.0, 0.0, 0.0], 1, 1, "x"), (80, [1.0] * 4, None, 1, "x"),
        (90, [0.0] * 4, 0, 1, "x"), (91, [], 0, 1, "x"), (92, [1.0, 2.0], 1, 1, "x"), (100, [1.0] * 9, 1, 1, "x"),
        (110, [1e30] * 4, 0, 1, "x"), (111, [1e30, -1e30, 1.0, 0.0], 1, 1, "x"), (112, [-1e30] * 4, 1, 1, "x"),
        (10, [0.5] * 4, 1, 1, "again"), (10, [0.5] * 4, 0, 1, "again"),
    ]
    want = brute([r for r in rows if r[0] not in (110, 111, 112)], lambda i: i % 10 == 0)
    assert mined(spark, [r for r in rows if r[0] not in (110, 111, 112)]) == want
    assert mined(spark, rows)  # huge components saturate
    assert mined(spark, [r for r in rows if r[2] is None]) == []
    assert mined(spark, [r for r in rows if r[0] == 100]) == []


def test_ties_and_a_vector_of_a_third_of_the_rows(spark):
    same = [0.5, 0.25, 0.0, 1.0]
    rows = [(i, same, i % 3, 1, "x") for i in range(150)]
    rows += [(150 + i, [0.25, 0.25, 0.0, 0.5], i % 2, 1, "x") for i in range(150)]
    want = brute(rows, lambda i: i % 10 == 0)
    assert want and mined(spark, rows, 4) == want
    repeated = [(i % 40, v, label, 1, "x") for i, v, label, *_ in rows]
    assert mined(spark, repeated, 4) == brute(repeated, lambda i: i % 10 == 0)
