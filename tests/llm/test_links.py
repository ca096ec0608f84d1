import numpy as np
import pytest

from muster.llm import neardup_vectors as vectors
from muster.llm.components import connected_components


def components(links):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {x: root(x) for x in list(parent)}


def test_components(spark):
    rng = np.random.default_rng(4)
    links = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 40)] + [(50, 50)]
    links += [tuple(map(int, rng.integers(200, 400, 2))) for _ in range(120)]
    links += [(7, 3), (3, 7), (3, 7)]
    frame = spark.createDataFrame([*links, (None, 3)], "a BIGINT, b BIGINT")
    got = {r.id: r.component for r in connected_components(frame).collect()}
    assert got == components(links)
    assert connected_components(frame.where("a < 0")).count() == 0


def brute(rows):
    good = [(i, np.array(v, float) / max(map(abs, v))) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, counts = [], {}
    for n, (i, x) in enumerate(good):
        for j, y in good[n + 1 :]:
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.9:
                links.append((i, j))
                counts[i] = counts.get(i, 0) + 1
                counts[j] = counts.get(j, 0) + 1
    found = components(links)
    ids = {i for i, _ in rows if i is not None}
    return sorted((i, counts.get(i, 0), found.get(i, i), found.get(i, i) == i) for i in ids)


def cloud(seed, groups, size, width, spread):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = rng.normal(size=width)
        for _ in range(int(rng.integers(1, size))):
            rows.append((centre + spread * rng.normal(size=width)).tolist())
    order = rng.permutation(len(rows))
    return [(int(i), rows[n]) for i, n in enumerate(order)]


@pytest.mark.parametrize("exact", [True, False])
def test_vector_links_equal_brute_force(spark, exact):
    rows = cloud(1, 120, 8, 64, 0.25)
    rows += [(1000 + i, rows[3][1]) for i in range(60)]
    rows += [(2000, None), (2001, [0.0] * 64), (2002, [float("nan")] + [1.0] * 63), (2003, []), (2004, [1.0, 2.0]),
             (2005, [2.0, 4.1]), (2006, [-0.0, 1.0]), (2007, [0.0, 1.0]), (2008, [1e300, 1e300]), (2009, [1e-300, 1e-300])]
    frame = spark.createDataFrame([(*r, "x", 5) for r in rows], "vec_id BIGINT, embedding ARRAY<DOUBLE>, component_id STRING, n INT").repartition(3)
    got = vectors.near_duplicates(frame, cell_size=40, exact=exact)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_recall_of_links_at_the_threshold(spark):
    """Pairs of exactly the least similarity, in many cells."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(800):
        x = rng.normal(size=64)
        x /= np.linalg.norm(x)
        y = rng.normal(size=64)
        y -= (x @ y) * x
        y /= np.linalg.norm(y)
        rows += [(2 * i, x.tolist()), (2 * i + 1, (0.901 * x + (1 - 0.901**2) ** 0.5 * y).tolist())]
    frame = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    got = vectors.near_duplicates(frame, cell_size=25)
    assert got.where("n_links >= 1").count() >= 0.99 * 1600
    assert vectors.near_duplicates(frame, cell_size=25, exact=True).where("n_links >= 1").count() == 1600


def test_links_of_vectors_in_few_directions(spark):
    """Noise in 4 of 64 dimensions spans more across borders than in all of them."""
    rng = np.random.default_rng(8)
    rows = [(i, [*x, *[0.0] * 60]) for i, x in enumerate(rng.normal(size=(1500, 4)).tolist())]
    frame = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    units = vectors.unit_rows(np.array([v for _, v in rows]))
    links = (units @ units.T >= 0.9).sum(axis=1) - 1
    got = vectors.near_duplicates(frame, cell_size=25).collect()
    assert {r.vec_id: r.n_links for r in got} == dict(enumerate(links.tolist()))


def test_no_vectors(spark):
    frame = spark.createDataFrame([], "vec_id BIGINT, embedding ARRAY<FLOAT>")
    assert vectors.near_duplicates(frame).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id BIGINT, embedding ARRAY<FLOAT>")
    assert sorted(tuple(r) for r in vectors.near_duplicates(nulls).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]
