import numpy as np
import pytest

from muster.llm import neardup_vectors as vectors
from tests.llm.test_links import brute, cloud


@pytest.mark.parametrize("cell_size", [None, 50])
def test_crowded_cells_are_dealt_to_parts_and_slices(spark, monkeypatch, cell_size):
    """A cell with many vectors is many groups, whose rows hold one vector each."""
    monkeypatch.setattr(vectors, "HOMES", 40)
    monkeypatch.setattr(vectors, "MET", 60)
    monkeypatch.setattr(vectors, "BLOCK", 16)
    grids = []
    compared = vectors._compared

    def watched(grid, *args):
        grids.append(grid)
        return compared(grid, *args)

    monkeypatch.setattr(vectors, "_compared", watched)
    rows = cloud(5, 60, 10, 32, 0.25) + [(5000 + i, [1.0, *[0.001 * i] * 31]) for i in range(90)]
    rows = [(i, np.float32(v).tolist()) for i, v in rows]
    frame = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>").repartition(3)
    got = vectors.near_duplicates(frame, cell_size=cell_size)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)
    sizes = grids[0].groupBy("cell", "part", "slice", "own").count().collect()
    assert len(sizes) > 20
    assert max(r["count"] for r in sizes if r.own) < 80
    assert max(r["count"] for r in sizes if not r.own) < 120
    assert grids[0].schema["vector"].dataType.simpleString() == "array<float>"


def test_forest_connects_what_the_links_connect():
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 300, (2, 200))
    chain = np.arange(300, 400)
    x, y = np.concatenate([x, chain]), np.concatenate([y, chain + 1])
    first, rest = vectors._forest(x, y, 500)

    def parts(a, b):
        label = list(range(500))
        for _ in range(500):
            for i, j in zip(a.tolist(), b.tolist()):
                label[i] = label[j] = min(label[i], label[j])
        return label

    assert parts(first, rest) == parts(x, y)
    assert len(rest) <= 499
