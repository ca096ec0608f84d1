import random
import re

import numpy as np
import pytest

from muster.llm import neardup_texts as dedup
from muster.llm import setsketch
from muster.llm.shingles import shingle_set
from tests.llm.test_links import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    links = [(i, i) for i, _ in sets]
    for n, (i, x) in enumerate(sets):
        for j, y in sets[n + 1 :]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                links.append((i, j))
    found = components(links)
    sizes = {}
    for i, s in sets:
        sizes[i] = max(len(s), sizes.get(i, 0))
    return sorted((i, n, found[i], found[i] == i) for i, n in sizes.items())


def corpus(seed):
    rng = random.Random(seed)

    def words(n):
        return [f"w{rng.randrange(5000)}" for _ in range(n)]

    def edited(text, n):
        text = list(text)
        for _ in range(n):
            text[rng.randrange(len(text))] = f"e{rng.randrange(10**6)}"
        return text

    rows = []
    for _ in range(25):  # near copies around the threshold
        base = words(rng.randrange(3, 120))
        rows += [edited(base, rng.randrange(0, 1 + len(base) // 25)) for _ in range(rng.randrange(1, 9))]
    chain = words(200)  # each like the next, ends unlike each other
    for _ in range(8):
        rows.append(chain)
        chain = edited(chain, 4)
    passage = words(80)  # in many documents, with too little or just enough else
    rows += [passage + words(rng.randrange(5, 60)) for _ in range(60)]
    base = words(90)
    rows += [edited(base, rng.randrange(0, 7)) for _ in range(80)]
    rows += [words(n) for n in (1, 2, 3, 4, 5, 6) for _ in range(2)]
    rows += [rows[0]] * 40
    rng.shuffle(rows)
    return [(i, " \n"[rng.randrange(2)].join(w.upper() if rng.random() < 0.2 else w for w in r)) for i, r in enumerate(rows)]


def result(frame):
    got = dedup.near_duplicates(frame)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("centres", [1, 4])
def test_equal_to_brute_force(spark, monkeypatch, centres):
    monkeypatch.setattr(dedup, "CENTRES", centres)
    rows = corpus(centres)
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id BIGINT, text STRING, kept INT").repartition(4)
    assert result(frame) == brute(rows)


def test_odd_rows(spark, edge_docs, no_docs):
    long_ = " ".join(f"x{i}" for i in range(40))
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, long_), (5, long_), (6, long_), (5, "other text that is short"),
            (7, "Other text that IS short"), (8, "a b"), (9, "A  B"), (10, "a b c")]
    frame = spark.createDataFrame([(*r, "z") for r in rows], "doc_id BIGINT, text STRING, component_id STRING")
    assert result(frame) == brute(rows)
    assert result(edge_docs) == brute([(r.doc_id, r.text) for r in edge_docs.collect()])
    assert result(no_docs) == []


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    for n in (1, 3, 40, 700):
        x, y = (rng.integers(0, 2**63, n).astype(np.uint64) for _ in range(2))
        both = setsketch.registers([x, y, np.concatenate([x, y])])
        assert (np.maximum(both[0], both[1]) == both[2]).all()
    common = rng.integers(0, 2**63, 900).astype(np.uint64)
    one, other = (np.concatenate([common, rng.integers(0, 2**63, 100).astype(np.uint64)]) for _ in range(2))
    a, b = setsketch.registers([one, other])
    assert abs((a == b).mean() - 900 / 1100) < 0.1
    sizes = np.array([1000.0])
    assert not setsketch.unlikely(a[None], b[None], sizes, sizes, 0.75)[0]
    far = setsketch.registers([rng.integers(0, 2**63, 1000).astype(np.uint64)])
    assert setsketch.unlikely(a[None], far, sizes, sizes, 0.75)[0]


def test_sets_keep_short_sequences_apart():
    assert len(shingle_set(b"")) == 0 and len(shingle_set(b"a b c d")) == 1
    assert shingle_set(b"a b c d")[0] != shingle_set(b"a b c d d")[0]
    assert (shingle_set(b"A B c d e f") == shingle_set(b"a b  c\nd e f")).all()


def test_bands_meet_at_the_threshold(spark):
    """Pairs of just the least similarity share a bucket."""
    rng = np.random.default_rng(3)
    missed = 0
    for _ in range(300):
        common = rng.integers(0, 2**63, 300).astype(np.uint64)
        one, other = (np.concatenate([common, rng.integers(0, 2**63, 50).astype(np.uint64)]) for _ in range(2))
        keys = setsketch.bands(setsketch.registers([one, other]))
        missed += not (keys[0] == keys[1]).any()
    assert missed == 0
