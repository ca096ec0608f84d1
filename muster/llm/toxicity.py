"""Toxicity by the nearest labelled examples, with exact TF-IDF cosines.

Fitting: the examples are a bounded sample of labelled rows (``SAMPLE``, at least
half of it for either label where there are so many; those of least hash).  Every
word of an example is a term.  Document frequencies are counted over all
documents, each task adding up its own before they are combined.  A term weighs
its idf times ``FLOOR`` plus, where it is more frequent with the label, the root of
its likelihood ratio: words that say nothing of the label count little, but none
is left out.  The examples' vectors make an inverted index: each term's postings,
in blocks of ``BLOCK`` examples with the largest weight in every block.  Examples
whose commonest words are the same stand together, so that a block's words are
mostly of one language.  The index is as large as the sample's texts and is
broadcast.

Scoring, over all rows: a document's vector meets the index.  The blocks' largest
weights bound what their examples can score; the most promising blocks are
scored first, then all whose bound reaches the k-th best so far, so the nearest
``NEIGHBOURS`` are exact.  Their labels vote with their cosines as weights, on
top of a prior vote of the base rate; a label of which the sample has more than its
share votes that much less.  A logistic curve fitted to votes within the sample
(each example without itself) makes the vote a score.  A text without any word of
an example, such as an empty or null one, has the share of the label among
examples without words.

The score depends on the text alone.  Rows without label, or with a null one, are
not learnt from; of several labels of a document the largest holds, and of several
texts the least is learnt.  Without any labelled row all scores are 0.  Repeated
rows and null ids each give their own row; other columns are kept.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muster.llm.frames import free_name, id_and_text, utf8

SAMPLE = 2048
FLOOR = 0.2  # of a term's weight, beside the root of its likelihood ratio
BLOCK = 64
CROWDED = 16
NEIGHBOURS = 15
PRIOR_VOTE = 1.0
REJECTED_FROM = 0.7

_words = re.compile(r"[^\W\d_]+").findall
_TO_SPACES = {c: " " for c in range(128) if not chr(c).isalpha()}


def words_of(text: str) -> list[str]:
    """Runs of letters, in lower case."""
    text = text.lower()
    return text.translate(_TO_SPACES).split() if text.isascii() else _words(text)


def term_weights(positive: np.ndarray, negative: np.ndarray, sizes: tuple[int, int], frequency: np.ndarray, rows: int):
    """Weights of terms: ``positive`` and ``negative`` examples with each, of ``sizes``
    examples with and without the label, and its ``frequency`` in ``rows`` documents."""
    idf = np.log((1 + rows) / (1 + np.minimum(frequency, rows))) + 1
    with_label, without = max(sizes[0], 1), max(sizes[1], 1)
    total = sizes[0] + sizes[1]

    def part(seen, size, both):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1) / size / np.maximum(both, 1e-300)), 0.0)

    held = (positive + negative) / max(total, 1)
    ratio = sum(
        part(np.maximum(seen, 0), size, share)
        for seen, size, share in (
            (positive, with_label, held),
            (negative, without, held),
            (sizes[0] - positive, with_label, 1 - held),
            (sizes[1] - negative, without, 1 - held),
        )
    )
    speaks = positive / with_label > negative / without
    return idf * (FLOOR + np.where(speaks, np.sqrt(np.maximum(ratio, 0.0)), 0.0))


class Vocabulary:
    def __init__(self, terms: list[str], weights: np.ndarray):
        self.place = {t: i for i, t in enumerate(terms)}
        self.weights = weights

    def vector(self, counts: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        """Terms, ascending, and weights of length one; empty without any term."""
        places = np.fromiter(map(self.place.get, counts, repeat(-1)), np.int64, len(counts))
        times = np.fromiter(counts.values(), np.float64, len(counts))[places >= 0]
        terms = places[places >= 0]
        if not len(terms):
            return terms, times
        order = np.argsort(terms)
        terms = terms[order]
        weights = (1 + np.log(times[order])) * self.weights[terms]
        return terms, weights / math.sqrt(float(weights @ weights))


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges one after another, and the ranges' sizes."""
    sizes = ends - starts
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes), sizes


class BlockMaxIndex:
    """Postings by term and block of examples, with the largest weight of each.

    Terms of one example in ``CROWDED`` and more are rows of a matrix instead, as
    no block could be passed over for their sake: one product gives what they add
    to every cosine, and the blocks' bounds start from that.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int, block: int = BLOCK):
        self.n = len(vectors)
        self.blocks = max(1, -(-self.n // block))
        sizes = [len(t) for t, _ in vectors]
        terms = np.concatenate([np.zeros(0, dtype=np.int64), *(t for t, _ in vectors)])
        weights = np.concatenate([np.zeros(0), *(w for _, w in vectors)])
        examples = np.repeat(np.arange(self.n), sizes)
        crowded = np.bincount(terms, minlength=n_terms) * CROWDED >= max(self.n, CROWDED)
        self.row = np.where(crowded, np.cumsum(crowded) - 1, -1)
        self.rows = np.zeros((int(crowded.sum()), self.blocks * block))
        here = crowded[terms]
        self.rows[self.row[terms[here]], examples[here]] = weights[here]
        terms, weights, examples = terms[~here], weights[~here], examples[~here]
        order = np.argsort(terms, kind="stable")  # examples ascend within a term
        terms, self.weights, self.examples = terms[order], weights[order], examples[order]
        pairs = terms * self.blocks + self.examples // block
        first = np.flatnonzero(np.diff(pairs, prepend=-1))
        self.pair_start = np.append(first, len(pairs))
        self.pair_block = pairs[first] % self.blocks
        self.pair_largest = np.maximum.reduceat(self.weights, first) if len(first) else np.zeros(0)
        self.term_start = np.searchsorted(pairs[first] // self.blocks, np.arange(n_terms + 1))

    def _scores(self, pairs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What the given pairs of term and block add to each example's cosine."""
        at, sizes = _ranges(self.pair_start[pairs], self.pair_start[pairs + 1])
        return np.bincount(self.examples[at], np.repeat(weights, sizes) * self.weights[at], self.n)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of highest positive cosine, ties to the earlier one, and their cosines."""
        if not len(terms) or not self.n:
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        rows = self.row[terms]
        crowded = rows >= 0
        start = weights[crowded] @ self.rows[rows[crowded]]
        terms, weights = terms[~crowded], weights[~crowded]
        pairs, sizes = _ranges(self.term_start[terms], self.term_start[terms + 1])
        weights, blocks = np.repeat(weights, sizes), self.pair_block[pairs]
        most = start.reshape(self.blocks, -1).max(axis=1)
        bounds = most + np.bincount(blocks, weights * self.pair_largest[pairs], self.blocks)
        scores = start[: self.n]  # below the cosine in blocks that aren't tried
        tried = np.zeros(self.blocks, dtype=bool)
        tried[np.argsort(-bounds, kind="stable")[:4]] = True
        held = tried[blocks]
        scores = scores + self._scores(pairs[held], weights[held])
        if without >= 0:
            scores[without] = 0
        kth = np.partition(scores, self.n - k)[self.n - k] if self.n >= k else 0.0
        rest = (bounds >= kth - 1e-12) & (bounds > 0) & ~tried
        if rest.any():
            held = rest[blocks]
            scores += self._scores(pairs[held], weights[held])
            if without >= 0:
                scores[without] = 0
        found = np.flatnonzero(scores > 0)
        if len(found) > k:  # all that may be among the first k, ties included
            found = found[scores[found] >= np.partition(scores, self.n - k)[self.n - k]]
        best = found[np.lexsort((found, -scores[found]))][:k]
        return best, scores[best]


class Model:
    def __init__(
        self,
        terms: list[str],
        weights: np.ndarray,
        examples: list[tuple[int, int, dict[str, int]]],
        frequency: np.ndarray | None = None,
        share: tuple[float, float] = (1.0, 1.0),
    ):
        """``examples``: (id, label, counts of terms); ``share``: what an example
        without and one with the label stand for."""
        self.vocabulary = Vocabulary(terms, weights)
        total = sum(share[y] for _, y, _ in examples)
        self.base = share[1] * sum(y for _, y, _ in examples) / total if examples else 0.0
        plain = [share[y] * np.array([y, 1.0]) for _, y, c in examples if not c]
        agreed, voted = sum(plain, np.zeros(2))
        self.without_terms = (agreed + PRIOR_VOTE * self.base) / (voted + PRIOR_VOTE) if examples else 0.0

        held = [(i, y, self.vocabulary.vector(c)) for i, y, c in examples if c]
        if frequency is not None:  # examples with the same commonest words stand together
            held.sort(key=lambda e: (sorted(e[2][0][np.argsort(-frequency[e[2][0]], kind="stable")[:3]]), e[0]))
        self.ids = [i for i, _, _ in held]
        self.labels = np.array([y for _, y, _ in held], dtype=float)
        self.shares = np.where(self.labels > 0, share[1], share[0])
        self.index = BlockMaxIndex([v for _, _, v in held], len(terms))
        votes = [self.vote(*self.index.nearest(*v, NEIGHBOURS, without=n)) for n, (_, _, v) in enumerate(held)]
        self.slope, self.offset = _logistic(np.array(votes), self.labels, self.shares)

    def vote(self, nearest: np.ndarray, cosines: np.ndarray) -> float:
        weights = cosines * self.shares[nearest]
        return float((weights @ self.labels[nearest] + PRIOR_VOTE * self.base) / (weights.sum() + PRIOR_VOTE))

    def score(self, text: str) -> tuple[float, list[int]]:
        """(score, ids of the examples that it rests on)."""
        terms, weights = self.vocabulary.vector(Counter(words_of(text)))
        if not len(terms) or not len(self.labels):
            return self.without_terms, []
        nearest, cosines = self.index.nearest(terms, weights, NEIGHBOURS)
        logit = self.slope * self.vote(nearest, cosines) + self.offset
        return 1 / (1 + math.exp(-min(50.0, max(-50.0, logit)))), [self.ids[i] for i in nearest]


def _logistic(votes: np.ndarray, labels: np.ndarray, shares: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve of most likelihood, with Platt's
    targets and a weak pull to a rising curve; ``shares`` weigh the examples."""
    positive, negative = (shares * labels).sum(), (shares * (1 - labels)).sum()
    target = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    weights = np.array([4.0, -2.0])
    pull, centre = 1e-3, weights.copy()
    columns = np.stack([votes, np.ones(len(votes))], axis=1) if len(votes) else np.zeros((0, 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(columns @ weights, -50, 50)))
        slope = columns.T @ (shares * (p - target)) + pull * (weights - centre)
        curve = (columns * (shares * p * (1 - p))[:, None]).T @ columns + pull * np.eye(2)
        step = np.linalg.solve(curve, slope)
        weights -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    if weights[0] <= 0:  # votes say nothing: the share of the label
        return 0.0, float(np.log((positive + 1) / (negative + 1)))
    return float(weights[0]), float(weights[1])


def held_out(number):
    """Whether a document's label may not be learnt."""
    remainder = F.crc32(number.cast("string").cast("binary")) % 3
    return F.coalesce(remainder == 1, F.lit(False))


def _chosen(known: DataFrame, sample: int) -> tuple[DataFrame, tuple[float, float]]:
    """At most ``sample`` rows of (doc_id, label), and how many rows one of label 0
    and one of label 1 stands for."""
    sizes = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    negative, positive = sizes.get(0, 0), sizes.get(1, 0)
    with_label = min(positive, max(sample // 2, sample - negative))
    without = min(negative, sample - with_label)
    parts = [
        known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
        for label, size in ((0, without), (1, with_label))
    ]
    return parts[0].unionByName(parts[1]), (negative / max(without, 1), positive / max(with_label, 1))


def _term_counts(examples: DataFrame) -> list[tuple[int, int, dict[str, int]]]:
    """(id, label, counts of words) of the examples, by id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Counter(words_of(t.decode())) for t in utf8(batch.column("text"))]
            arrays = [
                batch.column("doc_id"),
                batch.column("label"),
                pa.array([list(c) for c in found], pa.list_(pa.string())),
                pa.array([list(c.values()) for c in found], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "label", "terms", "counts"])

    schema = "doc_id BIGINT, label INT, terms ARRAY<STRING>, counts ARRAY<BIGINT>"
    rows = examples.mapInArrow(run, schema).orderBy("doc_id").collect()  # at most ``sample`` rows
    return [(r.doc_id, r.label, dict(zip(r.terms, r.counts))) for r in rows]


def _frequencies(texts: DataFrame, terms: list[str]) -> tuple[np.ndarray, int]:
    """In how many of all documents each term stands, and the number of documents."""
    shared = texts.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(terms)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, rows = shared.value, 0
        known, found = frozenset(place), Counter()
        for batch in batches:
            rows += batch.num_rows
            for text in utf8(batch.column("text")):
                found.update(known.intersection(words_of(text.decode())))
        columns = [[-1, *(place[t] for t in found)], [rows, *found.values()]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["term", "n"])

    counted = texts.select("text").mapInArrow(run, "term BIGINT, n BIGINT").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r.term: r.n for r in counted.collect()}  # the examples' terms
    shared.destroy()
    frequency = np.zeros(len(terms), dtype=np.int64)
    for term, n in found.items():
        if term >= 0:
            frequency[term] = n
    return frequency, found.get(-1, 0)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: int = SAMPLE,
) -> Model:
    """A model of at most ``sample`` of the labelled rows that may be learnt, and of
    the frequencies of their words in all rows."""
    texts = id_and_text(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    known = (
        labels.select(F.col(id_col).cast("bigint").alias("doc_id"), (F.col(label_col) > 0).cast("int").alias("label"))
        .dropna()
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    chosen, share = _chosen(known, sample)
    rows = texts.join(F.broadcast(chosen), "doc_id")
    examples = _term_counts(rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")))
    terms = sorted({t for _, _, counts in examples for t in counts})
    if not examples:
        return Model([], np.zeros(0), [])

    place = {t: i for i, t in enumerate(terms)}
    held = np.zeros((2, len(terms)))
    for _, label, counts in examples:
        held[label, [place[t] for t in counts]] += 1
    with_label = sum(y for _, y, _ in examples)
    frequency, n_rows = _frequencies(texts, terms)
    weights = term_weights(held[1], held[0], (with_label, len(examples) - with_label), frequency, n_rows)
    return Model(terms, weights, examples, frequency, share)


def scored(docs: DataFrame, model: Model, text_col: str = "text", score: str = "score", evidence: str = "evidence") -> DataFrame:
    """All rows and columns, and the score and the ids of the examples behind it."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    schema = T.StructType(
        [*docs.schema.fields, T.StructField(score, T.DoubleType()), T.StructField(evidence, T.ArrayType(T.LongType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.score(t.decode()) for t in utf8(batch.column(at))]
            more = [pa.array([s for s, _ in found], pa.float64()), pa.array([e for _, e in found], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, score, evidence])

    return docs.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence) for each row."""
    rows = scored(id_and_text(docs, id_col, text_col), fit(docs, labels, id_col, text_col))
    return rows.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= REJECTED_FROM).cast("int").alias("predicted"),
        "evidence",
    )


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, all columns, that score below ``REJECTED_FROM``."""
    score, evidence = free_name(docs, "toxicity_score"), free_name(docs, "toxicity_evidence")
    rows = scored(docs, fit(docs, labels, id_col, text_col), text_col, score, evidence)
    return rows.where(F.col(score) < REJECTED_FROM).select(*docs.columns)
