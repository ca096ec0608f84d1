"""Exact top-k search by inner product, by selection on score histograms.

All candidates are scored against a block of queries at a time; a block has a
bounded number of vectors and is broadcast.  For each query, the range of
possible scores is cut into bins; tasks count their scores by bin, the sum over
tasks shows the bin that holds the k-th highest score, and that bin is cut into
bins again until it is one score wide.  A last pass keeps what scores higher,
and of those that score exactly this the smallest ids.

A task's scores below its own k-th highest cannot be among the k highest of
all, so it counts only its k highest in the range: what is shuffled is at most
k rows per query and task, whatever ties or hot vectors there are.  The driver
holds one block's queries and its summed histograms, whose sizes are bounded by
``BLOCK`` and ``BINS``.

Vectors that are null or hold null or non-finite components take no part.  The
shorter of two vectors counts as padded with zeros.  Every row is a candidate
of its own, so a repeated row takes a rank each time; a query is a distinct id
(of several vectors the least), and rows with its id are not its candidates.
Scores beyond 64 bits saturate.  Rows without id take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster.sources.scratch import cut

BLOCK = 2048  # queries that are scored at a time
BINS = 512
_CHUNK = 1 << 21  # scores held at a time in a task
_EXACT = float(1 << 53)
_NONE = np.iinfo(np.int64).min


def finite(vector: Column) -> Column:
    """Whether a vector takes part."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & whole, F.lit(False))


def quantized(rows: DataFrame, id_col: str, vector_col: str, scale: float = 256.0) -> DataFrame:
    """(id, vector): floor(scale * x) of each component x as double."""
    vector = F.col(vector_col)
    return rows.where(finite(vector) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * scale)).alias("vector"),
    )


def _matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Vectors as rows, padded with zeros (or cut) to ``width``."""
    offsets = column.offsets.to_numpy()
    sizes = np.diff(offsets)
    values = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    if width is None:
        width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    start = 0
    for i, size in enumerate(sizes):
        out[i, : min(size, width)] = values[start : start + min(size, width)]
        start += size
    return out


def _scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products as 64-bit integers, exactly."""
    most = [float(np.abs(m.astype(float)).max(initial=0)) for m in (queries, candidates)]
    if most[0] * most[1] * queries.shape[1] < _EXACT:
        return (queries.astype(float) @ candidates.astype(float).T).astype(np.int64)
    exact = queries.astype(object) @ candidates.astype(object).T
    limits = np.iinfo(np.int64)
    return np.clip(exact, limits.min + 1, limits.max).astype(np.int64)


class _Block:
    """Queries in the order of their ids."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids)
        self.ids, self.vectors = ids[order], vectors[order]

    def score(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, scores of all queries) for chunks of candidates; none for a query's own rows."""
        step = max(1, _CHUNK // max(1, len(self.ids)))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                ids = part.column("id").to_numpy()
                scores = _scores(self.vectors, _matrix(part.column("vector"), self.vectors.shape[1]))
                at = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
                own = np.flatnonzero(self.ids[at] == ids)
                scores[at[own], own] = _NONE
                yield ids, scores


def _highest(scores: np.ndarray, k: int) -> np.ndarray:
    n = scores.shape[1]
    return np.partition(scores, n - k, axis=1)[:, n - k :] if n > k else scores


def _histogram(candidates: DataFrame, block, low: np.ndarray, high: np.ndarray, width: np.ndarray, k: int):
    """Rows (query, bin, n) of scores from low to high, as far as the k-th highest needs them."""

    def run(batches):
        best = np.full((len(low), 0), _NONE)
        for _, scores in block.value.score(batches):
            scores = np.where((scores >= low[:, None]) & (scores <= high[:, None]), scores, _NONE)
            best = _highest(np.concatenate([best, _highest(scores, k)], axis=1), k)
        query, at = np.nonzero(best != _NONE)
        # Unsigned, as a range may be wider than a signed integer.
        bins = (best[query, at].astype(np.uint64) - low[query].astype(np.uint64)) // width[query].astype(np.uint64)
        pairs, counts = np.unique(np.stack([query, bins.astype(np.int64)]), axis=1, return_counts=True)
        columns = (pairs[0], pairs[1], counts)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query", "bin", "n"])

    counted = candidates.mapInArrow(run, "query BIGINT, bin BIGINT, n BIGINT")
    return counted.groupBy("query", "bin").agg(F.sum("n").alias("n")).collect()


def _least_scores(candidates: DataFrame, block, bound: np.ndarray, k: int) -> np.ndarray:
    """Each query's k-th highest score, or one below all scores if it has fewer."""
    low, high = -bound, bound.copy()
    above = np.zeros(len(bound), dtype=np.int64)  # candidates that score higher than ``high``
    few = np.zeros(len(bound), dtype=bool)
    while True:
        # Ranges may be as wide as all 64-bit integers, so Python's own are used.
        width = np.array([max(1, -(-(int(h) - int(a) + 1) // BINS)) for a, h in zip(low, high)], dtype=np.int64)
        counts: dict[int, list] = {}
        for row in _histogram(candidates, block, low, high, width, k):
            counts.setdefault(row.query, []).append((row.bin, row.n))
        for q in range(len(low)):
            if few[q] or low[q] == high[q]:
                continue
            for bin_, n in sorted(counts.get(q, ()), reverse=True):
                if above[q] + n >= k:
                    first = int(low[q]) + bin_ * int(width[q])
                    low[q], high[q] = first, min(int(high[q]), first + int(width[q]) - 1)
                    break
                above[q] += n
            else:
                few[q] = True
        if (few | (low == high)).all():
            return np.where(few, _NONE, low)


def exact_top_k(
    rows: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block: int = BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest scores, ties to the smaller id."""
    spark = rows.sparkSession
    candidates = quantized(rows, id_col, vector_col)
    asked = cut(quantized(queries, id_col, vector_col).groupBy("id").agg(F.min("vector").alias("vector")))
    n = asked.count()
    blocks = max(1, -(-n // block))
    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    longest = float(candidates.agg(F.sqrt(F.max(norm)).alias("m")).first().m or 0.0)
    found = []
    for number in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == number).toArrow().combine_chunks()
        if not own.num_rows:
            continue
        vectors = _matrix(own.column("vector").chunk(0))
        queries_ = _Block(own.column("id").to_numpy(), vectors)
        # By Cauchy and Schwarz, and a little more than rounding can take away.
        sizes = np.sqrt((queries_.vectors.astype(float) ** 2).sum(axis=1))
        most = np.iinfo(np.int64).max
        bound = np.array([most if s * longest >= 2.0**62 else int(s * longest * (1 + 1e-9)) + 2 for s in sizes])
        shared = spark.sparkContext.broadcast(queries_)
        least = _least_scores(candidates, shared, bound, k)
        found.append(cut(_select(candidates, shared, least, k)))
    if not found:
        return spark.createDataFrame([], "query_id BIGINT, rank INT, vec_id BIGINT, score BIGINT")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _select(candidates: DataFrame, block, least: np.ndarray, k: int) -> DataFrame:
    """What scores at least the k-th highest; of what scores that, a task's k smallest ids."""

    def run(batches):
        ties: dict[int, list[int]] = {}
        for ids, scores in block.value.score(batches):
            own = block.value.ids
            query, at = np.nonzero(scores > least[:, None])
            yield _found(own[query], ids[at], scores[query, at])
            query, at = np.nonzero((scores == least[:, None]) & (scores != _NONE))
            for q in np.unique(query):
                tied = np.sort(ids[at[query == q]])[:k].tolist()
                ties[q] = sorted(ties.get(q, []) + tied)[:k]
        for q, tied in ties.items():
            yield _found(np.full(len(tied), block.value.ids[q]), np.array(tied), np.full(len(tied), least[q]))

    return candidates.mapInArrow(run, "query_id BIGINT, vec_id BIGINT, score BIGINT")


def _found(query: np.ndarray, vec: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array(c, pa.int64()) for c in (query, vec, score)]
    return pa.RecordBatch.from_arrays(arrays, names=["query_id", "vec_id", "score"])
