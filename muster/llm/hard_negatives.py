"""Hard negatives by one-bit codes whose error is bounded.

Vectors are rotated by a fixed orthogonal map (signs and Hadamard butterflies)
and coded by the signs of their components, one bit each.  With a code c goes the
vector's alignment with it, a = <v, c> / n; what is left, v - a c, is rotated and
coded again, ``LEVELS`` times.  The length of the last residual is stored.

A query q is rotated alike and rounded to ``BITS`` bits a component, so that its
inner products with codes are sums of popcounts.  By Cauchy and Schwarz the inner
product <v, q> is no further from the sum of a <c, q> than

    |residual of v| |q| + |v| |q's rounding error|

and a little for floating point.  These are bounds that hold always, not with
some probability: rows whose interval cannot reach a place are passed over, and
only the others are scored as integers, exactly.

Anchors go in blocks of ``BLOCK``, each broadcast to the tasks that scan the coded
rows.  A first scan finds an anchor's positives, the second the negatives of
all its positives: of the rows scanned so far, a task keeps the best that one
anchor or positive needs, and the least of them, or the lower ends of the intervals
of a chunk, says what can be passed over.  A task returns at most as many rows
for an anchor (or positive) as are asked for, and those of all tasks are ranked by
a window.  On the driver are one block's anchors and their positives.

Rows without id, label or vector, or with a null or non-finite component, take
no part.  The shorter of two vectors counts as padded with zeros.  An anchor is a
distinct id (of several rows the least label, then the least vector); rows with
its id are not its candidates, and every other row is a candidate of its own, so
repeated rows are positives or negatives each.  Scores beyond 64 bits saturate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster.llm.topk import _matrix, finite
from muster.sources.scratch import cut

LEVELS = 4
BITS = 6  # of a query's component
BLOCK = 2048  # anchors that are compared at a time
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90  # per cent of the positive's score
_SEED = 20240607
_CHUNK = 1 << 19  # estimates held at a time in a task
_SLACK = 1e-9  # of |v| |q|, for floating point
_EXACT = float(1 << 53)


# Codes


def _signs(width: int, level: int) -> np.ndarray:
    return np.random.default_rng((_SEED, level, width)).integers(0, 2, (2, width)) * 2.0 - 1.0


def rotated(rows: np.ndarray, level: int) -> np.ndarray:
    """Rows of a power of two of components, turned by the map of a level."""
    n, width = rows.shape
    for sign in _signs(width, level):
        rows = rows * sign
        step = 1
        while step < width:
            pairs = rows.reshape(n, width // (2 * step), 2, step)
            rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
            step *= 2
        rows = rows / np.sqrt(width)
    return rows


def _bits(rows: np.ndarray) -> np.ndarray:
    """Booleans as 64-bit words."""
    return np.packbits(rows, axis=1, bitorder="little").view("<u8")


def padded_width(width: int) -> int:
    return max(64, 1 << max(0, width - 1).bit_length())


def _padded(vectors: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    out[:, : vectors.shape[1]] = vectors
    return out


def coded(vectors: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes by level, alignments by level, lengths of the last residual)."""
    rest = _padded(vectors, width)
    codes = np.empty((len(vectors), LEVELS, width // 64), dtype="<u8")
    alignments = np.empty((len(vectors), LEVELS))
    for level in range(LEVELS):
        rest = rotated(rest, level)
        plus = rest > 0
        codes[:, level] = _bits(plus)
        sign = np.where(plus, 1.0, -1.0)
        alignments[:, level] = (rest * sign).mean(axis=1)
        rest = rest - alignments[:, level : level + 1] * sign
    return codes, alignments, np.sqrt((rest * rest).sum(axis=1))


class Queries:
    """Vectors ready to be compared with codes: bit planes, steps and error bounds."""

    def __init__(self, vectors: np.ndarray, width: int):
        self.lengths = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))
        rest = _padded(vectors, width)
        self.planes, self.steps, self.lows, self.sums = [], [], [], []
        errors = np.zeros((len(vectors), LEVELS))
        most = (1 << BITS) - 1
        for level in range(LEVELS):
            rest = rotated(rest, level)
            low = rest.min(axis=1, keepdims=True)
            step = np.maximum((rest.max(axis=1, keepdims=True) - low) / most, 1e-300)
            whole = np.clip(np.rint((rest - low) / step), 0, most)
            errors[:, level] = np.sqrt(((rest - low - step * whole) ** 2).sum(axis=1))
            whole = whole.astype(np.uint32)
            planes = [_bits((whole >> bit & 1).astype(bool)) for bit in range(BITS)]
            self.planes.append(np.stack(planes, axis=1))
            self.steps.append(step[:, 0])
            self.lows.append(low[:, 0])
            self.sums.append(whole.sum(axis=1).astype(float))
        self.errors = errors
        self.width = width

    def intervals(
        self, codes: np.ndarray, alignments: np.ndarray, residuals: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the inner products of all queries with the coded rows."""
        estimate = np.zeros((len(self.lengths), len(codes)))
        doubt = self.lengths[:, None] * residuals[None, :]
        lengths = np.sqrt(self.width * (alignments**2).sum(axis=1) + residuals**2)
        for level in range(LEVELS):
            code = codes[:, level]
            common = np.zeros(estimate.shape)  # sum of the rounded components under the code's ones
            for bit in range(BITS):
                plane = self.planes[level][:, bit]
                found = np.zeros(estimate.shape, dtype=np.int64)
                for word in range(code.shape[1]):
                    found += np.bitwise_count(plane[:, None, word] & code[None, :, word])
                common += found * float(1 << bit)
            ones = np.bitwise_count(code).sum(axis=1).astype(float)
            # <c, q> with c = +1 under the ones and -1 elsewhere, q = low + step * whole.
            product = self.steps[level][:, None] * (2 * common - self.sums[level][:, None])
            product += self.lows[level][:, None] * (2 * ones - self.width)[None, :]
            estimate += alignments[None, :, level] * product
            doubt += self.errors[:, level][:, None] * (np.sqrt(self.width) * alignments[:, level])[None, :]
        doubt += _SLACK * self.lengths[:, None] * lengths[None, :]
        # Scores saturate, so their bounds do.
        return tuple(np.clip(bound, -(2.0**63), 2.0**63) for bound in (estimate - doubt, estimate + doubt))


def code(rows: DataFrame, anchors: Column, id_col: str, vector_col: str, label_col: str, scale: float = 256.0) -> DataFrame:
    """(id, label, anchor, vector, codes, alignments, residual) of the rows that take part, written once."""
    vector = F.col(vector_col)
    taking_part = finite(vector) & F.col(id_col).isNotNull() & F.col(label_col).isNotNull()
    own = rows.where(taking_part).select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(label_col).cast("bigint").alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * scale)).alias("vector"),
    )
    width = padded_width(own.agg(F.max(F.size("vector")).alias("width")).first().width or 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _CHUNK // width):
                part = batch.slice(start, _CHUNK // width)
                codes, alignments, residuals = coded(_matrix(part.column("vector")).astype(float), width)
                lists = [
                    pa.ListArray.from_arrays(np.arange(len(part.column(0)) + 1, dtype=np.int32) * each, values)
                    for each, values in (
                        (LEVELS * width // 64, pa.array(codes.reshape(-1).view("<i8"))),
                        (LEVELS, pa.array(alignments.reshape(-1))),
                    )
                ]
                arrays = [*part.columns, *lists, pa.array(residuals)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = [*own.columns, "codes", "alignments", "residual"]
    schema = (
        "id BIGINT, label BIGINT, anchor BOOLEAN, vector ARRAY<BIGINT>,"
        " codes ARRAY<BIGINT>, alignments ARRAY<DOUBLE>, residual DOUBLE"
    )
    return cut(own.mapInArrow(run, schema))


# Scans


class _Best:
    """The k best (score, id) of each of n groups: the higher score, then the smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.group, self.score, self.id = (np.zeros(0, dtype=np.int64) for _ in range(3))
        self.least = np.full(n, -np.inf)  # the k-th best score, where there are k

    def add(self, group: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        if not len(group):
            return
        group, score, id_ = (
            np.concatenate(pair) for pair in ((self.group, group), (self.score, score), (self.id, id_))
        )
        order = np.lexsort((id_, -score, group))
        group, score, id_ = group[order], score[order], id_[order]
        first = np.flatnonzero(np.diff(group, prepend=-1))
        place = np.arange(len(group)) - np.repeat(first, np.diff(np.append(first, len(group))))
        kept = place < self.k
        self.group, self.score, self.id = group[kept], score[kept], id_[kept]
        last = place == self.k - 1
        # Rounded down, as a double may be more than the integer.
        self.least[group[last]] = np.nextafter(score[last].astype(float), -np.inf)


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th highest of each row, or minus infinity."""
    n = values.shape[1]
    if n < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, n - k, axis=1)[:, n - k]


def _pair_scores(queries: np.ndarray, rows: np.ndarray, query: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Exact inner products of pairs, as 64-bit integers."""
    if not len(query):
        return np.zeros(0, dtype=np.int64)
    most = [float(np.abs(m.astype(float)).max(initial=0)) for m in (queries, rows)]
    whole = most[0] * most[1] * queries.shape[1] < _EXACT
    limits = np.iinfo(np.int64)
    scores = np.empty(len(query), dtype=np.int64)
    step = max(1, _CHUNK // max(1, queries.shape[1]))
    for start in range(0, len(query), step):
        a, b = queries[query[start : start + step]], rows[row[start : start + step]]
        if whole:
            scores[start : start + step] = np.einsum("ij,ij->i", a, b)
        else:
            exact = (a.astype(object) * b.astype(object)).sum(axis=1)
            scores[start : start + step] = [min(max(int(x), limits.min + 1), limits.max) for x in exact]
    return scores


class _Block:
    """Anchors, by id."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, width: int):
        order = np.argsort(ids)
        self.ids, self.labels, self.vectors, self.width = ids[order], labels[order], vectors[order], width
        self.queries = Queries(self.vectors, width)
        # Of each anchor's positives, best first: how many, ids, scores; and the bounds of negatives.
        self.found = np.zeros(len(ids), dtype=np.int64)

    def give_positives(self, rows: list, most: int, low: int, high: int) -> None:
        shape = (len(self.ids), most)
        self.positive, self.score = np.zeros(shape, dtype=np.int64), np.zeros(shape, dtype=np.int64)
        self.low, self.high = np.zeros(shape, dtype=np.int64), np.full(shape, -1, dtype=np.int64)
        limits = np.iinfo(np.int64)
        for row in rows:
            at, place = int(np.searchsorted(self.ids, row.anchor_id)), row.place - 1
            score = int(row.score)
            self.positive[at, place], self.score[at, place] = row.id, score
            self.found[at] = max(self.found[at], row.place)
            # The whole numbers n with low * score <= 100 * n <= high * score.
            self.low[at, place] = max(limits.min, -(-low * score // 100))
            self.high[at, place] = min(limits.max, high * score // 100)

    def chunks(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(ids, vectors, same label, other id, least, most) for chunks of coded rows."""
        step = max(1, _CHUNK // max(1, len(self.ids)))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                n = part.num_rows
                ids = part.column("id").to_numpy()
                codes = _matrix(part.column("codes"), LEVELS * self.width // 64).view("<u8")
                alignments = part.column("alignments").flatten().to_numpy().reshape(n, LEVELS)
                least, most = self.queries.intervals(
                    codes.reshape(n, LEVELS, -1), alignments, part.column("residual").to_numpy()
                )
                same = self.labels[:, None] == part.column("label").to_numpy()[None, :]
                other = self.ids[:, None] != ids[None, :]
                yield ids, _matrix(part.column("vector"), self.vectors.shape[1]), same, other, least, most


def _positives(coded_rows: DataFrame, block, k: int) -> DataFrame:
    """(anchor_id, id, score, place): the k best rows of the anchor's label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = block.value
        best = _Best(len(own.ids), k)
        for ids, vectors, same, other, least, most in own.chunks(batches):
            open_ = same & other
            bound = np.maximum(best.least, _kth(np.where(open_, least, -np.inf), k))
            anchor, row = np.nonzero(open_ & (most >= bound[:, None]))
            best.add(anchor, _pair_scores(own.vectors, vectors, anchor, row), ids[row])
        columns = (own.ids[best.group], best.id, best.score)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor_id", "id", "score"])

    found = coded_rows.mapInArrow(run, "anchor_id BIGINT, id BIGINT, score BIGINT")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _negatives(coded_rows: DataFrame, block, k: int) -> DataFrame:
    """The k best rows of other labels within each positive's bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = block.value
        places = own.positive.shape[1]
        best = [_Best(len(own.ids), k) for _ in range(places)]
        for ids, vectors, same, other, least, most in own.chunks(batches):
            open_ = ~same & other
            wanted = np.zeros(open_.shape, dtype=bool)
            for place in range(places):
                asked = open_ & (own.found > place)[:, None]
                low, high = own.low[:, place, None].astype(float), own.high[:, place, None].astype(float)
                # One step of a double inwards for what is surely within, outwards for what may be.
                within = asked & (least >= np.nextafter(low, np.inf)) & (most <= np.nextafter(high, -np.inf))
                bound = np.maximum(best[place].least, _kth(np.where(within, least, -np.inf), k))
                reach = (most >= np.nextafter(low, -np.inf)) & (least <= np.nextafter(high, np.inf))
                wanted |= asked & reach & (most >= bound[:, None])
            anchor, row = np.nonzero(wanted)
            scores = _pair_scores(own.vectors, vectors, anchor, row)
            for place in range(places):
                fits = (own.found[anchor] > place) & (scores >= own.low[anchor, place]) & (scores <= own.high[anchor, place])
                best[place].add(anchor[fits], scores[fits], ids[row[fits]])
        for place, found in enumerate(best):
            at = found.group
            columns = (own.ids[at], own.positive[at, place], np.full(len(at), place + 1), found.id, own.score[at, place], found.score)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    names = ["anchor_id", "positive_id", "positive_rank", "negative_id", "positive_score", "negative_score"]
    found = coded_rows.mapInArrow(run, ", ".join(f"{name} BIGINT" for name in names))
    order = Window.partitionBy("anchor_id", "positive_rank").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score",
        F.col("positive_rank").cast("int").alias("positive_rank"),
    )


def mine(
    rows: DataFrame,
    anchors: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    block: int = BLOCK,
) -> DataFrame:
    """Hard negatives of the rows that the condition ``anchors`` names.

    One row per anchor, positive and negative: anchor_id, positive_id, rank (from 1, of
    this positive's negatives), negative_id, positive_score, negative_score and the
    positive's own rank.  A negative's score lies between ``low`` and ``high`` per cent
    of the positive's.
    """
    spark = rows.sparkSession
    coded_rows = code(rows, anchors, id_col, vector_col, label_col)
    first = F.min(F.struct("label", "vector")).alias("row")
    asked = cut(coded_rows.where("anchor").groupBy("id").agg(first).select("id", "row.*"))
    blocks = max(1, -(-asked.count() // block))
    width = padded_width(coded_rows.agg(F.max(F.size("vector")).alias("width")).first().width or 0)
    found = []
    for number in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == number).toArrow().combine_chunks()
        if not own.num_rows:
            continue
        arrays = [own.column(name).chunk(0) for name in ("id", "label", "vector")]
        compared = _Block(arrays[0].to_numpy(), arrays[1].to_numpy(), _matrix(arrays[2]), width)
        shared = spark.sparkContext.broadcast(compared)
        best = _positives(coded_rows, shared, positives).collect()  # of one block
        shared.destroy()
        compared.give_positives(best, positives, low, high)
        shared = spark.sparkContext.broadcast(compared)
        found.append(cut(_negatives(coded_rows, shared, negatives)))
        shared.destroy()
    if not found:
        return spark.createDataFrame(
            [],
            "anchor_id BIGINT, positive_id BIGINT, rank INT, negative_id BIGINT,"
            " positive_score BIGINT, negative_score BIGINT, positive_rank INT",
        )
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every
