"""Resampling documents towards a target distribution, by hashed n-gram features.

A text's features are its runs of one to three words; a feature's bucket is the
CRC-32 of its bytes modulo ``BUCKETS``.  Counts of buckets over all documents and
over all target texts give each bucket's log-ratio; a document's weight is the
sum over its features, and the highest weights plus Gumbel noise are drawn
without replacement.

CRC-32 is linear over XOR: of a span of n bytes it is a constant of n, XORed with
one contribution for every byte, which depends on the byte and on its distance
from the span's end only.  So the contributions of all bytes of all features of a
stretch of words are looked up in one table of distances by bytes, and
``bitwise_xor.reduceat`` over the features' spans gives their checksums.  Spans
longer than the table are cut into blocks of its length from their end on; a
block's register is the one before, moved on by a block through the same table,
XORed with the block's contributions.

Words are found on the UTF-8 bytes of whole Arrow batches.  A task holds a batch
and, for ``STRETCH`` bytes of words at a time, their contributions; a long text is
cut between words, the last two words before a cut being read again.  So memory
is bounded by the batch and by its longest run of three words.

What is gathered: a row for each bucket and table, whatever the corpus.  Weights
are written to the shared folder, and ranks come from range partitioning.

A null or empty text has no features and weight 0.  Rows that repeat an id are
documents of their own; equal scores and ids are ordered by weight.  A row
without id has no score, and it isn't drawn and doesn't count among those that
are drawn from.  Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.llm.frames import id_and_text
from muster.operators.position import with_position
from muster.sources.scratch import cut

BUCKETS = 10_000
LONGEST = 3  # words of a feature
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
DISTANCES = 256  # of the table, and bytes of a block
STRETCH = 1 << 18
SLICE = 1 << 22  # bytes of texts whose words are found at a time

_POLYNOMIAL = 0xEDB88320


# Checksums


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Contributions by distance from the end and byte; registers after n zero bytes."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, step >> 1 ^ _POLYNOMIAL, step >> 1).astype(np.uint32)
    contributions = np.empty((DISTANCES, 256), dtype=np.uint32)
    contributions[0] = step
    start = np.empty(DISTANCES + 1, dtype=np.uint32)
    start[0] = 0xFFFFFFFF
    for n in range(1, DISTANCES):
        before = contributions[n - 1]
        contributions[n] = before >> 8 ^ step[before & 255]
    for n in range(1, DISTANCES + 1):
        start[n] = start[n - 1] >> 8 ^ step[start[n - 1] & 255]
    return contributions, start


def _sums(letters: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """XOR of the contributions of each span, none empty nor longer than the table."""
    contributions, _ = _tables()
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    at = np.arange(int(sizes.sum()), dtype=np.int32)
    at += np.repeat((starts - first).astype(np.int32), sizes)
    distance = np.repeat((ends - 1).astype(np.int32), sizes)
    distance -= at
    distance <<= 8
    distance |= letters[at]
    return np.bitwise_xor.reduceat(contributions.ravel()[distance], first)


def _moved_on(register: np.ndarray) -> np.ndarray:
    """Registers after a further block of zero bytes, which is as long as the table."""
    contributions, _ = _tables()
    moved = contributions[DISTANCES - 1][register & 255]
    for n in range(1, 4):
        moved = moved ^ contributions[DISTANCES - 1 - n][register >> 8 * n & 255]
    return moved


def checksums(letters: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of the spans [start, end) of an array of bytes, none of them empty."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint32)
    _, start = _tables()
    sizes = ends - starts
    head = (sizes - 1) % DISTANCES + 1  # what is before the whole blocks
    register = start[head] ^ _sums(letters, starts, starts + head)
    blocks = (sizes - head) // DISTANCES
    at = starts + head
    open_ = np.flatnonzero(blocks)
    while len(open_):
        # A bounded number of blocks of each, so that a very long span is not laid out whole.
        own = at[open_]
        register[open_] = _moved_on(register[open_]) ^ _sums(letters, own, own + DISTANCES)
        at[open_] += DISTANCES
        blocks[open_] -= 1
        open_ = open_[blocks[open_] > 0]
    return ~register


# Words and features


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Each byte as it counts in words, A-Z as a-z; 0 for those that part words."""
    table = np.zeros(256, dtype=np.uint8)
    table[0x80:] = np.arange(0x80, 256)
    for first, last in ("09", "az"):
        table[ord(first) : ord(last) + 1] = np.arange(ord(first), ord(last) + 1)
    table[ord("A") : ord("Z") + 1] = table[ord("a") : ord("z") + 1]
    return table


def _slices(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """(letters, offsets of the texts, first text, words before) of bounded slices of texts.

    Of a text that goes on from the slice before, the last ``LONGEST`` - 1 words
    are there again: ``words before``.
    """
    text, n = 0, len(offsets) - 1
    while text < n:
        last = max(text + 1, int(np.searchsorted(offsets, offsets[text] + SLICE, side="right")) - 1)
        first, end = int(offsets[text]), int(offsets[last])
        if end - first <= SLICE:
            yield _letters()[data[first:end]], offsets[text : last + 1] - first, text, 0
        else:
            for part, before in _parts(data, first, end):
                yield part, np.array([0, len(part)]), text, before
        text = last


def _parts(data: np.ndarray, first: int, end: int) -> Iterator[tuple[np.ndarray, int]]:
    """Parts of a long text, cut between words."""
    again = np.zeros(0, dtype=np.uint8)
    before = 0
    while first < end:
        stop = min(end, first + SLICE)
        own = _letters()[data[first:stop]]
        # To the end of the word that the cut would part.
        while stop < end and own[-1]:
            more = _letters()[data[stop : min(end, stop + SLICE)]]
            gap = np.flatnonzero(more == 0)
            more = more[: gap[0] + 1] if len(gap) else more
            own, stop = np.concatenate([own, more]), stop + len(more)
        part = np.concatenate([again, own])
        yield part, before
        starts = np.flatnonzero((part != 0) & (np.append(0, part[:-1]) == 0))
        before = min(LONGEST - 1, len(starts))
        again = part[starts[-before] :] if before else np.zeros(0, dtype=np.uint8)
        first = stop


def features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of each feature of texts in large binary form, some at a time."""
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    for letters, bounds, first, before in _slices(data, offsets):
        inside = letters != 0
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edges = bounds[:-1][bounds[:-1] < len(letters)]
        begins[edges] = inside[edges]  # a text begins a word anew
        starts = np.flatnonzero(begins)
        if not len(starts):
            continue
        text_of = np.searchsorted(bounds, starts, side="right") - 1
        spread = np.cumsum(inside, dtype=np.int64)
        # The words of all texts, each followed by one space.
        ends = np.append(spread[starts[1:] - 1], spread[-1]) + np.arange(len(starts))
        begins_at = np.append(0, ends[:-1] + 1)
        joined = np.full(int(ends[-1]) + 1, 0x20, dtype=np.uint8)
        kept = np.flatnonzero(inside)
        joined[np.arange(len(kept)) + np.repeat(np.arange(len(starts)), ends - begins_at)] = letters[kept]
        counted = np.ones(len(starts), dtype=bool)
        counted[:before] = False
        for low, high in _stretches(begins_at, ends):
            for n in range(1, LONGEST + 1):
                # Features end with one of the stretch's words.
                last = np.arange(max(low, n - 1), high)
                last = last[counted[last] & (text_of[last] == text_of[last - (n - 1)])]
                found = checksums(joined, begins_at[last - (n - 1)], ends[last])
                yield first + text_of[last], found % BUCKETS


def _stretches(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    low = 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(ends, starts[low] + STRETCH, side="right")))
        yield low, high
        low = high


# On Spark


def _large(batch: pa.RecordBatch) -> pa.Array:
    return batch.column("text").cast(pa.large_binary()).fill_null(b"")


def bucket_counts(texts: DataFrame, id_col: str, text_col: str) -> np.ndarray:
    """How many features each bucket has over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for _, buckets in features(_large(batch)):
                counts += np.bincount(buckets, minlength=BUCKETS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["bucket", "n"])

    counted = id_and_text(texts, id_col, text_col).mapInArrow(run, "bucket BIGINT, n BIGINT")
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``BUCKETS`` rows
        counts[row.bucket] = row.n
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((t+1)(S+B) / ((s+1)(T+B)))) of each bucket."""
    ratio = ((target + 1.0) * (source.sum() + float(BUCKETS))) / ((source + 1.0) * (target.sum() + float(BUCKETS)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_features, weight) of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, total = (np.zeros(batch.num_rows, dtype=np.int64) for _ in range(2))
            for text, buckets in features(_large(batch)):
                if len(text):
                    # Features come in the order of their texts.
                    edge = np.flatnonzero(np.diff(text, prepend=-1))
                    n[text[edge]] += np.diff(np.append(edge, len(text)))
                    total[text[edge]] += np.add.reduceat(shared.value[buckets], edge)
            arrays = [batch.column("doc_id"), pa.array(n), pa.array(total)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_features", "weight"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id BIGINT, n_features BIGINT, weight BIGINT")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from a hash of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_id_col: str = "item_id",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; rank is null for those not drawn.

    Of the N documents with at least ``least_words`` words, the
    floor(percent * N / 100) highest scores are drawn.
    """
    gain = gains(bucket_counts(docs, id_col, text_col), bucket_counts(target, target_id_col, text_col))
    scored = cut(
        weights(docs, gain, id_col, text_col).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    )
    # A text of n words has n + (n - 1) + ... features.
    least = sum(max(0, least_words - n) for n in range(LONGEST))
    may_be_drawn = F.col("doc_id").isNotNull() & (F.col("n_features") >= least)
    order = [F.desc("score"), F.asc("doc_id"), F.desc("weight"), F.desc("n_features")]
    ordered = with_position(scored.where(may_be_drawn), order)
    n = scored.where(may_be_drawn).count()
    rank = F.when(F.col("position") < percent * n // 100, F.col("position") + 1)
    rest = scored.where(~may_be_drawn).withColumn("rank", F.lit(None).cast("bigint"))
    return ordered.withColumn("rank", rank.cast("bigint")).drop("position").unionByName(rest)
