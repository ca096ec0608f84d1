"""Best-fit packing of whole documents by linear grouping.

Only documents longer than a sequence are cut, into whole sequences behind a
first piece that takes the remainder.  Everything is planned on a histogram of
piece lengths, which has at most as many rows as a sequence has places, so the
plan is one for all documents, however many there are:

* Linear grouping: pieces longer than a ``SMALL``-th of a sequence are ordered
  by length and divided into ``GROUPS`` groups of as many pieces each, and every
  length is rounded up to the longest of its group.
* Few-size configurations: a linear programme over the multisets of the rounded
  lengths that fit a sequence, by column generation, says how often to use each;
  counts are rounded down.
* Substitution: the places of a group are taken by its actual documents, the
  longest first.  What each is shorter than its group stays free.
* Best fit: what is left, then the small pieces, go longest first to the
  sequence with the least room that holds them, or to a new one.

A plan is a list of runs: so many pieces of a length, in the order of their
numbers, go to so many sequences from a first one on, at one offset.  Both its
size and the work on the driver depend on the length of a sequence alone.

On Spark, tasks tokenise documents and number the pieces of each length among
their own; these narrow rows are written to the shared folder.  Tasks' counts by
length, summed up over the tasks before, make the numbers global, and a binary
search in the broadcast runs finds each piece's place.

A null text counts as empty, and an empty text is the closing id alone.
Repeated rows and null ids are documents of their own; columns other than id
and text are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from muster.llm.frames import id_and_text, utf8
from muster.llm.packing import TOKENIZER, WINDOW, tokens
from muster.sources.scratch import cut

END_ID = 0
GROUPS = 64
SMALL = 8
CLOSE = 1e-4  # by so much the linear programme may miss its optimum
MEMORY_BYTES = 128 << 20  # of stretches in a generation; no other stage shares these Python workers
_NUMBER_BITS = 44  # of a piece among those of its length

# (length, number of the first piece, pieces, first sequence, offset)
Run = tuple[int, int, int, int, int]


# Planning


def grouped(histogram: dict[int, int], groups: int = GROUPS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Groups of as many pieces each, longest first: (rounded length, its (length, first number, pieces))."""
    left, total = [], sum(histogram.values())
    lengths = sorted(histogram, reverse=True)
    if len(lengths) <= groups:
        return [(length, [(length, 0, histogram[length])]) for length in lengths]
    ends = [total * (g + 1) // groups for g in range(groups)]
    seen, held = 0, []
    for length in lengths:
        first, n = 0, histogram[length]
        while n:
            part = min(n, ends[len(left)] - seen)
            if part:
                held.append((length, first, part))
            first, n, seen = first + part, n - part, seen + part
            if seen == ends[len(left)]:
                if held:
                    left.append((held[0][0], held))
                else:
                    ends.pop(len(left))
                held = []
    return left


class _Knapsack:
    """The configuration of the greatest worth, piece by piece."""

    def __init__(self, sizes: np.ndarray, room: int):
        self.sizes, self.room = sizes, room
        self.before = np.arange(room + 1)[None, :] - sizes[:, None]  # the room used before a piece
        self.before[self.before < 0] = room + 1

    def best(self, worth: np.ndarray) -> np.ndarray:
        """How many of each size."""
        best, chosen = np.append(np.zeros(self.room + 1), -np.inf), []
        for _ in range(self.room // int(self.sizes.min())):
            gains = best[self.before] + worth[:, None]
            top = gains.argmax(axis=0)
            most = gains[top, np.arange(self.room + 1)]
            better = most > best[:-1] + 1e-12
            chosen.append(np.where(better, top, -1))
            best[:-1] = np.where(better, most, best[:-1])
        counts, used = np.zeros(len(self.sizes)), self.room
        for took in reversed(chosen):
            if took[used] >= 0:
                counts[took[used]] += 1
                used -= int(self.sizes[took[used]])
        return counts


def configurations(sizes: list[int], wanted: list[int], room: int) -> list[tuple[np.ndarray, int]]:
    """Configurations and their repeats, rounded down, that solve

        least sum of x   where   sum over configurations of x * count = wanted,  x >= 0.

    The simplex method on columns that a knapsack proposes: it has as many
    configurations as there are sizes.  Without convergence, what the last basis
    holds is as right, only longer.
    """
    size, need = np.array(sizes), np.array(wanted, dtype=float)
    scale = max(1.0, need.max())
    columns = np.diag(room // size).astype(float)  # a basis: sequences of one size each
    amounts = need / scale / np.diag(columns)
    knapsack = _Knapsack(size, room)
    for _ in range(10 * len(sizes)):
        worth = np.linalg.solve(columns.T, np.ones(len(sizes)))
        entering = knapsack.best(worth)
        if worth @ entering <= 1 + CLOSE:
            break
        direction = np.linalg.solve(columns, entering)
        ratios = np.where(direction > 1e-9, amounts / np.maximum(direction, 1e-9), np.inf)
        leaving = int(np.argmin(ratios))
        if not np.isfinite(ratios[leaving]):
            break
        columns[:, leaving] = entering
        amounts = np.maximum(np.linalg.solve(columns, need / scale), 0.0)
    found, left = [], np.array(wanted, dtype=np.int64)
    for column, amount in sorted(zip(columns.T, amounts), key=lambda pair: -pair[1]):
        counts = np.rint(column).astype(np.int64)
        used = counts > 0
        repeats = min(int(np.floor(amount * scale + 1e-6)), int((left[used] // counts[used]).min()))
        if repeats > 0:
            found.append((counts, repeats))
            left -= counts * repeats
    return found


class _Open:
    """Stretches of sequences by the room left in them."""

    def __init__(self, window: int):
        self.window = window
        self.by_room: list[tuple[int, int, int]] = []  # (room, first sequence, sequences)
        self.sequences = 0
        self.runs: list[Run] = []

    def put(self, length: int, first: int, pieces: int) -> None:
        """Pieces of one length, each to the sequence with the least room that holds it.

        A sequence that has just taken one is the fullest that can take the next,
        so it takes all it can before another one does.
        """
        while pieces:
            at = bisect_left(self.by_room, (length, -1, -1))
            if at < len(self.by_room):
                room, sequence, n = self.by_room.pop(at)
            else:
                room, sequence, n = self.window, self.sequences, max(1, -(-pieces // (self.window // length)))
                self.sequences += n
            each = room // length
            whole = min(n, pieces // each)
            part = pieces - whole * each if whole < n else 0  # to the sequence after the whole ones
            for k in range(each):
                if whole:
                    self.runs.append((length, first + k * whole, whole, sequence, self.window - room + k * length))
            first, pieces = first + whole * each, pieces - whole * each
            if whole:
                self.keep(room - each * length, sequence, whole)
            if part:
                for k in range(part):
                    self.runs.append((length, first + k, 1, sequence + whole, self.window - room + k * length))
                first, pieces = first + part, pieces - part
                self.keep(room - part * length, sequence + whole, 1)
            rest = n - whole - (1 if part else 0)
            self.keep(room, sequence + n - rest, rest)

    def keep(self, room: int, sequence: int, n: int) -> None:
        if room and n:
            insort(self.by_room, (room, sequence, n))


def plan(histogram: dict[int, int], window: int = WINDOW, groups: int = GROUPS) -> tuple[list[Run], int]:
    """The runs of a packing of all pieces, and its number of sequences.

    Where lengths are spread so evenly that rounding them wastes more than the
    configurations save, no piece counts as large.
    """
    plans = [_plan(histogram, window, groups), _plan(histogram, window, 0)]
    return min(plans, key=lambda found: found[1])


def _plan(histogram: dict[int, int], window: int, groups: int) -> tuple[list[Run], int]:
    open_ = _Open(window)
    if histogram.get(window):
        open_.put(window, 0, histogram[window])
    least = window // SMALL if groups else window
    large = {n: k for n, k in histogram.items() if least < n < window and k}
    left: list[tuple[int, int, int]] = []
    if large:
        of_group = grouped(large, groups)
        held = [list(reversed(own)) for _, own in of_group]  # the next to be taken is last
        wanted = [sum(n for _, _, n in own) for own in held]
        for counts, repeats in configurations([size for size, _ in of_group], wanted, window):
            places = [held[g] for g in np.flatnonzero(counts) for _ in range(counts[g])]
            _substitute(open_, places, repeats)
        left = [part for own in held for part in reversed(own)]
    small = [(n, 0, k) for n, k in histogram.items() if n <= least and n < window and k]
    for length, first, pieces in sorted(left + small, key=lambda part: (-part[0], part[1])):
        open_.put(length, first, pieces)
    return open_.runs, open_.sequences


def _substitute(open_: _Open, places: list[list], repeats: int) -> None:
    """Actual pieces in ``repeats`` sequences of one configuration.

    Every place draws its own consecutive pieces of its group, so that lengths
    change seldom along the sequences.
    """
    first_sequence = open_.sequences
    open_.sequences += repeats
    drawn: list[list[tuple[int, int, int]]] = []
    for held in places:
        own, needed = [], repeats
        while needed:
            length, first, n = held.pop()
            part = min(n, needed)
            own.append((length, first, part))
            if part < n:
                held.append((length, first + part, n - part))
            needed -= part
        drawn.append(own)
    edges = sorted({0, *(edge for own in drawn for edge in accumulate(n for _, _, n in own))})
    at = [0] * len(drawn)
    begun = [0] * len(drawn)
    for start, end in zip(edges, edges[1:]):
        offset = 0
        for place, own in enumerate(drawn):
            length, first, n = own[at[place]]
            skip = start - begun[place]
            open_.runs.append((length, first + skip, end - start, first_sequence + start, offset))
            offset += length
            if skip + end - start == n:
                begun[place], at[place] = end, at[place] + 1
        open_.keep(open_.window - offset, first_sequence + start, end - start)


# On Spark


def pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    window: int = WINDOW,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of tokenised documents, numbered among those of their length and task."""
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    end = np.array([END_ID], dtype="<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "number"]
    types = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
    schema = ", ".join(f"{n} {'INT' if n == 'piece' else 'BIGINT'}" for n in names)
    if with_ids:
        names, types, schema = [*names, "ids"], [*types, pa.list_(pa.int32())], f"{schema}, ids ARRAY<INT>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        numbers: dict[int, int] = {}

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        for batch in batches:
            rows, held = [], 0
            ids_of = tokens(path, MEMORY_BYTES).encode(text.decode() for text in utf8(batch.column("text")))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), ids_of, strict=True):
                own = memoryview(ids + end)
                size = len(own) // 4
                start, stop, piece = 0, size % window or window, 0
                while start < size:
                    part = own[4 * start : 4 * stop]
                    number = numbers[stop - start] = numbers.get(stop - start, -1) + 1
                    row = (doc_id, piece, start, stop - start, zlib.crc32(part), task, number)
                    rows.append((*row, np.frombuffer(part, dtype="<i4")) if with_ids else row)
                    start, stop, piece = stop, stop + window, piece + 1
                held += size
                if held >= 1 << 22:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)


def _numbered(rows: DataFrame) -> DataFrame:
    """``number`` among all pieces of a length, from the number among those of a task."""
    counts = cut(rows.groupBy("length", "task").agg(F.count("*").alias("n")))
    # A row for each length and task, so a length has as many as there are tasks.
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    joined = rows.join(before, ["length", "task"])
    return joined.withColumn("number", F.col("number") + F.col("before")).select(*rows.columns)


class _Places:
    """Runs in the order of their lengths and numbers."""

    def __init__(self, runs: list[Run]):
        table = np.array(sorted(runs), dtype=np.int64).reshape(len(runs), 5)
        self.keys = table[:, 0] << _NUMBER_BITS | table[:, 1]
        self.numbers, self.sequences, self.offsets = table[:, 1], table[:, 3], table[:, 4]

    def find(self, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, lengths << _NUMBER_BITS | numbers, side="right") - 1
        return self.sequences[at] + numbers - self.numbers[at], self.offsets[at]


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    window: int = WINDOW,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of tokenised documents and their places in sequences of at most ``window`` ids.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset and, if wanted, the ids.
    """
    spark = docs.sparkSession
    rows = cut(pieces(docs, id_col, text_col, tokenizer, window, with_ids))
    counted = rows.groupBy("length").agg(F.count("*").alias("n")).collect()  # at most ``window`` rows
    runs, _ = plan({row.length: row.n for row in counted}, window)
    places = spark.sparkContext.broadcast(_Places(runs))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = places.value.find(batch.column("length").to_numpy(), batch.column("number").to_numpy())
            for name, values in zip(("sequence_id", "offset"), found):
                batch = batch.append_column(name, pa.array(values, pa.int64()))
            yield batch.select(out)

    out = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    schema = ", ".join(f"{n} {'INT' if n == 'piece' else 'BIGINT'}" for n in out)
    if with_ids:
        out, schema = [*out, "ids"], f"{schema}, ids ARRAY<INT>"
    return _numbered(rows).mapInArrow(place, schema)
