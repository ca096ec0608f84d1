"""Packing token sequences into windows by non-negative least squares.

Each task cuts its documents into whole windows and a remainder, and plans the
remainders of a bounded block of tokens at a time:

* Remainders are counted in classes of ``CLASS`` tokens.  All multisets of up
  to three classes that fill a window are the columns of a matrix, and
  non-negative least squares finds how often each should repeat to use up the
  histogram.
* Counts are rounded down and remainders dealt to the combinations.
* What is left over is packed greedily: laid end to end, it first fills the
  gaps of the combined windows (remainders are shorter than their class) and
  then windows of its own, cut where a window ends.  If it cannot fill all
  gaps, combined windows are given up until it can.
* The last open window of a block is divided into lengths that are powers of
  two, so no window needs padding.

Blocks are independent: nothing is shuffled, and a task that is run again makes
the same windows.  A window's number holds its task's number.  A null text
counts as empty, and an empty text is the closing id alone.  Repeated rows and
null ids are documents of their own; columns other than id and text are not
read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from muster.llm.frames import id_and_text, utf8
from muster.llm.pretokens import spelt, stretch_of, stretches, words_of

TOKENIZER = "byte_bpe_50k.json"
WINDOW = 2048
END_ID = 1
CLASS = 32
BLOCK_TOKENS = 1 << 22
MEMORY_BYTES = 128 << 20  # of stretches: a Python worker keeps at most two generations of so much
MARKS = frozenset(",.;:!?")  # each after a letter begins a match of its own
_SEQUENCE_BITS = 40

# The letter that stands for each byte in a byte-level BPE: itself if it can be
# printed, else one of those from 256 on.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_HIDDEN = [b for b in range(256) if b not in _PRINTED]
_LETTERS = {b: chr(256 + i) for i, b in enumerate(_HIDDEN)}

# (document of the block, start, length, sequence of the block, offset)
Piece = tuple[int, int, int, int, int]


def nnls(matrix: np.ndarray, target: np.ndarray, close: float = 1e-8) -> np.ndarray:
    """min |matrix x - target| over x >= 0, by the active-set method of Lawson and Hanson
    on the normal equations; ends early where no residual exceeds ``close``."""
    n = matrix.shape[1]
    gram, aim = matrix.T @ matrix, matrix.T @ target
    gram[np.diag_indices(n)] += 1e-9  # columns may depend on each other
    x, free = np.zeros(n), np.zeros(n, dtype=bool)
    tolerance = 1e-8 * max(1.0, float(np.abs(aim).max(initial=0.0)))
    for _ in range(3 * n):
        if np.abs(matrix @ x - target).max(initial=0.0) <= close:
            break
        slope = aim - gram @ x
        slope[free] = -np.inf
        best = int(np.argmax(slope))
        if slope[best] <= tolerance:
            break
        free[best] = True
        while free.any():
            chosen = np.flatnonzero(free)
            trial = np.zeros(n)
            trial[chosen] = np.linalg.solve(gram[np.ix_(chosen, chosen)], aim[chosen])
            below = chosen[trial[chosen] <= 0]
            if not len(below):
                x = trial
                break
            step = np.min(x[below] / np.maximum(x[below] - trial[below], 1e-300))
            x += step * (trial - x)
            free[below[x[below] <= 1e-10]] = False
            x[~free] = 0.0
    return x


@lru_cache(maxsize=4)
def combinations(classes: int) -> tuple[tuple[int, ...], ...]:
    """Multisets of one to three classes (from 1) that sum to ``classes``."""
    two = [(a, classes - a) for a in range(1, classes // 2 + 1)]
    three = [
        (a, b, classes - a - b)
        for a in range(1, classes // 3 + 1)
        for b in range(a, (classes - a) // 2 + 1)
    ]
    return ((classes,), *two, *three)


def _combined(lengths: list[int], window: int) -> tuple[list[list[int]], list[int]]:
    """Numbers of the lengths in each combined window, and those left over."""
    classes = max(1, window // CLASS)
    width = -(-window // classes)
    waiting: list[list[int]] = [[] for _ in range(classes + 1)]
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        waiting[-(-lengths[i] // width)].append(i)
    counts = np.array([len(w) for w in waiting[1:]], dtype=float)
    shapes = [s for s in combinations(classes) if all(waiting[c] for c in s)]
    windows: list[list[int]] = []
    if shapes:
        matrix = np.zeros((classes, len(shapes)))
        for j, shape in enumerate(shapes):
            for c in shape:
                matrix[c - 1, j] += 1
        repeats = np.floor(nnls(matrix, counts, close=0.5) + 1e-6).astype(int)
        for j in np.argsort(-repeats, kind="stable"):
            shape = shapes[j]
            for _ in range(repeats[j]):
                if any(len(waiting[c]) < shape.count(c) for c in shape):
                    break
                windows.append([waiting[c].pop() for c in shape])
    return windows, [i for w in reversed(waiting) for i in w]


def plan(sizes: list[int], window: int = WINDOW) -> Iterator[Piece]:
    """Pieces of documents of the given sizes: all windows full but the last few,
    whose lengths are powers of two."""
    sequence = 0
    rest, owner = [], []
    for doc, size in enumerate(sizes):
        for start in range(0, size - window + 1, window):
            yield doc, start, window, sequence, 0
            sequence += 1
        if size % window:
            rest.append(size % window)
            owner.append(doc)
    windows, left = _combined(rest, window)
    gap = sum(window - sum(rest[i] for i in w) for w in windows)
    spare = sum(rest[i] for i in left)
    while windows and gap > spare:
        given_up = windows.pop()
        tokens = sum(rest[i] for i in given_up)
        gap, spare = gap - (window - tokens), spare + tokens
        left += given_up

    # Rooms to be filled in order: (sequence, offset, size)
    rooms = []
    for held in windows:
        offset = 0
        for i in held:
            yield owner[i], sizes[owner[i]] - rest[i], rest[i], sequence, offset
            offset += rest[i]
        if offset < window:
            rooms.append((sequence, offset, window - offset))
        sequence += 1
    spare -= gap
    ends = [window] * (spare // window) + [1 << b for b in range(window.bit_length(), -1, -1) if spare % window >> b & 1]
    rooms += [(sequence + k, 0, size) for k, size in enumerate(ends)]

    todo = iter(rooms)
    room, offset, space = next(todo, (0, 0, 0))
    for i in left:
        start, size = sizes[owner[i]] - rest[i], rest[i]
        while size:
            if not space:
                room, offset, space = next(todo)
            put = min(size, space)
            yield owner[i], start, put, room, offset
            start, size, offset, space = start + put, size - put, offset + put, space - put


class _Known(dict):
    """Ids of stretches; what is missing is found and kept."""

    def __init__(self, find):
        self.find = find
        self.held = 0  # bytes, about

    def __missing__(self, stretch: str) -> bytes:
        ids = self[stretch] = self.find(stretch)
        self.held += 200 + len(stretch) + len(ids)
        return ids


class Tokens:
    """Ids of texts (little-endian unsigned 32-bit) by the ``tokenizers`` library."""

    def __init__(self, path: str, memory: int = MEMORY_BYTES):
        self.memory = memory
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        self.model = whole.model  # knows no special tokens: "<|endoftext|>" is text
        self.spelt_ids = [i.to_bytes(4, "little") for i in range(whole.get_vocab_size())]
        self.young, self.old = _Known(self._find), {}

    def _word(self, word: str) -> bytes:
        if word.isascii() and word.isprintable():
            letters = word.replace(" ", _LETTERS[32])
        else:
            letters = word.encode().decode("latin-1").translate(_LETTERS)
        spelt_ids = self.spelt_ids
        return b"".join([spelt_ids[token.id] for token in self.model.tokenize(letters)])

    def _find(self, stretch: str) -> bytes:
        if stretch in self.old:
            return self.old[stretch]
        if stretch.isalpha():
            return self._word(" " + stretch)
        if stretch[-1:] in MARKS and stretch[:-1].isalpha():
            return self.young[stretch[:-1]] + self.young[stretch_of(stretch[-1])]
        words = words_of(spelt(stretch))
        return self._words(words) if len(words) != 1 else self._word(words[0])

    def _words(self, words: list[str]) -> bytes:
        return b"".join([self.young[stretch_of(word)] for word in words])

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for text in texts:
            if self.young.held > self.memory:
                self.young, self.old = _Known(self._find), self.young
            parts = stretches(text)
            if parts is None:
                yield self._words(words_of(text))
            else:
                yield b"".join(map(self.young.__getitem__, parts))


@lru_cache(maxsize=1)
def tokens(path: str, memory: int = MEMORY_BYTES) -> Tokens:
    """One per Python worker, so that its memory of words outlives a task."""
    return Tokens(path, memory)


def _blocks(documents: Iterable[tuple], most: int) -> Iterator[list[tuple]]:
    block, held = [], 0
    for document in documents:
        block.append(document)
        held += len(document[1]) // 4
        if held >= most:
            yield block
            block, held = [], 0
    if block:
        yield block


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    window: int = WINDOW,
    with_ids: bool = True,
    memory: int = MEMORY_BYTES,
) -> DataFrame:
    """Pieces of tokenised documents and their places in sequences of up to ``window`` ids.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset and, if wanted, the ids.  ``window`` is a power of two.
    ``memory`` bounds what a Python worker remembers of stretches; less of it is more time.
    """
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    end = np.array([END_ID], dtype="<u4").tobytes()

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            numbers = batch.column("doc_id").to_pylist()
            texts = list(utf8(batch.column("text")))
            for at in range(0, len(texts), 256):
                some = [t.decode() for t in texts[at : at + 256]]
                for number, ids in zip(numbers[at : at + 256], tokens(path, memory).encode(some), strict=True):
                    yield number, ids + end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << _SEQUENCE_BITS
        for block in _blocks(documents(batches), BLOCK_TOKENS):
            sizes = [len(ids) // 4 for _, ids in block]
            columns: list[list] = [[] for _ in names]
            last = -1
            for doc, start, length, sequence, offset in plan(sizes, window):
                number, ids = block[doc]
                own = memoryview(ids)[4 * start : 4 * (start + length)]
                row = [number, start, length, zlib.crc32(own), sizes[doc], base + sequence, offset]
                if with_ids:
                    row.append(np.frombuffer(own, dtype="<u4").astype(np.int32))
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
                last = max(last, sequence)
            base += last + 1
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    types = [pa.int64()] * 7
    schema = ", ".join(f"{n} BIGINT" for n in names)
    if with_ids:
        names, types, schema = [*names, "ids"], [*types, pa.list_(pa.int32())], f"{schema}, ids ARRAY<INT>"
    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)
