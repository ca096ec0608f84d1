"""Byte-level BPE by recursive queries in DuckDB.

Spark deals out the documents; each task has an in-memory DuckDB with the merge
table (every pair of tokens whose concatenation is a token, with its rank).
One row per token and position of each new word goes in; a recursive query
joins neighbours with the merge table and contracts each word's minimum-rank
pair, leftmost first, until no pair is left.  Where a word has several
occurrences of that pair, those that do not overlap are contracted in one step:
a contraction makes a token of that rank, whose pairs all rank higher, so the
order is the same.  Ids go back to bytes by an ordered aggregation over a join
with the vocabulary.

A task encodes each distinct word once and remembers a bounded number of words.
Nothing is shuffled.  A null text counts as empty, and an empty text has no
ids.  Repeated rows and null ids each give their own row; columns other than id
and text are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from muster.llm.frames import id_and_text, utf8
from muster.llm.pretokens import CACHED, Memory, words_of

RANKS = "byte_bpe_50k.tiktoken"
_BYTES_PER_QUERY = 1 << 19

_ENCODE = """
WITH RECURSIVE steps(word, place, token) USING KEY (word, place) AS (
    SELECT word, place, token FROM given
  UNION ALL (
    WITH pairs AS (
        SELECT word, place, token,
               lead(token) OVER places AS right_token, lead(place) OVER places AS right_place
        FROM recurring.steps
        WHERE token >= 0 AND word IN (SELECT word FROM steps)
        WINDOW places AS (PARTITION BY word ORDER BY place)
    ), ranked AS (
        SELECT word, place, right_place, merged
        FROM pairs JOIN merges ON pair = (token::BIGINT << 32) | right_token
    ), contracted AS ({contracted})
    SELECT word, place, merged FROM contracted
    UNION ALL
    SELECT word, right_place, -1 FROM contracted
  )
)
SELECT word, token FROM steps WHERE token >= 0 ORDER BY word, place
"""

# The leftmost minimum-rank pair of each word.
_ONE = """
    SELECT word, best.place AS place, best.right_place AS right_place, best.merged AS merged FROM (
        SELECT word, min({'merged': merged, 'place': place, 'right_place': right_place}) AS best
        FROM ranked GROUP BY word
    )"""

# For long words, all occurrences of that pair that do not overlap, from the left.
_ALL = """
    SELECT word, place, right_place, merged
    FROM (  -- a run: occurrences of which each overlaps the next
        SELECT *, sum(apart) OVER (PARTITION BY word ORDER BY place) AS run
        FROM (
            SELECT *, (coalesce(lag(right_place) OVER (PARTITION BY word ORDER BY place), -1) <> place)::INT AS apart
            FROM ranked QUALIFY merged = min(merged) OVER (PARTITION BY word)
        )
    )
    QUALIFY row_number() OVER (PARTITION BY word, run ORDER BY place) % 2 = 1"""
_LONG = 64

_DECODE = """
SELECT string_agg(spelt, '' ORDER BY place) AS spelt
FROM given JOIN vocabulary USING (token)
GROUP BY word ORDER BY word
"""


class Codec:
    """Words to ids (little-endian unsigned 32-bit) and back, for one rank file."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.ranks = ranks
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        pairs = [
            (ranks[token[:i]] << 32 | ranks[token[i:]], rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        merges = pa.table([pa.array(c, t) for c, t in zip(zip(*pairs), (pa.int64(), pa.int32()))], ["pair", "merged"])
        vocabulary = pa.table(
            {"token": pa.array(ranks.values(), pa.int32()), "spelt": [t.hex() for t in ranks]}
        )
        self.db = duckdb.connect()
        for setting in ("threads = 1", "memory_limit = '600MB'", "temp_directory = ''"):
            self.db.execute(f"SET {setting}")
        for name, table in (("merges", merges), ("vocabulary", vocabulary)):
            self.db.register("source", table)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM source")
            self.db.unregister("source")
        self.words = Memory(self._code_words, CACHED * 7 // 10)

    def _ask(self, sql: str, words: np.ndarray, places: np.ndarray, tokens: np.ndarray) -> pa.Table:
        given = pa.table({"word": words, "place": places, "token": tokens})
        self.db.register("given", given)
        try:
            return self.db.sql(sql).to_arrow_table()
        finally:
            self.db.unregister("given")

    def _rows(self, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        starts = np.cumsum(sizes) - sizes
        number = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        place = np.arange(len(flat), dtype=np.int32) - np.repeat(starts, sizes).astype(np.int32)
        return number, place, flat

    def merge(self, words: list[bytes]) -> Iterator[bytes]:
        """Ids of words, none of them empty."""
        for part in _parts(words):
            flat = np.frombuffer(b"".join(part), dtype=np.uint8)
            sizes = np.array([len(w) for w in part])
            contracted = _ALL if sizes.max() > _LONG else _ONE
            sql = _ENCODE.replace("{contracted}", contracted)
            table = self._ask(sql, *self._rows(self.of_byte[flat], sizes))
            ids = table.column("token").to_numpy().astype("<u4").tobytes()
            counts = np.bincount(table.column("word").to_numpy(), minlength=len(part))
            ends = (4 * np.cumsum(counts)).tolist()
            for start, end in zip([0, *ends], ends):
                yield ids[start:end]

    def spell(self, runs: list[bytes]) -> Iterator[bytes]:
        """Bytes of runs of ids, none of them empty."""
        for part in _parts(runs):
            sizes = np.array([len(r) // 4 for r in part])
            flat = np.frombuffer(b"".join(part), dtype="<u4").astype(np.int32)
            table = self._ask(_DECODE, *self._rows(flat, sizes))
            if len(table) != len(part):
                raise ValueError("an id is not in the vocabulary")
            yield from map(bytes.fromhex, table.column("spelt").to_pylist())

    def _code_words(self, words: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """Ids of each word, and the bytes decoded from them."""
        spelt = [w.encode() for w in words]
        open_ = sorted((w for w in spelt if w not in self.ranks), key=len)
        merged = dict(zip(open_, self.merge(open_), strict=True))
        ids = [merged[w] if w in merged else self.ranks[w].to_bytes(4, "little") for w in spelt]
        return zip(ids, self.spell(ids), strict=True)

    def code(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """Each text's ids, and the bytes decoded from them."""
        for coded in self.words.values([words_of(t) for t in texts]):
            yield tuple(map(b"".join, zip(*coded))) if coded else (b"", b"")


def _parts(items: list[bytes]) -> Iterator[list[bytes]]:
    """Items in lists of a bounded size in bytes, or single items beyond it."""
    part, size = [], 0
    for item in items:
        if part and size + len(item) > _BYTES_PER_QUERY:
            yield part
            part, size = [], 0
        part.append(item)
        size += len(item)
    if part:
        yield part


@lru_cache(maxsize=1)
def codec(path: str) -> Codec:
    """One per Python worker, so that its memory outlives a task."""
    return Codec(path)


def _few(values: list, size, most: int = 1 << 22) -> Iterator[list]:
    part, total = [], 0
    for value in values:
        part.append(value)
        total += size(value)
        if total >= most:
            yield part
            part, total = [], 0
    if part:
        yield part


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None) -> DataFrame:
    """(doc_id, ids) for each document; a null text is empty and has no ids."""
    path = ranks or public_tokenizers.path(RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.decode() for t in utf8(batch.column("text"))]
            ids = [
                np.frombuffer(coded, dtype="<u4").astype(np.int32)
                for part in _few(texts, len)
                for coded, _ in codec(path).code(part)
            ]
            arrays = [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "ids"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id BIGINT, ids ARRAY<INT>")


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", ranks: str | None = None) -> DataFrame:
    """(doc_id, bytes) from ids; null ids are empty.  An id outside the vocabulary is an error."""
    path = ranks or public_tokenizers.path(RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.array(r.as_py() or [], dtype="<u4").tobytes() for r in batch.column("ids")]
            spelt = codec(path).spell([r for r in rows if r])
            texts = [next(spelt) if r else b"" for r in rows]
            arrays = [batch.column("doc_id"), pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "bytes"])

    chosen = encoded.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS doc_id", f"`{ids_col}` AS ids")
    return chosen.mapInArrow(run, "doc_id BIGINT, bytes BINARY")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None) -> DataFrame:
    """Digests of each document's ids and of the bytes decoded from them.

    The same as ``encode`` then ``decode``, without moving ids between tasks'
    Python and Spark.
    """
    path = ranks or public_tokenizers.path(RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.decode() for t in utf8(batch.column("text"))]
            rows = []
            for part in _few(texts, len):
                for ids, decoded in codec(path).code(part):
                    rows.append(
                        (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest())
                    )
            columns = list(zip(*rows)) if rows else [[]] * 3
            types = (pa.int64(), pa.string(), pa.string())
            arrays = [batch.column("doc_id"), *(pa.array(list(c), t) for c, t in zip(columns, types))]
            yield pa.RecordBatch.from_arrays(
                arrays, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            )

    schema = "doc_id BIGINT, n_tokens BIGINT, ids_sha256 STRING, decoded_sha256 STRING"
    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)
