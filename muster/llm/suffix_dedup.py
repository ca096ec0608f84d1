"""Passages that repeat across documents, by hashes of anchored windows.

1. Equal texts are one class, carried by its smallest id; every other copy is a
   repeat as a whole.
2. A window is a run of ``MIN_WORDS`` words; its anchor is its minimiser, the
   first of least hash of its ``WINDOW`` runs of ``GRAM`` words.  Equal windows
   have the same anchor.  Only suffixes at anchors are retained.
3. Anchors whose ``GRAM`` words occur in one document only go no further: no
   window that they anchor is anywhere else.
4. Of the others, every window gives a row with a 64-bit hash of its words.  The
   least document of each hash is found by an aggregation, so that a passage in
   a third of all documents, or often in one, is combined before it moves; hashes
   of one document only are left out, and the rest is joined back.  A window that
   a smaller id holds is a repeat.  Where texts are shuffled to meet their anchors or
   spans, a filter of ``FILTER_BITS`` bits keeps those that have none where they are.
5. Overlapping repeats of a document are merged.  Their union is exact but for
   equal hashes of different windows.

The first occurrence of a passage is never marked, so cutting all marked spans
loses no content.  Words are what stands between ASCII white space, A-Z in lower
case.  Repeats within one document are not marked.  Texts that are null or
shorter than ``MIN_WORDS`` words have no spans, and so have rows without id;
rows equal in id and text are one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster.llm.frames import free_name, id_and_text, utf8
from muster.llm.shingles import sequence_hashes, word_hashes
from muster.sources.scratch import cut

MIN_WORDS = 50
GRAM = 10
WINDOW = MIN_WORDS - GRAM + 1
SMALL_BYTES = 1 << 20  # of a table that is broadcast; a larger one grows with the input, so it is shuffled
FILTER_BITS = 1 << 24  # of the hashes of keys; broadcast in words of 64
_TASK_ROWS = 1_000_000  # repeated windows sorted in one task


def minimisers(grams: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the least (of equal ones the first) of every ``window`` values."""
    if len(grams) < window:
        return np.zeros(0, dtype=np.int64)
    found = []
    for start in range(0, len(grams) - window + 1, 1 << 16):  # bounds the comparison's memory
        part = grams[start : start + (1 << 16) + window - 1]
        views = np.lib.stride_tricks.sliding_window_view(part, window)
        found.append(np.unique(start + np.arange(len(views)) + views.argmin(axis=1)))
    return np.unique(np.concatenate(found))


def _retained(texts: DataFrame) -> DataFrame:
    """(doc_id, print, n_words, at, keys) for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "print", "n_words", "at", "keys"]
        for batch in batches:
            counts, places, keys = [], [], []
            for text in utf8(batch.column("text")):
                words = word_hashes(text)
                grams = sequence_hashes(words, GRAM)
                at = minimisers(grams)
                counts.append(len(words))
                places.append(at.astype(np.int32))
                keys.append(grams[at].view(np.int64))
            arrays = [
                batch.column("doc_id"),
                batch.column("print"),
                pa.array(counts, pa.int32()),
                pa.array(places, pa.list_(pa.int32())),
                pa.array(keys, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return texts.mapInArrow(run, "doc_id BIGINT, print STRING, n_words INT, at ARRAY<INT>, keys ARRAY<BIGINT>")


def _starts(grams: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Starts of the windows whose minimiser is one of ``places``."""
    views = np.lib.stride_tricks.sliding_window_view(grams, WINDOW)
    near = np.zeros(len(views) + 1, dtype=np.int64)
    np.add.at(near, np.maximum(places - WINDOW + 1, 0), 1)
    np.add.at(near, np.minimum(places + 1, len(views)), -1)
    near = np.flatnonzero(np.cumsum(near[:-1]))
    found = []
    for start in range(0, len(near), 1 << 16):  # bounds the comparison's memory
        part = near[start : start + (1 << 16)]
        found.append(part[np.isin(part + views[part].argmin(axis=1), places)])
    return np.concatenate(found) if found else near


def _windows(texts: DataFrame) -> DataFrame:
    """(window, id, tag, start): hashes of all ``MIN_WORDS`` words anchored at the given places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["window", "id", "tag", "start"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32()]
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            held = 0
            columns = (batch.column(n).to_pylist() for n in ("doc_id", "tag", "places"))
            for text, number, tag, places in zip(utf8(batch.column("text")), *columns):
                words = word_hashes(text)
                starts = _starts(sequence_hashes(words, GRAM), np.array(places, dtype=np.int64))
                n = len(starts)
                hashes = sequence_hashes(words, MIN_WORDS)[starts].view(np.int64)
                for column, value in zip(rows, (hashes, np.full(n, number), np.full(n, tag), starts)):
                    column.append(value)
                held += n
                if held > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), t) for c, t in zip(rows, types)], names=names)
                    rows, held = [[] for _ in names], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), t) for c, t in zip(rows, types)], names=names)

    return texts.mapInArrow(run, "window BIGINT, id BIGINT, tag BIGINT, start INT")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows that follow each other in a document as one span; what a batch cuts stays cut."""
    for batch in batches:
        if not batch.num_rows:
            continue
        number, tag, start, source = (batch.column(n).to_numpy() for n in ("id", "tag", "start", "source"))
        same = (number[1:] == number[:-1]) & (tag[1:] == tag[:-1])
        ahead = np.diff(start)
        first = np.flatnonzero(np.concatenate([[True], ~(same & (ahead >= 0) & (ahead <= MIN_WORDS))]))
        last = np.concatenate([first[1:], [len(start)]]) - 1
        arrays = [number[first], tag[first], start[first], start[last] + np.int32(MIN_WORDS), np.minimum.reduceat(source, first)]
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["id", "tag", "start", "end", "source"])


def _matching(rows: DataFrame, keys: DataFrame, on, n_bytes: int, how: str = "inner") -> DataFrame:
    return rows.join(F.broadcast(keys) if n_bytes <= SMALL_BYTES else keys, on, how)


def _possible(rows: DataFrame, keys: DataFrame, on: list[str], name: str) -> DataFrame:
    """``rows`` with a column ``name``: whether their key can be among ``keys``, by one bit for each hash.

    Never false for one that is; the bits are as many however many keys there are.
    """
    place = F.pmod(F.xxhash64(*on), F.lit(FILTER_BITS))
    word, bit, bits = (free_name(rows, f"{name}_{n}") for n in ("word", "bit", "bits"))
    known = keys.select(place.alias(bit)).select(F.expr(f"`{bit}` div 64").alias(word), F.expr(f"cast(`{bit}` % 64 as int)").alias(bit))
    known = known.groupBy(word).agg(F.expr(f"bit_or(shiftleft(1L, `{bit}`))").alias(bits))
    asked = rows.withColumn(bit, place).withColumn(word, F.expr(f"`{bit}` div 64"))
    asked = asked.join(F.broadcast(known), word, "left")
    return asked.withColumn(name, F.expr(f"coalesce(getbit(`{bits}`, cast(`{bit}` % 64 as int)) = 1, false)")).drop(word, bit, bits)


def _matching_texts(texts: DataFrame, keys: DataFrame, on: list[str], n_bytes: int, how: str = "inner") -> DataFrame:
    """``_matching``, but of the texts only those are shuffled whose key can be among ``keys``."""
    if n_bytes <= SMALL_BYTES:
        return _matching(texts, keys, on, n_bytes, how)
    name = free_name(texts, "possible")
    asked = _possible(texts, keys, on, name)
    joined = _matching(asked.where(name).drop(name), keys, on, n_bytes, how)
    if how == "inner":
        return joined
    return joined.unionByName(asked.where(~F.col(name)).drop(name), allowMissingColumns=True)


def _tag(print_: str | Column) -> Column:
    """Tells the texts of one id apart, in eight bytes."""
    return F.xxhash64(print_)


def _printed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return id_and_text(docs, id_col, text_col).where("doc_id IS NOT NULL").withColumn("print", F.md5("text"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tag, spans): for documents that repeat passages of others, the
    spans of words [start, end) and the least document each is found in."""
    spark = docs.sparkSession
    texts = _printed(docs, id_col, text_col)
    rows = cut(_retained(texts))
    long_ = rows.where(F.col("n_words") >= MIN_WORDS)
    classes = cut(
        long_.groupBy("print", "n_words").agg(
            F.min("doc_id").alias("id"), F.first("at").alias("at"), F.first("keys").alias("keys")
        )
    )
    copies = (
        long_.select("doc_id", "print", "n_words")
        .join(classes.select("print", "n_words", "id"), ["print", "n_words"])
        .where("doc_id <> id")
        .select(
            F.col("doc_id").alias("id"), _tag("print").alias("tag"), F.lit(0).alias("start"),
            F.col("n_words").alias("end"), F.col("id").alias("source"),
        )
        .distinct()
    )
    places = classes.select("id", _tag("print").alias("tag"), F.explode(F.arrays_zip("at", "keys")).alias("p")).select(
        "id", "tag", "p.at", F.col("p.keys").alias("key")
    )
    shared = cut(
        places.groupBy("key")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"))
        .where("low <> high")
        .select("key")
    )
    kept = cut(
        _matching(places, shared, "key", 50 * shared.count())
        .groupBy(F.col("id").alias("doc_id"), "tag")
        .agg(F.sort_array(F.collect_list("at")).alias("places"))
    )
    size = kept.agg(F.sum(F.size("places")).alias("n"), F.count("*").alias("rows")).first()
    chosen = _matching_texts(texts.withColumn("tag", _tag("print")), kept, ["doc_id", "tag"], 4 * (size.n or 0) + 100 * size.rows)
    windows = cut(_windows(chosen))
    held = cut(
        windows.groupBy("window")
        .agg(F.min("id").alias("source"), F.max("id").alias("high"))
        .where("source <> high")
        .select("window", "source")
    )
    n_bytes = 50 * held.count()
    hits = _matching(windows, held, "window", n_bytes).where("id > source").select("id", "tag", "start", "source")
    if n_bytes > SMALL_BYTES:  # a broadcast leaves them in the order of their documents
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-windows.count() // _TASK_ROWS))
        hits = hits.repartition(tasks, "id", "tag").sortWithinPartitions("id", "tag", "start")
    spans = hits.mapInArrow(_runs, "id BIGINT, tag BIGINT, start INT, end INT, source BIGINT")
    return _merged(copies.unionByName(spans))


def _merged(spans: DataFrame) -> DataFrame:
    """Overlapping and adjoining spans of a document as one."""
    one = F.struct("start", "end", "source")
    by_start = Window.partitionBy("id", "tag").orderBy("start", "end", "source")
    reach = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.distinct().withColumn("fresh", F.coalesce(F.col("start") > reach, F.lit(True)).cast("int"))
    numbered = marked.withColumn("run", F.sum("fresh").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    merged = numbered.groupBy("id", "tag", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min("source").alias("source")
    )
    return merged.groupBy(F.col("id").alias("doc_id"), "tag").agg(F.sort_array(F.collect_list(one)).alias("spans"))


def digest(repeated: DataFrame) -> DataFrame:
    """One row per repeated passage."""
    return repeated.select("doc_id", F.explode("spans").alias("s")).select(
        "doc_id",
        F.col("s.source").alias("source_doc_id"),
        F.col("s.start").cast("bigint").alias("start_word"),
        F.col("s.end").cast("bigint").alias("end_word"),
        (F.col("s.end") - F.col("s.start")).cast("bigint").alias("n_words"),
    )


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns, texts without the passages that they repeat.

    Words keep the white space after them.  Rows without id or text are as they
    were.  A copy as a whole becomes an empty text.
    """
    spans = cut(repeated_spans(docs, id_col, text_col))
    size = spans.agg(F.sum(F.size("spans")).alias("n"), F.count("*").alias("rows")).first()
    found, number, tag = (free_name(docs, n) for n in ("repeat_spans", "repeat_id", "repeat_tag"))
    spans = spans.select(F.col("doc_id").alias(number), F.col("tag").alias(tag), F.col("spans").alias(found))
    known = docs.withColumns({number: F.col(id_col).cast("bigint"), tag: _tag(F.md5(F.col(text_col)))})
    known = _matching_texts(known, spans, [number, tag], 40 * (size.n or 0) + 100 * size.rows, "left")
    words = F.regexp_extract_all(F.col(text_col), F.lit(r"[^ \t-\r]+[ \t-\r]*"), 0)
    left = F.filter(
        words, lambda _, i: ~F.exists(F.col(found), lambda s: (i >= s["start"]) & (i < s["end"]))
    )
    text = F.when(F.col(found).isNotNull(), F.array_join(left, "")).otherwise(F.col(text_col))
    return known.withColumn(text_col, text).select(*docs.columns)
