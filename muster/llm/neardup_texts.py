"""Near-duplicate texts by SetSketch registers, exact in what it reports.

1. A document's set holds the hashes of its distinct five-word shingles; equal
   sets are one class, carried by its smallest id, so thousands of copies are
   compared once.
2. Each class has a SetSketch; bands of its registers are buckets.  With 51
   bands of five registers, two sets of similarity 0.75 share no bucket with a
   probability of a millionth.
3. Only buckets with several classes go on.  Each class is first compared with
   up to ``CENTRES`` centres of its buckets: every bucket offers the two members
   with most bucket mates, and the class takes those it shares most buckets with.
   This is linear in the buckets' sizes, and enough for nearly all components: of
   near copies of one text, those nearest to it have most mates.
4. Classes whose buckets still hold several components are joined exactly, by
   prefix and position filters: similar sets must share one of their rarest
   shingles, early enough that what follows can still make up the overlap.  So
   documents that have a common passage, but too little else, don't meet there.
   No pair of different components that shares a bucket is left untested.
5. Of a proposed pair, sizes must allow the similarity; the registers' joint
   likelihood must not rule it out; then the full sets are intersected.

Components are by links; one document of each is kept, the smallest id.  An
empty set (no words, null text) links with nothing.  Rows without id are left
out; rows that repeat an id are one document with several sets, of which
``n_shingles`` is the largest's size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster.llm.components import connected_components
from muster.llm.frames import id_and_text, utf8
from muster.llm.setsketch import bands, registers, unlikely
from muster.llm.shingles import mixed, shingle_set
from muster.sources.scratch import cut

PERCENT = 75
CENTRES = 4  # of each class, compared before the exact join
SMALL_ROWS = 1_000_000  # of ids or bucket keys, about 50 MB as a hash table
_BATCH_HASHES = 1 << 18


def _few_sets(batches: Iterator[pa.RecordBatch], text_col: str) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Rows with their sets, a bounded number of hashes at a time (or one row)."""
    for batch in batches:
        start, sets, size = 0, [], 0
        for at, text in enumerate(utf8(batch.column(text_col))):
            sets.append(shingle_set(text))
            size += len(sets[-1])
            if size >= _BATCH_HASHES:
                yield batch.slice(start, at + 1 - start), sets
                start, sets, size = at + 1, [], 0
        if sets:
            yield batch.slice(start), sets


def _sketches(sets: list[np.ndarray]) -> list[np.ndarray | None]:
    full = [s for s in sets if len(s)]
    rows = iter(registers(full)) if full else iter(())
    return [next(rows) if len(s) else None for s in sets]


def _fingerprint(hashes: np.ndarray) -> bytes:
    """128 bits of a set."""
    sums = (np.sum(mixed(hashes ^ np.uint64(k)), dtype=np.uint64) for k in (3, 5))
    return b"".join(int(s).to_bytes(8, "little") for s in sums)


def _sketched(docs: DataFrame) -> DataFrame:
    """(doc_id, n, print, bands) for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _few_sets(batches, "text"):
            keys = [None if s is None else bands(s[None, :])[0] for s in _sketches(sets)]
            arrays = [
                batch.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_fingerprint(s) for s in sets], pa.binary()),
                pa.array(keys, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "print", "bands"])

    return docs.mapInArrow(run, "doc_id BIGINT, n BIGINT, print BINARY, bands ARRAY<BIGINT>")


def _full_sets(docs: DataFrame) -> DataFrame:
    """(id, n, sketch, shingles) for rows with their class's fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "n", "print", "sketch", "shingles"]
        for batch, sets in _few_sets(batches, "text"):
            sketches = [s if s is None else s.tobytes() for s in _sketches(sets)]
            arrays = [
                batch.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_fingerprint(s) for s in sets], pa.binary()),
                pa.array(sketches, pa.binary()),
                pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "id BIGINT, n BIGINT, print BINARY, sketch BINARY, shingles ARRAY<BIGINT>"
    return docs.mapInArrow(run, schema)


def _matching(rows: DataFrame, keys: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """A join with a stored table, by broadcast while that has few rows."""
    return rows.join(F.broadcast(keys) if keys.count() <= SMALL_ROWS else keys, on, how)


def _sizes_allow(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each id; see the module for odd rows."""
    texts = id_and_text(docs, id_col, text_col).where("doc_id IS NOT NULL")
    rows = cut(_sketched(texts))
    classes = cut(
        rows.where("n > 0")
        .groupBy("print", "n")
        .agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands"))
    )
    buckets = classes.select(F.explode("bands").alias("bucket"), "id", "n")
    shared = cut(
        buckets.groupBy("bucket")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"))
        .where("low <> high")
        .select("bucket")
    )
    members = cut(_matching(buckets, shared, "bucket"))
    chosen = cut(members.select("id").distinct())
    sets = cut(
        _full_sets(_matching(texts, chosen.withColumnRenamed("id", "doc_id"), "doc_id"))
        .join(classes.select("id", "print"), ["id", "print"], "left_semi")
        .dropDuplicates(["id", "print"])
    )
    components = _components(members, sets, percent)
    carried = (
        classes.select("print", "n", "id")
        .join(components, "id", "left")
        .select("print", "n", F.coalesce("component", "id").alias("component"))
    )
    # An id with several sets is one document: its classes belong together.
    known = rows.select("doc_id", "n", "print").join(carried, ["print", "n"], "left")
    known = known.groupBy("doc_id").agg(
        F.max("n").alias("n_shingles"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    known = cut(known.select("doc_id", "n_shingles", F.coalesce("low", "doc_id").alias("low"), "high"))
    bridges = known.where("high <> low").select(F.col("low").alias("a"), F.col("high").alias("b"))
    if not bridges.isEmpty():
        joined = connected_components(bridges).withColumnRenamed("id", "low")
        known = known.join(joined, "low", "left").withColumn("low", F.coalesce("component", "low"))
    return known.select(
        "doc_id",
        F.col("n_shingles").cast("bigint").alias("n_shingles"),
        F.col("low").alias("component_id"),
        (F.col("low") == F.col("doc_id")).alias("kept"),
    )


def _components(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(id, component) of the classes that have links."""
    spark = members.sparkSession
    components = spark.createDataFrame([], "id BIGINT, component BIGINT")
    pairs = cut(_with_centres(_open(members, components), percent))
    if pairs.isEmpty():
        return components
    links = cut(_confirmed(pairs, sets, percent))
    components = cut(connected_components(links))
    rest = cut(_across(_open(members, components), sets, percent).join(pairs, ["a", "b"], "left_anti"))
    if rest.isEmpty():
        return components
    more = cut(_confirmed(rest, sets, percent))
    return components if more.isEmpty() else cut(connected_components(links.unionByName(more)))


def _open(members: DataFrame, components: DataFrame) -> DataFrame:
    """(bucket, id, n, component, mates) of the buckets that hold several components."""
    placed = members.join(components, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed_ = placed.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size")
    )
    mixed_ = cut(mixed_.where("low <> high").select("bucket", "size"))
    rows = cut(_matching(placed, mixed_, "bucket"))
    return cut(rows.join(rows.groupBy("id").agg(F.sum("size").alias("mates")), "id").drop("size"))


def _with_centres(open_: DataFrame, percent: int) -> DataFrame:
    """For each class, the centres of its buckets that it shares most of them with."""
    member = F.struct("mates", "id", "n")
    first = cut(open_.groupBy("bucket").agg(F.max(member).alias("centre")))
    others = open_.join(first, "bucket").where(F.col("id") != F.col("centre.id"))
    second = others.groupBy("bucket").agg(F.max(member).alias("centre"))
    centres = first.unionByName(second).select(
        "bucket", F.col("centre.id").alias("other"), F.col("centre.n").alias("m")
    )
    proposed = open_.join(centres, "bucket").where(
        (F.col("id") != F.col("other")) & _sizes_allow(F.col("n"), F.col("m"), percent)
    )
    counted = proposed.groupBy("id", "other").count()
    order = Window.partitionBy("id").orderBy(F.desc("count"), "other")
    best = counted.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= CENTRES)
    return _ordered(best)


def _across(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes of different components that may be similar enough, none left out.

    With the shingles of every set in one order, from the rarest, the smaller
    of two similar sets has their first common one within its first
    n - 2tn / (1 + t) + 1, and the larger within its first n - tn + 1; and what
    comes after it in both must make up the overlap.
    """
    ids = cut(open_.select("id", "component").distinct())
    shingles = cut(
        sets.join(ids, "id").select("id", "print", "n", "component", F.explode("shingles").alias("shingle"))
    )
    common = shingles.groupBy("shingle").agg(F.count("*").alias("held")).where("held > 1")
    # Those that one set alone holds come first, and are only counted.
    kept = shingles.join(common, "shingle")
    place = F.row_number().over(Window.partitionBy("id", "print").orderBy("held", "shingle"))
    size = F.count("*").over(Window.partitionBy("id", "print"))
    ranked = kept.withColumn("place", place + F.col("n") - size)
    n = F.col("n")
    longer = ranked.where(F.col("place") <= n - F.ceil(n * percent / 100) + 1)
    longer = cut(longer.select("shingle", "id", "n", "component", "place"))
    shorter = longer.where(F.col("place") <= n - F.ceil(n * 2 * percent / (100 + percent)) + 1)
    shorter = shorter.withColumnsRenamed({"id": "other", "n": "m", "component": "apart", "place": "at"})
    overlap = F.ceil((F.col("n") + F.col("m")) * percent / (100 + percent))
    possible = (
        (F.struct("m", "other") < F.struct("n", "id"))
        & (F.col("component") != F.col("apart"))
        & _sizes_allow(F.col("n"), F.col("m"), percent)
        & (1 + F.least(F.col("n") - F.col("place"), F.col("m") - F.col("at")) >= overlap)
    )
    return _ordered(longer.join(shorter, "shingle").where(possible))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    def side(columns: list[str], name: str) -> DataFrame:
        return sets.select(F.col("id").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, other = (
                np.frombuffer(b"".join(batch.column(f"sketch_{s}").to_pylist()), dtype=np.uint16).reshape(
                    batch.num_rows, -1
                )
                for s in "ab"
            )
            sizes = (batch.column(f"n_{s}").to_numpy().astype(float) for s in "ab")
            likely = ~unlikely(one, other, *sizes, percent / 100) if batch.num_rows else []
            yield batch.select(["a", "b"]).filter(pa.array(likely, pa.bool_()))

    both = pairs.join(side(["n", "sketch"], "a"), "a").join(side(["n", "sketch"], "b"), "b")
    both = both.where(_sizes_allow(F.col("n_a"), F.col("n_b"), percent))
    likely = cut(both.mapInArrow(run, "a BIGINT, b BIGINT").distinct())
    full = likely.join(side(["n", "shingles"], "a"), "a").join(side(["n", "shingles"], "b"), "b")
    common = F.size(F.array_intersect("shingles_a", "shingles_b"))
    union = F.col("n_a") + F.col("n_b") - common
    return full.where(common * 100 >= union * percent).select("a", "b").distinct()
