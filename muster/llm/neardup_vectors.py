"""Near-duplicate vectors: spherical k-means cells with margins, blocked cosines, one kept per group.

1. Equal vectors are one class, carried by its smallest id and its size, so a
   vector that fills a third of the table is compared once.
2. Spherical k-means on a sample of at most ``SAMPLE`` classes gives the
   centroids: at most one for ``CELL_SIZE`` classes (and ``MOST_CELLS``), and fewer
   where the sample says that vectors would visit so many cells that copying them
   costs more than the cells save.
3. Every class has a home, its nearest centroid's cell, and visits each cell
   whose border is within ``margin`` of it.  Of two linked vectors in different
   cells, the distances to the border between them add up to what their
   difference spans across it, so a link is lost only if that exceeds twice the
   margin.  The difference is at most sqrt(2 - 2 * 0.9) long; half of that as
   margin loses nothing, whatever the vectors.  ``exact=False`` takes ``REACH``
   standard deviations of what a difference of that length and random direction
   spans across a plane, and loses links where few directions hold the differences.
4. A cell's homes are dealt to parts of about ``HOMES`` and those that it meets to
   slices of about ``MET`` (by counts of all classes), so a crowded cell is many
   groups.  Rows of one vector each are shuffled by part and slice; a task holds
   the homes of one group and takes the others in batches, one matrix product for
   each batch and block of homes.  Only sums and a spanning forest of the links
   leave a task, never pairs.

Cosines are taken in double precision.  Vectors that are null, zero or hold null
or non-finite components link with nothing; vectors of different lengths don't
link.  Rows without id are left out.  Rows that repeat an id are vectors of
their own for the counts, and the result has one row per id with the largest
count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from muster.llm.components import connected_components
from muster.llm.frames import bound_batches
from muster.llm.topk import finite
from muster.sources.scratch import cut

THRESHOLD = 0.9
SAMPLE = 20_000
CELL_SIZE = 2048
MOST_CELLS = 4096
REACH = 2.0
HOMES = 8192  # of a cell, held by one task
MET = 65_536  # streamed past them
BLOCK = 2048  # homes in one matrix product
COPY = 4096  # comparisons that cost as much as moving one vector
MOST_TASKS = 20_000
ITERATIONS = 8


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows as unit vectors; scaled first, so that no square over- or underflows."""
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def spherical_kmeans(units: np.ndarray, cells: int, iterations: int = ITERATIONS) -> np.ndarray:
    """Unit centroids.  Starts from evenly spaced rows; an empty cell keeps its centroid."""
    centroids = units[np.linspace(0, len(units) - 1, cells).astype(int)].copy()
    for _ in range(iterations):
        parts = (units[at : at + 1024] for at in range(0, len(units), 1024))
        home = np.concatenate([np.argmax(part @ centroids.T, axis=1) for part in parts])
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, units)
        size = np.linalg.norm(sums, axis=1)
        centroids = np.where(size[:, None] > 1e-12, sums / np.maximum(size, 1e-12)[:, None], centroids)
    return centroids


def visits(units: np.ndarray, centroids: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """Each row's home cell, and a matrix of the cells that it belongs to or visits."""
    nearness = units @ centroids.T
    home = np.argmax(nearness, axis=1)
    behind = nearness[np.arange(len(units)), home][:, None] - nearness
    # Distance to the plane between the home's centroid and each other one.
    squares = 2 - 2 * np.clip(centroids @ centroids.T, -1, 1)
    reached = behind <= margin * np.sqrt(np.maximum(squares, 0))[home] + 1e-12
    return home, reached


def _cost(units: np.ndarray, centroids: np.ndarray, margin: float, n: int) -> tuple[float, int]:
    """What comparing ``n`` classes by these cells costs, and the number of groups, by the sample."""
    homes, met = np.zeros(len(centroids)), np.zeros(len(centroids))
    for at in range(0, len(units), 1024):
        home, reached = visits(units[at : at + 1024], centroids, margin)
        homes += np.bincount(home, minlength=len(centroids))
        met += reached.sum(axis=0)
    homes, met = homes * (n / len(units)), met * (n / len(units))
    parts, slices = np.ceil(homes / HOMES), np.ceil(met / MET)
    return float((homes * met + COPY * (met * parts + homes * slices)).sum()), int((parts * slices).sum())


def _centroids(units: np.ndarray, margin: float, n: int, cell_size: int | None) -> tuple[np.ndarray, int]:
    """The centroids for ``n`` classes, and about how many groups will be compared."""
    cells = max(1, min(MOST_CELLS, len(units), n // (cell_size or CELL_SIZE)))
    found = []
    while True:
        centroids = spherical_kmeans(units, cells)
        found.append((*_cost(units, centroids, margin, n), centroids))
        if cell_size or cells == 1:
            break
        cells = max(1, cells // 8)
    _, groups, centroids = min(found, key=lambda f: f[0])
    return centroids, groups


def _forest(x: np.ndarray, y: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the links between places below ``n``, enough to connect what they connect: each
    place but the first of its component, and that first one."""
    label = np.arange(n)
    while True:
        before = label.copy()
        least = np.minimum(before[x], before[y])
        np.minimum.at(label, before[x], least)
        np.minimum.at(label, before[y], least)
        while (label[label] != label).any():
            label = label[label]
        if (label == before).all():
            break
    rest = np.flatnonzero(label != np.arange(n))
    return label[rest], rest


def _classes(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector, n): one row per distinct vector that can link."""
    vector = F.col(vector_col)
    usable = finite(vector) & F.exists(vector, lambda x: x != 0)
    return (
        rows.where(usable & F.col(id_col).isNotNull())
        # 0.0 and -0.0 are equal as values; adding zero makes them equal as keys.
        .select(F.col(id_col).cast("bigint").alias("id"), F.transform(vector, lambda x: x.cast("double") + 0.0).alias("vector"))
        .groupBy("vector")
        .agg(F.min("id").alias("id"), F.count("*").alias("n"))
    )


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The vectors of a batch, in double precision."""
    column = batch.column("vector")
    values = column.values.to_numpy()[column.offsets[0].as_py() : column.offsets[-1].as_py()]
    return values.astype(np.float64).reshape(-1, width)


def _assigned(classes: DataFrame, centroids, margin: float, kind: str) -> DataFrame:
    """(id, n, vector, home, cells, reached): the cells that a class belongs to or visits, as a
    list and as bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = centroids.value
        for batch in batches:
            if not batch.num_rows:
                continue
            home, reached = visits(unit_rows(_matrix(batch, centres.shape[1])), centres, margin)
            columns = {
                **{name: batch.column(name) for name in ("id", "n", "vector")},
                "home": pa.array(home.astype(np.int32)),
                "cells": pa.array([np.flatnonzero(r).astype(np.int32) for r in reached], pa.list_(pa.int32())),
                "reached": pa.array([r.tobytes() for r in np.packbits(reached, axis=1)], pa.binary()),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return classes.select("id", "n", F.col("vector").cast(f"array<{kind}>")).mapInArrow(
        run, f"id BIGINT, n BIGINT, vector ARRAY<{kind}>, home INT, cells ARRAY<INT>, reached BINARY"
    )


def _grid(assigned: DataFrame) -> DataFrame:
    """(cell, part, slice, own, id, n, vector, home, reached): a home in one part of its cell and
    all slices, and each class that a cell meets (its homes too) in one slice and all parts."""
    met = assigned.select("home", F.explode("cells").alias("cell"))
    sizes = met.groupBy("cell").agg(
        F.ceil(F.count_if(F.col("home") == F.col("cell")) / HOMES).cast("int").alias("parts"),
        F.ceil(F.count("*") / MET).cast("int").alias("slices"),
    )
    sizes = F.broadcast(cut(sizes.where("parts > 0")))  # a row per cell

    def dealt(numbers: str, seed: int):
        return F.pmod(F.xxhash64("id", "vector", F.lit(seed)), numbers).cast("int")

    def each(numbers: str):
        return F.explode(F.sequence(F.lit(0), F.col(numbers) - 1))

    def rows(placed: DataFrame, own: bool) -> DataFrame:
        return placed.select("cell", "part", "slice", F.lit(own).alias("own"), "id", "n", "vector", "home", "reached")

    homes = assigned.withColumn("cell", F.col("home")).join(sizes, "cell")
    homes = homes.withColumn("part", dealt("parts", 1)).withColumn("slice", each("slices"))
    others = assigned.withColumn("reached", F.lit(None).cast("binary")).withColumn("cell", F.explode("cells")).join(sizes, "cell")
    others = others.withColumn("slice", dealt("slices", 2)).withColumn("part", each("parts"))
    return rows(homes, True).unionByName(rows(others, False))


def _compared(grid: DataFrame, width: int, threshold: float, tasks: int) -> DataFrame:
    """(id, links, a, b): for linked classes sums of sizes, and links that connect them."""
    names, group = ["id", "links", "a", "b"], ["cell", "part", "slice"]

    def table(first: str, second: str, x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
        known = {first: pa.array(x, pa.int64()), second: pa.array(y, pa.int64())}
        return pa.RecordBatch.from_arrays([known.get(n, pa.nulls(len(x), pa.int64())) for n in names], names=names)

    def met(held: dict, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        other, weights, homes = (batch.column(n).to_numpy() for n in ("id", "n", "home"))
        units = unit_rows(_matrix(batch, width))
        for at in range(0, len(held["id"]), BLOCK):
            ids, sizes, reached = (held[n][at : at + BLOCK] for n in ("id", "n", "reached"))
            x, y = np.nonzero(held["units"][at : at + BLOCK] @ units.T >= threshold)
            distinct = ids[x] != other[y]
            x, y = x[distinct], y[distinct]
            if not len(x):
                continue
            np.add.at(held["links"][at : at + BLOCK], x, weights[y])
            # A home counts its links; a visitor that the home doesn't visit cannot, and is told.
            cell = homes[y]
            blind = reached[x, cell >> 3] >> (7 - (cell & 7)) & 1 == 0
            if blind.any():
                who, place = np.unique(y[blind], return_inverse=True)
                sums = np.zeros(len(who), dtype=np.int64)
                np.add.at(sums, place, sizes[x[blind]])
                yield table("id", "links", other[who], sums)
            first, rest = _forest(x, len(ids) + y, len(ids) + len(other))
            both = np.concatenate([ids, other])
            yield table("a", "b", both[first], both[rest])

    def joined(parts: list[pa.RecordBatch]) -> dict:
        table_ = pa.Table.from_batches(parts)
        reached = np.frombuffer(b"".join(table_.column("reached").to_pylist()), dtype=np.uint8)
        return {
            "id": table_.column("id").to_numpy(),
            "n": table_.column("n").to_numpy(),
            "links": np.zeros(table_.num_rows, dtype=np.int64),
            "units": np.concatenate([unit_rows(_matrix(part, width)) for part in parts]),
            "reached": reached.reshape(table_.num_rows, -1),
        }

    def counted(held: dict) -> Iterator[pa.RecordBatch]:
        if held:
            linked = held["links"] > 0
            yield table("id", "links", held["id"][linked], held["links"][linked])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, waiting, held = None, [], {}
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(n).to_numpy() for n in (*group, "own")], axis=1)
            starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
            for start, end in zip(starts, [*starts[1:], len(keys)], strict=True):
                part, (*own_key, own) = batch.slice(start, end - start), keys[start].tolist()
                if own_key != key:
                    yield from counted(held)
                    key, waiting, held = own_key, [], {}
                if own:
                    waiting.append(part)
                elif waiting or held:
                    if not held:
                        held, waiting = joined(waiting), []
                    yield from met(held, part)
        yield from counted(held)

    # As many tasks as groups and more, by their work and not by their bytes.
    dealt = grid.repartition(tasks, *group).sortWithinPartitions(*group, F.desc("own"))
    return dealt.withColumn("own", F.col("own").cast("int")).mapInArrow(run, "id BIGINT, links BIGINT, a BIGINT, b BIGINT")


def near_duplicates(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    cell_size: int | None = None,
    exact: bool = True,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each id; see the module for odd vectors.

    ``cell_size`` sets the number of classes a cell instead of the least cost.
    """
    spark = rows.sparkSession
    bound_batches(spark)
    kind = "float" if isinstance(rows.schema[vector_col].dataType.elementType, FloatType) else "double"
    classes = cut(_classes(rows, id_col, vector_col))
    linked, edges = [], []
    for width, n in sorted(classes.groupBy(F.size("vector")).count().collect()):
        own = classes.where(F.size("vector") == width)
        sample = own.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").toArrow()
        units = unit_rows(np.array(sample.column("vector").combine_chunks().values).reshape(-1, width))
        length = math.sqrt(max(0.0, 2 - 2 * threshold))
        margin = min(length / 2, math.inf if exact else REACH * length / math.sqrt(width))
        centroids, groups = _centroids(units, margin, n, cell_size)
        assigned = cut(_assigned(own, spark.sparkContext.broadcast(centroids), margin, kind))
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(MOST_TASKS, 4 * groups))
        found = cut(_compared(_grid(assigned), width, threshold, tasks))
        linked.append(found.where("id IS NOT NULL").select("id", "links"))
        edges.append(found.where("a IS NOT NULL").select("a", "b"))
    return _result(rows, id_col, vector_col, classes, linked, edges)


def _result(rows, id_col, vector_col, classes, linked, edges) -> DataFrame:
    spark = rows.sparkSession
    empty = spark.createDataFrame([], "a BIGINT, b BIGINT")
    for more in edges:
        empty = empty.unionByName(more)
    components = connected_components(empty)
    sums = spark.createDataFrame([], "id BIGINT, links BIGINT")
    for more in linked:
        sums = sums.unionByName(more)
    sums = sums.groupBy("id").agg(F.sum("links").alias("links"))
    known = (
        classes.join(sums, "id", "left")
        .join(components, "id", "left")
        .select(
            "vector",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    keyed = rows.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        F.transform(vector_col, lambda x: x.cast("double") + 0.0).alias("vector"),
    )
    return (
        keyed.join(known, "vector", "left")
        .groupBy("vec_id")
        .agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id") == F.col("component_id"))
    )
