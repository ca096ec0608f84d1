"""Global row positions without a single-task window."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.sources.scratch import cut, measured_cut

# Bytes of stored rows, compressed, that one task should sort.
TASK_BYTES = 16 << 20
_ROW_BITS = 33  # low bits of monotonically_increasing_id: row within its partition


def with_position(rows: DataFrame, order: Sequence[Column], partitions: int | None = None) -> DataFrame:
    """Rows with their zero-based ``position`` in ``order``.

    The rows are written first, which tells their size; the number of ranges
    follows from it, and Spark's range partitioner finds their bounds in a sample.
    Rows that tie are told apart by their place in what was written, so that
    ranges can be cut anywhere: one crowded address, or one row repeated for ever,
    is as many ranges as its size asks for.  A row's position is its place in its
    range plus the sizes of the ranges before.  Only those sizes, one number per
    range, reach the driver.
    """
    spark = rows.sparkSession
    stored, size = measured_cut(rows.withColumn("_tie", F.monotonically_increasing_id()))
    n = partitions or max(1, -(-size // TASK_BYTES))
    order = [*order, F.asc("_tie")]
    ordered = cut(
        stored.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .drop("_tie")
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    part = F.shiftright("_slot", _ROW_BITS)
    place = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    sizes = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("size")).collect()

    before, offsets = 0, []
    for size in sorted(sizes):
        offsets.append((size.part, before))
        before += size.size
    offset_of = spark.createDataFrame(offsets, "_part BIGINT, _before BIGINT")
    return (
        ordered.withColumn("_part", part)
        .join(F.broadcast(offset_of), "_part")  # one row per partition
        .withColumn("position", F.col("_before") + place)
        .drop("_part", "_before", "_slot")
    )


def in_batches(
    positioned: DataFrame,
    batch_size: int,
    limit: int | None = None,
    exact: bool = False,
) -> DataFrame:
    """Number batches and rows within them, up to a limit.

    The limit is checked after each whole batch, so it is met by the first
    batch that reaches it; ``exact`` cuts at the limit itself.
    """
    if limit:
        batch_size = min(batch_size, limit)
        kept = limit if exact else math.ceil(limit / batch_size) * batch_size
        positioned = positioned.where(F.col("position") < kept)
    return positioned.withColumns(
        {
            "batch": F.expr(f"position div {batch_size}"),
            "batch_index": F.expr(f"position % {batch_size}"),
        }
    )
