"""Joins whose keys are crowded by a known amount."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of one key above which it is not shuffled to one task.
CROWD = 1_000_000


def join_crowds(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    weight: str,
    crowd: int = CROWD,
) -> DataFrame:
    """Rows joined to a stored table of one row per key.

    ``weight`` in the table says how many rows have its key.  There are at most
    (all rows / crowd) crowded keys, so those go to the rows by broadcast, and
    rows with such a key stay where they are; only the others are shuffled.
    """
    keys = list(keys)
    crowded = lookup.where(F.col(weight) > crowd)
    if crowded.isEmpty():
        return rows.join(lookup, keys)
    crowded = F.broadcast(crowded)
    usual = rows.join(crowded.select(*keys), keys, "left_anti")
    in_place = rows.join(crowded, keys)
    return in_place.unionByName(usual.join(lookup.where(F.col(weight) <= crowd), keys))
