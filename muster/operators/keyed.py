"""Joins and writes by a key whose parts may be null."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Keys for which null is a value: "not on our list", "about nothing in particular".
NULLABLE_KEYS = ("cons_id", "secondary_id")


def same_key(left: str, right: str, keys: Sequence[str]) -> Column:
    """Equality of ``keys`` between two aliased frames, null-safe where null is
    a value.  Spark plans ``<=>`` as a join key, so this stays an equi join."""

    def same(key: str) -> Column:
        one, other = F.col(f"{left}.{key}"), F.col(f"{right}.{key}")
        return one.eqNullSafe(other) if key in NULLABLE_KEYS else one == other

    return reduce(Column.__and__, [same(key) for key in keys])


def distinct_keys(rows: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    """Distinct keys as columns without nulls.

    A nullable key becomes its value and whether there is one.  Grouping by
    these columns and joining on them need the same partitioning, so the keys
    move once.  Grouping combines on the map side: a key repeated in a third of
    a ledger arrives as a few rows.
    """
    return rows.select(*[c.alias(f"{prefix}{n}") for n, c in _plain_keys(keys)]).distinct()


def _plain_keys(keys: Sequence[str]) -> list[tuple[str, Column]]:
    plain = []
    for key in keys:
        column = F.col(key)
        if key in NULLABLE_KEYS:
            plain.append((key, F.coalesce(column, F.lit(0).cast("long"))))
            plain.append((f"{key}_missing", column.isNull()))
        else:
            plain.append((key, column))
    return plain


def matched(
    rows: DataFrame, others: DataFrame, keys: Sequence[str], how: str, flag: str | None = None
) -> DataFrame:
    """Join of rows with the distinct keys of ``others``; ``flag`` names a
    column that is true where a key was found."""
    found = distinct_keys(others, keys, "_r_")
    if flag:
        found = found.withColumn(flag, F.lit(True))
    same = reduce(Column.__and__, [c == F.col(f"_r_{n}") for n, c in _plain_keys(keys)])
    columns = [*rows.columns, *([flag] if flag else [])]
    return rows.join(found, same, how).select(*columns)


def having(rows: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``others``."""
    return matched(rows, others, keys, "left_semi")


def without(rows: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``others``."""
    return matched(rows, others, keys, "left_anti")


def without_history(rows: DataFrame, history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``without`` for a few stored rows against a history that only grows.

    An anti join would shuffle the whole history.  A semi join first keeps the
    part of it that can matter; where the rows are small, Spark sends them to
    the history scan and nothing of the history is shuffled.
    """
    return without(rows, having(history.select(*keys), rows, keys), keys)


def upsert(target: DataFrame, staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target with the rows of the staged keys replaced by the staged rows."""
    kept = without(target, staging, keys)
    return kept.unionByName(staging.select(*target.columns))


def first_per_key(
    rows: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """One whole row per key, the first in ``order``.

    Spark limits each group before the shuffle as well as after it
    (``WindowGroupLimit``), so a hot key sends one row per task.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place")


def latest_state(log: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Last row per key of an append-only log.

    An aggregate, not a window: its partial step keeps one row per key and task.
    """
    others = [name for name in log.columns if name not in (*keys, order)]
    last = F.max(F.struct(order, *others)).alias("_last")
    return log.groupBy(*keys).agg(last).select(*keys, "_last.*").select(*log.columns)
