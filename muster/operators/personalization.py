"""Personalisation values in the long form in which they are handed over."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: longest name a personalisation dataset may have.
MAX_SLUG_LENGTH = 30


def slugs(columns: Sequence[str], prefix: str) -> dict[str, str]:
    """Dataset name per column; an overlong one is refused before any work."""
    named = {column: f"{prefix}_{column}" for column in columns}
    for slug in named.values():
        if len(slug) > MAX_SLUG_LENGTH:
            raise ValueError(f"{slug} is longer than {MAX_SLUG_LENGTH} characters")
    return named


def personalization_long(
    dataset: DataFrame, columns: Sequence[str], prefix: str
) -> DataFrame:
    """One (id, slug, value) row per person and column."""
    named = slugs(columns, prefix)
    identity = next(name for name in dataset.columns if name not in columns)
    texts = dataset.select(identity, *[F.col(c).cast("string").alias(named[c]) for c in columns])
    return texts.unpivot(identity, list(named.values()), "slug", "value")
