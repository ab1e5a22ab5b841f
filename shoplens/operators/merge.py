"""Unions of differing columns and replace-by-key merges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def stack(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; a column a frame lacks is NULL there."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def replace_by_key(existing: DataFrame | None, current: DataFrame, key: str, value: str) -> DataFrame:
    """``existing`` without rows of this key or of a blank key, then ``current``.

    An existing report that lacks the key column is dropped altogether.
    Columns that are NULL throughout are kept: the schema stays fixed.
    """
    if existing is None or key not in existing.columns:
        return current
    column = F.col(key)
    kept = existing.where(column.isNotNull() & (F.trim(column) != "") & (column != value))
    return stack(kept, current)
