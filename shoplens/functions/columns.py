"""Choosing, describing and serialising columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

# --- fixed values: columns that describe an entity rather than measure it --
METADATA_COLUMNS = (
    "category_id", "parent_category_id", "is_available", "available_raw_value",
    "has_category_metadata", "has_availability_metadata",
    "first_event_timestamp_ms", "last_event_timestamp_ms",
    "first_event_datetime", "last_event_datetime", "strongest_event_type",
)


def preferred(df: DataFrame, names: Iterable[str], keep_rest: bool = True) -> DataFrame:
    """Columns of ``names`` that exist, in that order, then the others."""
    first = [name for name in names if name in df.columns]
    rest = [name for name in df.columns if name not in first] if keep_rest else []
    return df.select(*first, *rest)


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def row_as_json(df: DataFrame, names: Iterable[str] | None = None) -> Column:
    """A JSON object of the row's values as text, keys in alphabetical order."""
    ordered = sorted(names if names is not None else df.columns)
    return F.to_json(
        F.map_from_arrays(
            F.array(*[F.lit(name) for name in ordered]),
            F.array(*[F.col(name).cast("string") for name in ordered]),
        )
    )


def column_role(name: str | Column, entity_keys: Column, metadata: Iterable[str] = METADATA_COLUMNS) -> Column:
    column = F.col(name) if isinstance(name, str) else name
    return (
        F.when(F.array_contains(entity_keys, column), "entity_key")
        .when(column.isin(*metadata), "metadata")
        .otherwise("feature")
    )
