"""Casts, flags and time arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shoplens.constants import DAY_MS, FALSE_TEXTS, TRUE_TEXTS


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def whole_number(text: str | Column) -> Column:
    """Text to BIGINT; fractions round half up, anything else becomes NULL.

    ``'12.6'`` -> 13 and ``' 7 '`` -> 7, where a bare ``try_cast`` to BIGINT
    would turn the fraction into NULL. Eighteen decimals are kept before
    rounding, so ``'12.4999999'`` is 12.
    """
    return F.round(as_column(text).try_cast("decimal(38,18)")).try_cast("bigint")


def instant(ms: str | Column) -> Column:
    return F.timestamp_millis(as_column(ms))


def availability_flag(text: str | Column) -> Column:
    lowered = F.lower(as_column(text))
    return F.when(lowered.isin(*TRUE_TEXTS), 1).when(lowered.isin(*FALSE_TEXTS), 0)


def root_flag(parent: str | Column) -> Column:
    return as_column(parent).isNull().cast("int")


def match_flag(key: str | Column) -> Column:
    """1 where an outer join found a partner."""
    return as_column(key).isNotNull().cast("int")


def flag(condition: Column) -> Column:
    """1 where true, 0 where false or unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def utc_day(ms: str | Column) -> Column:
    """Whole days since the epoch, independent of the session time zone."""
    return F.floor(as_column(ms) / F.lit(float(DAY_MS)))


def active_days(first_ms: str | Column, last_ms: str | Column) -> Column:
    """Calendar days from first to last event, both included."""
    return utc_day(last_ms) - utc_day(first_ms) + 1


def text_or_null() -> Column:
    return F.lit(None).cast("string")


def clip_upper(value: str | Column, upper: str | Column) -> Column:
    return F.least(as_column(value), as_column(upper))
