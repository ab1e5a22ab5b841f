"""Event weights, guarded ratios and model scores."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shoplens.constants import (
    ADD_TO_CART,
    EVENT_WEIGHTS,
    SCORE_DECIMALS,
    TRANSACTION,
    VIEW,
)
from shoplens.functions.values import as_column


def event_weight(event_type: str | Column, unknown: float) -> Column:
    """Weight of an event; ``unknown`` is the weight of other types.

    Curation and popularity give unknown types nothing (0.0), the content
    model counts them like a view (1.0).
    """
    kind = as_column(event_type)
    weight = F.when(kind == VIEW, EVENT_WEIGHTS[VIEW])
    for name in (ADD_TO_CART, TRANSACTION):
        weight = weight.when(kind == name, EVENT_WEIGHTS[name])
    return weight.otherwise(unknown)


def weighted_count_score(views: str, carts: str, transactions: str) -> Column:
    return (
        F.col(views) * EVENT_WEIGHTS[VIEW]
        + F.col(carts) * EVENT_WEIGHTS[ADD_TO_CART]
        + F.col(transactions) * EVENT_WEIGHTS[TRANSACTION]
    )


def guarded_ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """numerator / denominator, and 0.0 unless the denominator is positive."""
    below = as_column(denominator)
    return F.when(below > 0, as_column(numerator).cast("double") / below).otherwise(0.0)


def ratio_or_zero(numerator: str | Column, denominator: str | Column) -> Column:
    """numerator / denominator, and 0.0 where that is undefined."""
    return F.coalesce(
        as_column(numerator).cast("double") / F.nullif(as_column(denominator), F.lit(0)), F.lit(0.0)
    )


def settled(score: Column) -> Column:
    return F.round(score, SCORE_DECIMALS)


def popularity_score(score: str, users: str, transactions: str, carts: str, available: str) -> Column:
    # fixed values: the five coefficients
    return settled(
        0.40 * F.log1p(F.col(score).cast("double"))
        + 0.25 * F.log1p(F.col(users).cast("double"))
        + 0.20 * F.log1p(F.col(transactions).cast("double"))
        + 0.10 * F.log1p(F.col(carts).cast("double"))
        + 0.05 * F.coalesce(F.col(available), F.lit(0))
    )


def content_prior(score: str, cart_rate: str, transaction_rate: str, available: str) -> Column:
    # fixed values: the coefficients
    return settled(
        F.log1p(F.col(score).cast("double"))
        + 0.50 * F.col(cart_rate)
        + 1.00 * F.col(transaction_rate)
        + 0.10 * F.coalesce(F.col(available), F.lit(0))
    )


def metadata_score() -> Column:
    # fixed values: the coefficients
    return (
        0.10 * F.col("is_available")
        + 0.05 * F.col("has_category_metadata")
        + 0.05 * F.col("has_availability_metadata")
    )


def conversion_score() -> Column:
    return 0.50 * F.col("addtocart_rate") + 1.00 * F.col("transaction_rate")


def popularity_prior() -> Column:
    return 0.05 * F.log1p(F.col("train_interaction_score").cast("double"))


def profile_match(category_share: str, parent_share: str) -> Column:
    """The part of the content score that depends on the user."""
    return 2.00 * F.col(category_share) + 1.00 * F.col(parent_share)


def discounted_gain(position: str | Column) -> Column:
    return 1.0 / F.log2(as_column(position) + 1)
