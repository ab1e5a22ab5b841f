"""Marts and feature views."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shoplens.constants import ADD_TO_CART, EVENT_WEIGHTS, TRANSACTION, VIEW
from shoplens.functions.scores import guarded_ratio, weighted_count_score
from shoplens.functions.values import active_days, instant
from shoplens.operators.rollup import user_rollup


def mart_user_features(pairs: DataFrame) -> DataFrame:
    users = user_rollup(pairs)
    return users.select(
        "user_id", "total_events", "unique_items", "view_events", "addtocart_events", "transaction_events",
        "total_interaction_score",
        (F.col("total_interaction_score") / F.col("total_events")).alias("avg_interaction_weight"),
        "first_event_timestamp_ms", "last_event_timestamp_ms",
        instant("first_event_timestamp_ms").alias("first_event_datetime"),
        instant("last_event_timestamp_ms").alias("last_event_datetime"),
    )


def mart_item_features(items: DataFrame) -> DataFrame:
    score = weighted_count_score("view_events", "addtocart_events", "transaction_events")
    return items.select(
        "item_id", "total_events", "unique_users", "view_events", "addtocart_events", "transaction_events",
        score.alias("total_interaction_score"),
        guarded_ratio(score, "total_events").alias("avg_interaction_weight"),
        "first_event_timestamp_ms", "last_event_timestamp_ms", "first_event_datetime", "last_event_datetime",
        "category_id", "parent_category_id", "is_available", "available_raw_value",
        "has_category_metadata", "has_availability_metadata",
    )


def user_features(mart: DataFrame) -> DataFrame:
    return mart.select(
        *mart.columns,
        active_days("first_event_timestamp_ms", "last_event_timestamp_ms").alias("active_days"),
        guarded_ratio("addtocart_events", "total_events").alias("addtocart_event_rate"),
        guarded_ratio("transaction_events", "total_events").alias("transaction_event_rate"),
        guarded_ratio("total_events", "unique_items").alias("events_per_unique_item"),
    )


def item_features(mart: DataFrame) -> DataFrame:
    return mart.select(
        *mart.columns,
        guarded_ratio("addtocart_events", "view_events").alias("addtocart_rate"),
        guarded_ratio("transaction_events", "view_events").alias("transaction_rate"),
        guarded_ratio("transaction_events", "addtocart_events").alias("cart_to_transaction_rate"),
    )


def user_item_features(user_items: DataFrame, item_view: DataFrame | None = None) -> DataFrame:
    """Pair features with the item's metadata.

    ``user_items`` already carries that metadata. Pass ``item_view`` to take
    it from a stored item feature table instead.
    """
    borrowed = ["category_id", "parent_category_id", "is_available", "has_category_metadata", "has_availability_metadata"]
    pairs = user_items
    if item_view is not None:
        pairs = user_items.drop(*borrowed).join(item_view.select("item_id", *borrowed), "item_id", "left")
    bought, carted = F.col("has_transaction") == 1, F.col("has_addtocart") == 1
    return pairs.select(
        "user_id", "item_id", "total_events", "view_count", "addtocart_count", "transaction_count",
        "interaction_score", "max_event_weight", "first_event_timestamp_ms", "last_event_timestamp_ms",
        "first_event_datetime", "last_event_datetime", "has_transaction", "has_addtocart", *borrowed,
        guarded_ratio("addtocart_count", "view_count").alias("user_item_addtocart_rate"),
        guarded_ratio("transaction_count", "view_count").alias("user_item_transaction_rate"),
        guarded_ratio("transaction_count", "addtocart_count").alias("user_item_cart_to_transaction_rate"),
        F.when(bought, EVENT_WEIGHTS[TRANSACTION])
        .when(carted, EVENT_WEIGHTS[ADD_TO_CART])
        .otherwise(EVENT_WEIGHTS[VIEW])
        .alias("implicit_label"),
        F.when(bought, TRANSACTION).when(carted, ADD_TO_CART).otherwise(VIEW).alias("strongest_event_type"),
    )
