"""Staged datasets to curated datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shoplens.constants import CURATED_UNKNOWN_WEIGHT
from shoplens.functions.scores import event_weight
from shoplens.functions.values import flag, instant, match_flag
from shoplens.operators.rollup import item_rollup, pair_rollup

METADATA = (
    "category_id", "parent_category_id", "is_available", "available_raw_value",
    "has_category_metadata", "has_availability_metadata",
)


def item_metadata(category_latest: DataFrame, availability_latest: DataFrame, tree: DataFrame) -> DataFrame:
    """One row per item with any metadata: category, parent, availability.

    The tree is joined here, on items, and not on events: the dimension is
    small, and NULL categories never meet a fact-sized join.
    """
    parents = tree.select("category_id", "parent_category_id")
    categories = (
        category_latest.select("item_id", "category_id", F.lit(1).alias("has_category_metadata"))
        .join(parents, "category_id", "left")
    )
    availability = availability_latest.select(
        "item_id", "is_available", "available_raw_value", F.lit(1).alias("has_availability_metadata")
    )
    return categories.join(availability, "item_id", "full").select("item_id", *METADATA)


def with_metadata(rows: DataFrame, metadata: DataFrame) -> DataFrame:
    """Left join on item_id; the has_* flags are 0 where nothing matched.

    Left to the planner: a small dimension is broadcast by its measured size,
    otherwise AQE splits the partition of a hot item.
    """
    joined = rows.join(metadata, "item_id", "left")
    for name in ("has_category_metadata", "has_availability_metadata"):
        joined = joined.withColumn(name, F.coalesce(F.col(name), F.lit(0)))
    return joined


def curated_interactions(events: DataFrame, metadata: DataFrame) -> DataFrame:
    facts = events.select(
        F.col("visitor_id").alias("user_id"),
        "item_id",
        "event_type",
        "event_timestamp_ms",
        "event_datetime",
        "transaction_id",
        event_weight("event_type", CURATED_UNKNOWN_WEIGHT).alias("interaction_weight"),
    )
    return with_metadata(facts, metadata).select(*facts.columns, *METADATA)


def as_interactions(events: DataFrame) -> DataFrame:
    """The columns of staged events that aggregates need."""
    return events.select(F.col("visitor_id").alias("user_id"), "item_id", "event_type", "event_timestamp_ms")


def event_pairs(events: DataFrame) -> DataFrame:
    return pair_rollup(as_interactions(events), CURATED_UNKNOWN_WEIGHT)


def curated_items(pairs: DataFrame, metadata: DataFrame) -> DataFrame:
    items = item_rollup(pairs)
    return with_metadata(items, metadata).select(
        *items.columns,
        instant("first_event_timestamp_ms").alias("first_event_datetime"),
        instant("last_event_timestamp_ms").alias("last_event_datetime"),
        *METADATA,
    )


def curated_user_items(pairs: DataFrame, metadata: DataFrame) -> DataFrame:
    """Pairs with metadata, which depends on the item only, joined after aggregation."""
    return with_metadata(pairs, metadata).select(
        *pairs.columns,
        instant("first_event_timestamp_ms").alias("first_event_datetime"),
        instant("last_event_timestamp_ms").alias("last_event_datetime"),
        "category_id",
        "parent_category_id",
        "is_available",
        "has_category_metadata",
        "has_availability_metadata",
        flag(F.col("transaction_count") > 0).alias("has_transaction"),
        flag(F.col("addtocart_count") > 0).alias("has_addtocart"),
    )


def metadata_coverage(events: DataFrame, category_latest: DataFrame, availability_latest: DataFrame) -> DataFrame:
    """How many distinct event items have a category, and an availability."""
    items = events.select("item_id").distinct()
    category = category_latest.select("item_id", F.col("item_id").alias("_category_item"))
    availability = availability_latest.select("item_id", F.col("item_id").alias("_availability_item"))
    return (
        items.join(category, "item_id", "left")
        .join(availability, "item_id", "left")
        .agg(
            F.count("*").alias("event_distinct_items"),
            F.coalesce(F.sum(match_flag("_category_item")), F.lit(0)).alias("items_with_category"),
            F.coalesce(F.sum(match_flag("_availability_item")), F.lit(0)).alias("items_with_availability"),
        )
    )
