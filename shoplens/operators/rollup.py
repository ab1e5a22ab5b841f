"""The user x item rollup that every aggregate is built on.

Events are shuffled once, on (user_id, item_id), after map-side partial
aggregation.  Counts per user, counts per item, distinct users per item and
distinct items per user all follow from the pairs, so one popular item or one
busy user never has its raw events in a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shoplens.constants import ADD_TO_CART, INTENT_EVENT_TYPES, TRANSACTION, VIEW
from shoplens.functions.scores import event_weight

PAIR = ("user_id", "item_id")


def _count(kind: str) -> Column:
    return F.count_if(F.col("event_type") == kind)


def pair_rollup(events: DataFrame, unknown_weight: float) -> DataFrame:
    """One row per user and item over the whole history."""
    weight = event_weight("event_type", unknown_weight)
    return events.groupBy(*PAIR).agg(
        F.count("*").alias("total_events"),
        _count(VIEW).alias("view_count"),
        _count(ADD_TO_CART).alias("addtocart_count"),
        _count(TRANSACTION).alias("transaction_count"),
        F.sum(weight).alias("interaction_score"),
        F.max(weight).alias("max_event_weight"),
        F.min("event_timestamp_ms").alias("first_event_timestamp_ms"),
        F.max("event_timestamp_ms").alias("last_event_timestamp_ms"),
    )


def item_rollup(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("item_id").agg(
        F.sum("total_events").alias("total_events"),
        F.count("user_id").alias("unique_users"),
        F.sum("view_count").alias("view_events"),
        F.sum("addtocart_count").alias("addtocart_events"),
        F.sum("transaction_count").alias("transaction_events"),
        F.min("first_event_timestamp_ms").alias("first_event_timestamp_ms"),
        F.max("last_event_timestamp_ms").alias("last_event_timestamp_ms"),
    )


def user_rollup(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("user_id").agg(
        F.sum("total_events").alias("total_events"),
        F.count("item_id").alias("unique_items"),
        F.sum("view_count").alias("view_events"),
        F.sum("addtocart_count").alias("addtocart_events"),
        F.sum("transaction_count").alias("transaction_events"),
        F.sum("interaction_score").alias("total_interaction_score"),
        F.min("first_event_timestamp_ms").alias("first_event_timestamp_ms"),
        F.max("last_event_timestamp_ms").alias("last_event_timestamp_ms"),
    )


def split_rollup(events: DataFrame, is_train: Column, unknown_weight: float) -> DataFrame:
    """One row per user and item with its train part and its test part.

    Holds all that training and evaluation need of the events: item
    statistics, seen items and profile weights from the train columns, target
    candidates from the test columns.
    """
    kind = F.col("event_type")
    stamp = F.col("event_timestamp_ms")
    weight = event_weight("event_type", unknown_weight)
    is_target = ~is_train & kind.isin(*INTENT_EVENT_TYPES)
    return events.groupBy(*PAIR).agg(
        F.count_if(is_train).alias("train_events"),
        F.count_if(is_train & (kind == VIEW)).alias("train_views"),
        F.count_if(is_train & (kind == ADD_TO_CART)).alias("train_carts"),
        F.count_if(is_train & (kind == TRANSACTION)).alias("train_transactions"),
        F.sum(F.when(is_train, weight)).alias("train_weight"),
        F.count_if(~is_train).alias("test_events"),
        F.max(F.when(is_target, weight)).alias("target_weight"),
        F.min(F.when(is_target, stamp)).alias("first_target_ms"),
        F.max(F.when(is_target, stamp)).alias("last_target_ms"),
    )


def train_item_stats(split: DataFrame) -> DataFrame:
    return (
        split.where("train_events > 0")
        .groupBy("item_id")
        .agg(
            F.sum("train_events").alias("train_event_count"),
            F.count("user_id").alias("train_unique_users"),
            F.sum("train_views").alias("train_view_events"),
            F.sum("train_carts").alias("train_addtocart_events"),
            F.sum("train_transactions").alias("train_transaction_events"),
            F.sum("train_weight").alias("train_interaction_score"),
        )
    )


def train_pairs(split: DataFrame) -> DataFrame:
    """Items a user met in the train window, with the weight given to them."""
    return split.where("train_events > 0").select(*PAIR, F.col("train_weight").alias("weight"))
