"""Ranking metrics over (evaluated, position) outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shoplens.functions.scores import discounted_gain


def _per(value: Column, count: Column) -> Column:
    return F.when(count > 0, value / count).otherwise(0.0)


def ranking_metrics(outcomes: DataFrame, k: int) -> DataFrame:
    """One row; all zeros when nobody was evaluated.

    Each user has one target, so recall equals hit rate; precision counts k
    slots per user even when fewer items were left to recommend.
    """
    hit = F.col("evaluated") & F.col("position").isNotNull()
    totals = outcomes.agg(
        F.count_if("evaluated").alias("evaluated_users"),
        F.count_if(hit).alias("hits"),
        F.coalesce(F.sum(F.when(hit, discounted_gain("position"))), F.lit(0.0)).alias("_gain"),
    )
    users, hits = F.col("evaluated_users"), F.col("hits").cast("double")
    return totals.select(
        "evaluated_users",
        "hits",
        _per(hits, users).alias(f"hit_rate_at_{k}"),
        _per(hits, users * k).alias(f"precision_at_{k}"),
        _per(hits, users).alias(f"recall_at_{k}"),
        _per(F.col("_gain"), users).alias(f"ndcg_at_{k}"),
    )


def recommendation_outcomes(targets: DataFrame, recommendations: DataFrame) -> DataFrame:
    """Outcomes from explicit top-k lists: evaluated means a non-empty list."""
    lists = recommendations.select("user_id", "item_id", "recommendation_rank")
    return (
        targets.select("user_id", "target_item_id")
        .join(lists, "user_id", "left")
        .groupBy("user_id", "target_item_id")
        .agg(
            F.max(F.col("item_id").isNotNull()).alias("evaluated"),
            F.min(F.when(F.col("item_id") == F.col("target_item_id"), F.col("recommendation_rank"))).alias("position"),
        )
    )


def catalog_coverage(saved_items: str | Column, train_items: str | Column) -> Column:
    saved = F.col(saved_items) if isinstance(saved_items, str) else saved_items
    items = F.col(train_items) if isinstance(train_items, str) else train_items
    return F.when(items > 0, F.least(saved, items) / items).otherwise(0.0)
