"""Batch recommendations for any number of users, in one output schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shoplens.constants import (
    ACTIVE_USER_LIMIT,
    CONTENT_KEY,
    CONTENT_NAME,
    CONTENT_TYPE,
    CONTENT_UNKNOWN_WEIGHT,
    POPULARITY_KEY,
    POPULARITY_NAME,
    POPULARITY_TYPE,
    SERVING_TOP_K,
)
from shoplens.operators.rollup import pair_rollup
from shoplens.plans import content, popularity
from shoplens.schemas import RECOMMENDATION_COLUMNS


def active_users(users: DataFrame, limit: int = ACTIVE_USER_LIMIT) -> DataFrame:
    """Users with a cart or a purchase, highest interaction score first."""
    return (
        users.where((F.col("addtocart_events") > 0) | (F.col("transaction_events") > 0))
        .orderBy(F.col("total_interaction_score").desc(), F.col("total_events").desc(), F.col("user_id").asc())
        .limit(limit)
        .select("user_id", "total_interaction_score", "total_events")
    )


def full_history(interactions: DataFrame) -> DataFrame:
    """Every pair of the whole history with its content weight."""
    return pair_rollup(interactions, CONTENT_UNKNOWN_WEIGHT).select(
        "user_id", "item_id", F.col("interaction_score").alias("weight")
    )


def _in_common_schema(rows: DataFrame, key: str, name: str, kind: str, score: Column, popularity_column: str) -> DataFrame:
    known = rows.withColumns({
        "model_key": F.lit(key),
        "model_name": F.lit(name),
        "model_type": F.lit(kind),
        "recommendation_score": score,
        "popularity_score": F.col(popularity_column),
        "was_seen_before": F.lit(False),
    })
    return known.select(*[
        (F.col(column) if column in known.columns else F.lit(None)).cast(kind_).alias(column)
        for column, kind_ in RECOMMENDATION_COLUMNS
    ])


def recommend_popularity(users: DataFrame, history: DataFrame, model: DataFrame, k: int = SERVING_TOP_K, n: int | None = None) -> DataFrame:
    rows = popularity.recommend(users, history, model, k, n)
    return _in_common_schema(
        rows, POPULARITY_KEY, POPULARITY_NAME, POPULARITY_TYPE, F.col("popularity_score"), "popularity_score"
    )


def recommend_content(
    users: DataFrame, history: DataFrame, metadata: DataFrame, model: DataFrame, k: int = SERVING_TOP_K, n: int | None = None
) -> DataFrame:
    rows = content.recommend(users, history, metadata, model, k, n, content.SERVING_TIES)
    return _in_common_schema(
        rows, CONTENT_KEY, CONTENT_NAME, CONTENT_TYPE, F.col("content_score"), "global_content_prior_score"
    )


def inference_summary(
    key: str, users: DataFrame, recommendations: DataFrame, training_summary: DataFrame, artifact: str, k: int, metric_k: int = 10
) -> DataFrame:
    """One row on a recommendation run, with the metrics of its training."""
    counts = recommendations.agg(
        F.count("*").alias("recommendation_rows"), F.count_distinct("item_id").alias("distinct_recommended_items")
    )
    known = training_summary.columns

    def metric(name: str, kind: str) -> Column:
        return (F.col(name) if name in known else F.lit(None)).cast(kind)

    saved = [F.col(name) for name in ("candidate_item_count", "model_saved_item_count") if name in known]
    return training_summary.select(
        F.lit(key).alias("model_key"),
        "model_name",
        "model_type",
        F.lit(artifact).alias("model_artifact_path"),
        users.agg(F.count_distinct("user_id")).scalar().alias("requested_user_count"),
        F.lit(k).alias("top_k"),
        counts.select("recommendation_rows").scalar().alias("recommendation_rows"),
        counts.select("distinct_recommended_items").scalar().alias("distinct_recommended_items"),
        F.coalesce(*saved).cast("bigint").alias("candidate_or_saved_item_count"),
        *[
            metric(f"{name}_at_{metric_k}", "double").alias(f"training_{name}_at_{metric_k}")
            for name in ("hit_rate", "precision", "recall", "ndcg")
        ],
        *[metric(name, "bigint").alias(name) for name in ("train_event_count", "test_event_count", "test_target_users")],
    )
