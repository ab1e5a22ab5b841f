"""Fit and evaluate a recommender; models, metrics and examples are tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window as W, functions as F

from shoplens.constants import (
    CONTENT_EXAMPLE_ROWS,
    CONTENT_KEY,
    CONTENT_NAME,
    CONTENT_TYPE,
    EXAMPLE_TOP_K,
    EXAMPLE_USERS,
    POPULARITY_KEY,
    POPULARITY_NAME,
    POPULARITY_TYPE,
    TEST_WINDOW_DAYS,
    TOP_K,
)
from shoplens.functions.values import instant
from shoplens.operators.rollup import train_pairs
from shoplens.plans import content, popularity
from shoplens.plans.evaluation import catalog_coverage, ranking_metrics, recommendation_outcomes
from shoplens.plans.split import (
    CONTENT_RULE,
    POPULARITY_RULE,
    Window,
    find_window,
    scattered,
    seen_by,
    split_pairs,
    test_targets,
)
from shoplens.session import materialise


@dataclass(frozen=True)
class Training:
    """What a training run leaves behind. ``model`` is what serving reads."""

    key: str
    window: Window
    model: DataFrame
    metrics: DataFrame
    summary: DataFrame
    examples: DataFrame
    all_scores: DataFrame


def _one(df: DataFrame, value) -> F.Column:
    return df.agg(value).scalar()


def train_popularity(
    interactions: DataFrame,
    metadata: DataFrame,
    k: int = TOP_K,
    test_days: int = TEST_WINDOW_DAYS,
    sample_users: int | None = None,
    n: int | None = None,
) -> Training:
    """``interactions``: user_id, item_id, event_type, event_timestamp_ms.

    All users are evaluated and all items saved, unless the caller names a
    number of users to sample or of items to keep.
    """
    window = find_window(interactions, test_days)
    split = materialise(split_pairs(interactions, window, POPULARITY_RULE), "split")
    ranked = popularity.rank_items(popularity.score_items(split, metadata))
    targets = materialise(test_targets(split, POPULARITY_RULE, sample_users), "targets")
    seen = seen_by(split, targets)
    metrics = ranking_metrics(popularity.filtered_positions(targets, seen, ranked, k), k)
    model = ranked if n is None else ranked.where(F.col("rank") <= n)

    n_items = _one(ranked, F.count("*"))
    n_saved = n_items if n is None else F.least(F.lit(n), n_items)
    summary = metrics.select(
        F.lit(POPULARITY_NAME).alias("model_name"),
        F.lit(POPULARITY_TYPE).alias("model_type"),
        F.lit(k).alias("top_k"),
        F.lit(test_days).alias("test_window_days"),
        F.lit(sample_users).cast("int").alias("evaluation_sample_users"),
        F.lit(window.min_ms).alias("min_timestamp_ms"),
        F.lit(window.max_ms).alias("max_timestamp_ms"),
        F.lit(window.cutoff_ms).alias("cutoff_timestamp_ms"),
        instant(F.lit(window.min_ms)).alias("min_event_datetime"),
        instant(F.lit(window.max_ms)).alias("max_event_datetime"),
        F.coalesce(_one(split, F.sum("train_events")), F.lit(0)).alias("train_event_count"),
        F.coalesce(_one(split, F.sum("test_events")), F.lit(0)).alias("test_event_count"),
        n_items.alias("train_distinct_items"),
        n_saved.alias("model_saved_item_count"),
        catalog_coverage(n_saved, n_items).alias("model_item_coverage"),
        _one(targets, F.count("*")).alias("test_target_users"),
        *metrics.columns,
    )
    return Training(POPULARITY_KEY, window, model, metrics, summary, popularity_examples(targets, seen, ranked), ranked)


def popularity_examples(
    targets: DataFrame, seen: DataFrame, ranked: DataFrame, users: int = EXAMPLE_USERS, k: int = EXAMPLE_TOP_K
) -> DataFrame:
    """Top k for the first sampled users, with target and hit flag."""
    sample = targets.orderBy(*scattered()).limit(users)
    lists = popularity.recommend(sample, seen, ranked, k)
    return lists.join(F.broadcast(sample.select("user_id", "target_item_id")), "user_id").select(
        "user_id", "recommendation_rank", "item_id", "target_item_id",
        (F.col("item_id") == F.col("target_item_id")).alias("is_hit"),
        "popularity_score", "train_event_count", "train_unique_users", "train_addtocart_events",
        "train_transaction_events", "category_id", "parent_category_id", "is_available",
    )


def train_content(
    interactions: DataFrame,
    metadata: DataFrame,
    k: int = TOP_K,
    test_days: int = TEST_WINDOW_DAYS,
    sample_users: int | None = None,
    n: int | None = None,
) -> Training:
    window = find_window(interactions, test_days)
    split = materialise(split_pairs(interactions, window, CONTENT_RULE), "split")
    model = materialise(content.candidate_items(split, metadata, n), "candidates")
    if model.isEmpty():
        raise ValueError("no candidate items: the train window is empty")
    targets = materialise(test_targets(split, CONTENT_RULE, sample_users), "targets")
    history = seen_by(split, targets)
    lists = materialise(
        content.recommend(targets, train_pairs(split), metadata, model, k, None, content.EVALUATION_TIES), "content-lists"
    )
    metrics = ranking_metrics(recommendation_outcomes(targets, lists), k)
    summary = metrics.select(
        F.lit(CONTENT_NAME).alias("model_name"),
        F.lit(CONTENT_TYPE).alias("model_type"),
        F.lit(k).alias("top_k"),
        F.lit(test_days).alias("test_window_days"),
        F.lit(sample_users).cast("int").alias("evaluation_sample_users"),
        F.lit(window.min_ms).alias("min_timestamp_ms"),
        F.lit(window.max_ms).alias("max_timestamp_ms"),
        F.lit(window.cutoff_ms).alias("cutoff_timestamp_ms"),
        _one(model, F.count("*")).alias("candidate_item_count"),
        _one(targets, F.count("*")).alias("test_target_users"),
        _one(history, F.count_distinct("user_id")).alias("user_profile_count"),
        *metrics.columns,
    )
    return Training(CONTENT_KEY, window, model, metrics, summary, content_examples(targets, lists), model)


def content_examples(
    targets: DataFrame, lists: DataFrame, rows: int = CONTENT_EXAMPLE_ROWS, k: int = EXAMPLE_TOP_K
) -> DataFrame:
    """Top k of users in id order, no further user once ``rows`` rows exist.

    Every user adds a row, so the first ``rows`` users are enough to look at.
    """
    heads = lists.where(F.col("recommendation_rank") <= k)
    sample = heads.groupBy("user_id").agg(F.count("*").alias("_rows")).orderBy("user_id").limit(rows)
    before = W.orderBy("user_id").rowsBetween(W.unboundedPreceding, -1)
    chosen = sample.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).where(
        F.col("_before") < rows
    )
    return (
        heads.join(F.broadcast(chosen.select("user_id")), "user_id", "left_semi")
        .join(targets.select("user_id", "target_item_id"), "user_id")
        .select(
            "user_id", "item_id", "content_score", "category_score", "parent_category_score", "metadata_score",
            "conversion_score", "popularity_prior", "category_id", "parent_category_id", "is_available",
            "train_event_count", "train_interaction_score", "recommendation_rank", "target_item_id",
            (F.col("item_id") == F.col("target_item_id")).alias("is_hit"),
        )
    )
