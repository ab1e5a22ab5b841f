"""The global popularity recommender."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shoplens.constants import HEAD_RANKS
from shoplens.functions.scores import guarded_ratio, popularity_score
from shoplens.operators.gaps import first_free_ranks
from shoplens.operators.ranking import rank_all, top_n
from shoplens.operators.rollup import train_item_stats
from shoplens.plans.curation import with_metadata

ORDER_KEYS = ("popularity_score", "train_interaction_score", "train_unique_users")


def popularity_order() -> list[Column]:
    return [*[F.col(name).desc_nulls_last() for name in ORDER_KEYS], F.col("item_id").asc_nulls_last()]


def score_items(split: DataFrame, metadata: DataFrame) -> DataFrame:
    """Every item of the train window with its score, unranked."""
    items = with_metadata(train_item_stats(split), metadata)
    return items.select(
        "item_id", "train_event_count", "train_unique_users", "train_view_events", "train_addtocart_events",
        "train_transaction_events", "train_interaction_score", "category_id", "parent_category_id",
        "is_available", "has_category_metadata", "has_availability_metadata",
        guarded_ratio("train_addtocart_events", "train_view_events").alias("addtocart_rate"),
        guarded_ratio("train_transaction_events", "train_view_events").alias("transaction_rate"),
        popularity_score(
            "train_interaction_score", "train_unique_users", "train_transaction_events",
            "train_addtocart_events", "is_available",
        ).alias("popularity_score"),
    )


def top_items(scored: DataFrame, n: int) -> DataFrame:
    """The saved model: the first ``n`` items with their rank."""
    return top_n(scored, popularity_order(), n, "rank").withColumn("rank", F.col("rank").cast("bigint"))


def rank_items(scored: DataFrame) -> DataFrame:
    """All items with their rank, for evaluation and for the full score list."""
    return rank_all(scored, popularity_order(), "rank")


def filtered_positions(targets: DataFrame, seen: DataFrame, ranked: DataFrame, k: int) -> DataFrame:
    """Position of each user's target among the items the user has not seen.

    The position is the target's rank minus the number of seen items ranked
    above it. A user with s seen items can only score with a target of rank
    at most k + s, so ranks of seen items are looked up for those users alone.
    Columns: user_id, target_item_id, evaluated, position (NULL beyond k).
    """
    seen_counts = seen.groupBy("user_id").agg(F.count("*").alias("_seen"))
    n_items = ranked.agg(F.count("*")).scalar()
    placed = (
        targets.join(seen_counts, "user_id", "left")
        .join(
            ranked.select(F.col("item_id").alias("target_item_id"), F.col("rank").alias("_target_rank")),
            "target_item_id",
            "left",
        )
        .withColumn("_seen", F.coalesce("_seen", F.lit(0)))
    )
    in_reach = F.col("_target_rank") <= F.lit(k) + F.col("_seen")
    contenders = placed.where(in_reach).select("user_id", "_target_rank")
    ahead = (
        seen.join(contenders, "user_id")
        .join(ranked.select("item_id", "rank"), "item_id")
        .where(F.col("rank") <= F.col("_target_rank"))
        .groupBy("user_id")
        .agg(
            F.count_if(F.col("rank") < F.col("_target_rank")).alias("_ahead"),
            F.max(F.col("rank") == F.col("_target_rank")).alias("_target_seen"),
        )
    )
    position = F.col("_target_rank") - F.coalesce("_ahead", F.lit(0))
    reached = in_reach & ~F.coalesce("_target_seen", F.lit(False)) & (position <= k)
    return placed.join(ahead, "user_id", "left").select(
        "user_id",
        "target_item_id",
        (F.col("_seen") < n_items).alias("evaluated"),
        F.when(reached, position).alias("position"),
    )


def recommend(users: DataFrame, seen: DataFrame, ranked: DataFrame, k: int, n: int | None = None) -> DataFrame:
    """The first k unseen items of the gapless ranking, or of its first ``n`` items, for every user.

    Only (user, rank) travels until each user's k ranks are known, which the
    gaps between the seen ranks tell; then the item columns are joined to
    these. The head of the ranking, which nearly every user needs, is
    broadcast, bounded by HEAD_RANKS; later ranks are needed by few users and
    are shuffled.
    """
    if n is not None:
        ranked = ranked.where(F.col("rank") <= n)
    wanted = users.select("user_id").distinct()
    taken = seen.select("user_id", "item_id").join(ranked.select("item_id", "rank"), "item_id").select("user_id", "rank")
    free = first_free_ranks(wanted, taken, k)
    is_head = F.col("rank") <= HEAD_RANKS
    met = free.where(is_head).join(F.broadcast(ranked.where(is_head)), "rank").unionByName(
        free.where(~is_head).join(ranked.where(~is_head), "rank")
    )
    return met.select("user_id", *(name for name in ranked.columns if name != "rank"), "recommendation_rank")
