"""Plain definitions, quadratic on purpose, that the library is compared with."""

from pyspark.sql import DataFrame, functions as F

from shoplens.operators.ranking import top_k_per_key
from shoplens.plans.content import SERVING_TIES, _slots, content_score, tie_order, user_profiles


def recommend_by_pairing(
    users: DataFrame,
    history: DataFrame,
    metadata: DataFrame,
    candidates: DataFrame,
    k: int,
    ties: tuple[tuple[str, bool], ...] = SERVING_TIES,
) -> DataFrame:
    """The definition of the content recommender: every user with every candidate.

    """
    profiles = user_profiles(history, metadata)

    def part(kind: str, key: str, name: str) -> DataFrame:
        return profiles.where(F.col("profile_kind") == kind).select(
            "user_id", F.col("profile_key").alias(key), F.col("profile_share").alias(name)
        )

    scored = (
        users.select("user_id").distinct().crossJoin(_slots(candidates, ties))
        .join(history.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
        .join(part("category", "category_id", "category_score"), ["user_id", "category_id"], "left")
        .join(part("parent_category", "parent_category_id", "parent_category_score"), ["user_id", "parent_category_id"], "left")
        .fillna(0.0, ["category_score", "parent_category_score"])
        .withColumn("content_score", content_score())
    )
    order = [F.col("content_score").desc(), *tie_order(ties)]
    return top_k_per_key(scored, ["user_id"], order, k, "recommendation_rank").drop("slot", "static_score")
