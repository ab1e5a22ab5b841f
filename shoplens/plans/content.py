"""The category-profile recommender."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shoplens.constants import UNKNOWN_CATEGORY
from shoplens.functions.scores import (
    content_prior,
    conversion_score,
    metadata_score,
    popularity_prior,
    profile_match,
    ratio_or_zero,
    settled,
)
from shoplens.operators.ranking import by_key, rank_all, top_k_per_key, top_n
from shoplens.operators.rollup import train_item_stats
from shoplens.plans.curation import with_metadata
from shoplens.session import materialise

# Orders that decide between equal content scores.
EVALUATION_TIES = (
    ("train_interaction_score", False), ("train_event_count", False),
    ("global_content_prior_score", False), ("item_id", True),
)
SERVING_TIES = (("train_event_count", False), ("item_id", False))

# Wider than the rounding of a score, so that a floor never cuts a tie.
FLOOR_SLACK = 1e-8

# Rows of the per-user working table that one task takes: each may become some tens of candidates.
ROWS_PER_TASK = 200_000

# kinds of row in the per-user working table
_CATEGORY, _PARENT, _USER = 1, 2, 3


def candidate_order() -> list[Column]:
    return [
        F.col("global_content_prior_score").desc_nulls_last(),
        F.col("train_event_count").desc_nulls_last(),
        F.col("item_id").asc_nulls_last(),
    ]


def score_candidates(split: DataFrame, metadata: DataFrame) -> DataFrame:
    """Every item of the train window with its content prior."""
    items = with_metadata(train_item_stats(split), metadata)
    unknown, none = F.lit(UNKNOWN_CATEGORY), F.lit(0)
    return items.select(
        "item_id", "train_event_count", "train_unique_users", "train_view_events", "train_addtocart_events",
        "train_transaction_events", "train_interaction_score",
        F.coalesce("category_id", unknown).alias("category_id"),
        F.coalesce("parent_category_id", unknown).alias("parent_category_id"),
        F.coalesce("is_available", none).alias("is_available"),
        "has_category_metadata", "has_availability_metadata",
        ratio_or_zero("train_addtocart_events", "train_event_count").alias("addtocart_rate"),
        ratio_or_zero("train_transaction_events", "train_event_count").alias("transaction_rate"),
    ).withColumn(
        "global_content_prior_score",
        content_prior("train_interaction_score", "addtocart_rate", "transaction_rate", "is_available"),
    )


def candidate_items(split: DataFrame, metadata: DataFrame, n: int | None = None) -> DataFrame:
    """The saved model: all items, or the ``n`` with the highest prior."""
    scored = score_candidates(split, metadata)
    return scored if n is None else top_n(scored, candidate_order(), n)


def _categorised(history: DataFrame, metadata: DataFrame) -> DataFrame:
    """History rows with the item's category and parent, -1 where unknown."""
    unknown = F.lit(UNKNOWN_CATEGORY)
    categories = metadata.select("item_id", "category_id", "parent_category_id")
    return history.join(categories, "item_id", "left").select(
        "user_id",
        "item_id",
        "weight",
        F.coalesce("category_id", unknown).alias("category_id"),
        F.coalesce("parent_category_id", unknown).alias("parent_category_id"),
    )


def user_profiles(history: DataFrame, metadata: DataFrame) -> DataFrame:
    """Weight and share of every category and parent category per user.

    ``history``: one row per user and item with its weight. Columns: user_id,
    profile_kind (category | parent_category), profile_key, profile_weight,
    profile_share.
    """
    # a row per user and category first, so that rows of pairs are not repeated for the two kinds
    sums = _categorised(history, metadata).groupBy("user_id", "category_id", "parent_category_id").agg(F.sum("weight").alias("weight"))
    rows = sums.select(
        "user_id",
        F.inline(
            F.array(
                F.struct(F.lit("category").alias("profile_kind"), F.col("category_id").alias("profile_key"), "weight"),
                F.struct(
                    F.lit("parent_category").alias("profile_kind"),
                    F.col("parent_category_id").alias("profile_key"),
                    "weight",
                ),
            )
        ),
    )
    totals = Window.partitionBy("user_id", "profile_kind")
    return (
        rows.groupBy("user_id", "profile_kind", "profile_key")
        .agg(F.sum("weight").alias("profile_weight"))
        .withColumn("_total", F.sum("profile_weight").over(totals))
        .withColumn("profile_share", share("profile_weight", "_total"))
        .drop("_total")
    )


def share(weight: str, total: str) -> Column:
    """weight / total; the weight itself when the total is not positive."""
    return F.when(F.col(total) > 0, F.col(weight) / F.col(total)).otherwise(F.col(weight))


def static_score() -> Column:
    """The part of the content score that is the same for every user."""
    return settled(F.col("metadata_score") + F.col("conversion_score") + F.col("popularity_prior"))


def content_score(static: str = "static_score") -> Column:
    return settled(profile_match("category_score", "parent_category_score") + F.col(static))


def tie_order(ties: tuple[tuple[str, bool], ...]) -> list[Column]:
    return [F.col(name).asc_nulls_last() if ascending else F.col(name).desc_nulls_last() for name, ascending in ties]


def _slots(candidates: DataFrame, ties: tuple[tuple[str, bool], ...]) -> DataFrame:
    """Candidates numbered in the order they would have without a profile."""
    scored = candidates.select(
        "*",
        metadata_score().alias("metadata_score"),
        conversion_score().alias("conversion_score"),
        popularity_prior().alias("popularity_prior"),
    ).withColumn("static_score", static_score())
    order = [F.col("static_score").desc_nulls_last(), *tie_order(ties)]
    return rank_all(scored, order, "slot")


def _working_rows(users: DataFrame, history: DataFrame, metadata: DataFrame, slots: DataFrame) -> DataFrame:
    """Per user: weight and number of seen candidates by category, parent and overall.

    Kinds: a category, a parent category, the whole user. A candidate's
    stored category may differ from the item's current one; profiles use the
    current one, seen counts the stored one.
    """
    stored = slots.select(
        "item_id", "slot", F.col("category_id").alias("_stored_category"),
        F.col("parent_category_id").alias("_stored_parent"),
    )
    # a row per user and category, before any row is repeated for its kinds; a small set of users is pushed below
    rows = (
        _categorised(history, metadata)
        .join(stored, "item_id", "left")
        .groupBy("user_id", "category_id", "parent_category_id", "_stored_category", "_stored_parent")
        .agg(F.sum(F.col("weight").cast("double")).alias("weight"), F.count("slot").alias("seen"))
        .join(users, "user_id", "left_semi")
    )

    def row(kind: int, key: Column, weight: Column, seen: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            key.cast("bigint").alias("key"),
            weight.cast("double").alias("weight"),
            seen.cast("bigint").alias("seen"),
        )

    def same(current: str, saved: str) -> Column:
        return F.col(saved).eqNullSafe(F.col(current))

    nothing, none = F.lit(0.0), F.lit(0)
    same_category = same("category_id", "_stored_category")
    same_parent = same("parent_category_id", "_stored_parent")
    has_history, has_seen = F.col("category_id").isNotNull(), F.col("seen") > 0
    return (
        users.join(rows, "user_id", "left")
        .select(
            "user_id",
            F.inline(
                F.array_compact(
                    F.array(
                        row(_USER, F.lit(0), F.coalesce("weight", nothing), F.coalesce("seen", none)),
                        F.when(has_history, row(
                            _CATEGORY, F.col("category_id"), F.col("weight"), F.when(same_category, F.col("seen")).otherwise(none))),
                        F.when(has_history, row(
                            _PARENT, F.col("parent_category_id"), F.col("weight"), F.when(same_parent, F.col("seen")).otherwise(none))),
                        F.when(has_seen & ~same_category, row(_CATEGORY, F.col("_stored_category"), nothing, F.col("seen"))),
                        F.when(has_seen & ~same_parent, row(_PARENT, F.col("_stored_parent"), nothing, F.col("seen"))),
                    )
                )
            ),
        )
        .groupBy("user_id", "kind", "key")
        .agg(F.sum("weight").alias("weight"), F.sum("seen").alias("seen"))
        .where((F.col("weight") > 0) | (F.col("kind") == _USER))
    )


_LIST = ["kind", "key", "parent"]


def _lists(slots: DataFrame) -> DataFrame:
    """Candidates by category, by parent and overall, placed in static order.

    Columns: kind, key, parent (which name a list), place, size, slot,
    static_score. A category's list is split by parent, so that within one
    list all items get the same profile score from a user. At most three rows
    per candidate; no list is numbered in one task.
    """
    category, parent, none = F.col("category_id"), F.col("parent_category_id"), F.lit(0).cast("bigint")

    def entry(kind: int, key: Column, of_parent: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), key.alias("key"), of_parent.alias("parent"))

    listed = slots.select(
        "slot",
        "static_score",
        F.inline(F.array(entry(_CATEGORY, category, parent), entry(_PARENT, parent, parent), entry(_USER, none, none))),
    )
    ranked = rank_all(listed, [*map(F.col, _LIST), F.col("slot")], "_rank")
    bounds = materialise(ranked.groupBy(*_LIST).agg(F.min("_rank").alias("_first"), F.count("*").alias("size")), "list-bounds")
    return ranked.join(bounds, _LIST).select(
        *_LIST, (F.col("_rank") - F.col("_first") + 1).alias("place"), "size", "slot", "static_score"
    )


def _score_floor(rows: DataFrame, places: DataFrame, k: int) -> DataFrame:
    """Adds ``floor``: a score that k unseen candidates of the user reach.

    The first unseen item of a category list stands at place seen + 1 or
    before, so it scores at least what that place scores. Category lists are
    disjoint: the k-th highest of these values is a floor for the k-th best
    recommendation. NULL when fewer than k lists give a value.
    """
    first_unseen = places.select(*_LIST, (F.col("place") - 1).alias("seen"), F.col("static_score").alias("_static"))
    sure = F.when(F.col("kind") == _CATEGORY, F.col("offset") + F.col("_static"))
    per_user = Window.partitionBy("user_id")
    return (
        rows.join(first_unseen, [*_LIST, "seen"], "left")
        .withColumn("_sure", sure)
        .withColumn("_nth", F.row_number().over(per_user.orderBy(F.col("_sure").desc_nulls_last())))
        .withColumn("floor", F.max(F.when(F.col("_nth") == k, F.col("_sure"))).over(per_user))
        .drop("_static", "_sure", "_nth")
    )


def recommend(
    users: DataFrame,
    history: DataFrame,
    metadata: DataFrame,
    candidates: DataFrame,
    k: int,
    n: int | None = None,
    ties: tuple[tuple[str, bool], ...] = SERVING_TIES,
) -> DataFrame:
    """Top k unseen candidates per user, without pairing users and candidates.

    Inside one (category, parent) list a user adds the same profile score to
    every item, so the order is the static one and only its first k + s items
    can be recommended, s being the seen items of that category. The same
    holds for parent lists (items whose category is not in the profile) and
    for the overall list (items the profile does not touch). Their union
    contains the exact top k: an item left out of its list has k unseen items
    before it that score at least as high and win ties. Entries below a score
    that k unseen items are known to reach are dropped before they are
    grouped. Work per user grows with the profile and the history, not with
    the number of candidates.

    No user looks deeper into a list than k places beyond the most items that
    any user has seen of it. Only these places, their candidates and the pairs
    that hold one of them are kept, so that pairs of users and candidates are
    shuffled neither to look places up nor to drop what was seen, and the
    lists of a user are worked off in one task, of about ROWS_PER_TASK rows.

    ``history``: user_id, item_id, weight, one row per pair; its items count
    as seen, and users other than ``users`` do not matter. Candidates are all
    of the table, or its first ``n``. What is reached is stored; the planner
    picks the joins by their size.
    """
    slots = _slots(candidates if n is None else top_n(candidates, candidate_order(), n), ties)
    wanted = users.select("user_id").distinct()
    rows = materialise(_working_rows(wanted, history, metadata, slots), "working")

    deepest = materialise(rows.groupBy("kind", "key").agg((F.max("seen") + k).alias("_deepest")), "depths")
    places = materialise(
        _lists(slots).join(deepest, ["kind", "key"]).where(F.col("place") <= F.col("_deepest")).drop("_deepest"), "places"
    )
    reached = materialise(slots.join(places.select("slot").distinct(), "slot", "left_semi"), "reached")
    seen = materialise(history.join(reached.select("item_id", "slot"), "item_id").select("user_id", "slot"), "seen")
    heads = places.where("place = 1").select(*_LIST, "size", F.col("static_score").alias("top_static"))
    places = places.select(*_LIST, "place", "slot", "static_score")

    per_user = Window.partitionBy("user_id")
    shares = by_key(rows, "user_id", rows_per_task=ROWS_PER_TASK).withColumn(
        "_total", F.max(F.when(F.col("kind") == _USER, F.col("weight"))).over(per_user)
    ).withColumn("share", F.when(F.col("kind").isin(_CATEGORY, _PARENT), share("weight", "_total")))

    is_category = F.col("kind") == _CATEGORY
    of_parent = F.max(F.when(F.col("kind") == _PARENT, F.col("share"))).over(Window.partitionBy("user_id", "parent"))
    listed = (
        shares.join(heads, ["kind", "key"])
        .withColumn("category_share", F.when(is_category, F.col("share")).otherwise(0.0))
        .withColumn("parent_share", F.when(F.col("kind").isin(_CATEGORY, _PARENT), F.coalesce(of_parent, F.lit(0.0))).otherwise(0.0))
        .withColumn("offset", profile_match("category_share", "parent_share"))
    )

    def reaches_floor(static: str) -> Column:
        return F.col("floor").isNull() | (F.col("offset") + F.col(static) >= F.col("floor") - FLOOR_SLACK)

    depth = F.least(F.col("size"), F.lit(k) + F.col("seen"))
    picked = (
        _score_floor(listed, places, k)
        .where(reaches_floor("top_static"))
        .select(
            "user_id", "category_share", "parent_share", "offset", "floor", *_LIST,
            F.explode(F.sequence(F.lit(1).cast("bigint"), depth)).alias("place"),
        )
        .join(places, [*_LIST, "place"])
        .where(reaches_floor("static_score"))
        .groupBy("user_id", "slot")
        .agg(
            F.max("category_share").alias("category_score"),
            F.max("parent_share").alias("parent_category_score"),
        )
        .join(seen, ["user_id", "slot"], "left_anti")
    )
    scored = picked.join(reached, "slot").withColumn("content_score", content_score())
    order = [F.col("content_score").desc(), *tie_order(ties)]
    return top_k_per_key(scored, ["user_id"], order, k, "recommendation_rank").drop("slot", "static_score")
