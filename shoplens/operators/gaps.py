"""The first places of a gapless ranking that a user has not taken, from the gaps between those taken."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

#: Ranks of one block; a block's taken ranks are one array.
BLOCK = 1024


def first_free_ranks(users: DataFrame, taken: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """user_id, rank, recommendation_rank: for each of ``users`` the first ``k`` ranks not in ``taken`` (user_id, rank).

    Before a rank r of which i ranks up to r are taken, r - i are free; so the
    gaps that hold the first k follow from a running count. The counting is
    done in two steps: taken ranks are gathered in blocks, before and after
    the shuffle, and a window runs over a user's blocks only. A user who has
    taken very many ranks so has one row for every ``block`` of them, and no
    user has more than k rows in the result. Repeated rows of ``taken`` count
    once. The ranking has no end here: join the result to it.
    """
    blocks = taken.groupBy("user_id", F.floor((F.col("rank") - 1) / block).alias("_block")).agg(
        F.sort_array(F.collect_set(F.col("rank").cast("bigint"))).alias("_ranks"))
    # rows of other users go here, after the grouping; the planner pushes a small set of users below it
    blocks = blocks.join(users.select("user_id"), "user_id", "left_semi")
    per_user = Window.partitionBy("user_id").orderBy("_block")
    earlier = per_user.rowsBetween(Window.unboundedPreceding, -1)
    regions = users.select("user_id").join(blocks, "user_id", "left").select(
        "user_id",
        F.coalesce("_ranks", F.array().cast("array<bigint>")).alias("_ranks"),
        (F.coalesce(F.lag("_block").over(per_user) + 1, F.lit(0)) * block).alias("_low"),
        F.when(F.lead("_block").over(per_user).isNotNull(), (F.col("_block") + 1) * block).alias("_high"),
        F.coalesce(F.sum(F.size("_ranks")).over(earlier), F.lit(0)).alias("_taken"),
    ).where(F.col("_low") - F.col("_taken") < k)
    # each gap: what it comes after, where it ends (null: nowhere), and how many ranks are free before it
    gaps = F.transform(F.concat(F.array("_low"), F.col("_ranks")), lambda after, place: F.struct(
        after.alias("after"), F.coalesce(F.get("_ranks", place) - 1, F.col("_high")).alias("upto"),
        (after - F.col("_taken") - place).alias("free")))
    wanted = F.filter(gaps, lambda gap: (gap["free"] < k) & (gap["upto"].isNull() | (gap["upto"] > gap["after"])))
    return (
        regions.select("user_id", F.inline(wanted))
        .select("user_id", "after", "free", F.explode(F.sequence(
            F.col("after") + 1, F.least(F.col("upto"), F.col("after") + F.lit(k) - F.col("free")))).alias("rank"))
        .select("user_id", "rank", (F.col("free") + F.col("rank") - F.col("after")).cast("int").alias("recommendation_rank"))
    )
