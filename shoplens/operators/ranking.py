"""Latest-per-key, bounded and unbounded global ranks, per-group top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shoplens.session import materialise

_POSITION_BITS = 33  # monotonically_increasing_id = (partition << 33) + row


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``.

    Planned as row_number = 1, so each map task keeps one row per key before
    the shuffle (WindowGroupLimit) and a hot key costs one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def top_k_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def by_key(stored: DataFrame, *keys: str, rows_per_task: int) -> DataFrame:
    """The rows of a stored table by ``keys``, in as many tasks as their number asks for.

    A task's memory so stays the same for any input, whatever the session's
    number of shuffle partitions; adaptive execution does not merge them.
    """
    tasks = -(-stored.count() // rows_per_task)
    return stored.repartition(max(1, tasks, stored.sparkSession.sparkContext.defaultParallelism), *keys)


def top_n(df: DataFrame, order: Sequence[Column], n: int, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows; tasks keep ``n`` rows each, then merge.

    The rank is a window over those ``n`` rows only.
    """
    head = df.orderBy(*order).limit(n)
    if rank is None:
        return head
    return head.withColumn(rank, F.row_number().over(Window.orderBy(*order)))


def rank_all(df: DataFrame, order: Sequence[Column], rank: str) -> DataFrame:
    """Rank 1..n over every row without bringing them into one task.

    Range partitioning puts the rows of partition p before those of p+1, the
    row id after an in-partition sort holds (partition, position), and the
    partition sizes, one row per shuffle partition, turn positions into ranks.
    The sorted rows are stored once: partition bounds come from a sample, so
    sizes and positions must be read from the same split. ``order`` must end
    in a unique key.
    """
    placed = materialise(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()),
        "ranked",
    )
    block = F.shiftright("_place", _POSITION_BITS)
    position = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(block.alias("_block"))
        .agg(F.count("*").alias("_size"))
        .select("_block", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    return (
        placed.withColumn("_block", block)
        .join(F.broadcast(starts), "_block")
        .withColumn(rank, F.col("_start") + position + 1)
        .drop("_block", "_start", "_place")
    )
