"""Connected components of a table of links, by joins and small stars.

Each round joins every node to the least node near it and rewires the links
to that (large star, then small star), so long chains halve; hubs are handled
by joins whose hot side Spark can split, never by a group in one task.  Every
round is stored, which cuts lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from llm.common import materialise


def _least(pairs: DataFrame) -> DataFrame:
    """(u, least): the least of u and its partners v."""
    return pairs.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, component): every node of a link, with the least node it can reach.

    Links with a null end are ignored; a link from a node to itself makes it
    a node.  Raises if ``most_rounds`` are not enough.
    """
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull()).distinct()
    pairs = materialise(pairs, "links")
    nodes = pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct()
    stars = pairs.where("u > v")
    for _ in range(most_rounds):
        # large star: partners greater than u move to the least near u
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        # small star: lesser partners of u, and u, move to the least of them
        large = materialise(large.distinct(), "large-star")
        near = _least(large)
        small = large.join(near, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).where("u > v").union(
            near.select("u", F.col("least").alias("v")).where("u > v")).distinct()
        small = materialise(small, "small-star")
        if not _moves(small):
            return nodes.join(small.select(F.col("u").alias("node"), F.col("v").alias("_root")), "node", "left").select(
                "node", F.coalesce("_root", "node").alias("component"))
        stars = small
    raise RuntimeError(f"links not resolved in {most_rounds} rounds")


def _moves(stars: DataFrame) -> bool:
    """Whether any node has two partners, or hangs on a node that hangs on another."""
    many = stars.groupBy("u").agg(F.count("*").alias("n")).where("n > 1")
    chained = stars.join(stars.select(F.col("u").alias("w")), F.col("v") == F.col("w"), "left_semi")
    return not (many.isEmpty() and chained.isEmpty())
