"""Rendezvous hashing of record keys over weighted shards.

Every (key, shard) pair has a uniform number u from a hash, and the record
goes to the shard with the least -ln(u) / weight.  A shard so gets rows in
proportion to its weight, and since no number of another shard changes when
one is added, a new shard takes rows into itself only: about its share of
the total weight.

A null key is a key like any other, so all rows without a key share a shard;
null text has no bytes.  Equal keys, and repeated rows, go to the same shard
and get slots of their own.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from llm.common import documents, numbered


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard of ``key``: an int from 0 to len(weights) - 1; weight 0 gets nothing."""
    if not any(weight > 0 for weight in weights):
        raise ValueError("at least one weight must be above 0")

    def cost(shard: int, weight: float) -> Column:
        # 53 bits of the hash, in the open interval from 0 to 1
        u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
        return F.struct((-F.log(u) / F.lit(float(weight))).alias("cost"), F.lit(shard).alias("shard"))

    costs = [cost(shard, weight) for shard, weight in enumerate(weights) if weight > 0]
    best = F.least(*costs) if len(costs) > 1 else costs[0]
    return best["shard"].cast("int")


def shards(docs: DataFrame, weights: Sequence[float], grown: float | None = 1.0) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row.

    ``slot`` counts from 0 inside a shard, in the order of doc_id and text
    checksum, found from sizes of sorted partitions: no task has a whole
    shard.  ``grown_shard`` is the shard after one of weight ``grown`` is
    added.  The texts are read once and never shuffled.
    """
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = documents(docs).select(
        "doc_id",
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(F.col("doc_id"), weights).alias("shard"),
        rendezvous(F.col("doc_id"), [*weights, grown]).alias("grown_shard") if grown
        else F.lit(None).cast("int").alias("grown_shard"),
    )
    return numbered(rows, [F.col("doc_id"), F.col("text_crc32"), F.col("size")], ["shard"], "slot").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
