"""Ranked merges as Spark higher-order functions over the byte arrays of distinct words.

This is the fold of ``bpe.fold_merges`` as column expressions with a literal
rank map, kept beside it so that both can be compared and timed.  A literal
map is searched from end to end, so the ranks are literal buckets of small
maps, chosen by a hash of the key.

Words are distinct binary values; a null or empty word has no ids.  Words of
any length fold, in time that grows with their square.
"""

from __future__ import annotations

import json
import zlib

from pyspark.sql import Column, DataFrame, functions as F

BUCKETS = 1 << 13


def rank_buckets(ranks: dict[bytes, int], buckets: int = BUCKETS) -> list[dict[bytes, int]]:
    """The rank map in buckets by the crc32 of the key."""
    found: list[dict[bytes, int]] = [{} for _ in range(buckets)]
    for piece, rank in ranks.items():
        found[zlib.crc32(piece) % buckets][piece] = rank
    return found


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fold_words(words: DataFrame, ranks: dict[bytes, int], word: str = "word") -> DataFrame:
    """``words`` with ``ids``: the leftmost pair of lowest rank is merged first, until no pair has a rank."""
    text = json.dumps([{piece.hex().upper(): rank for piece, rank in bucket.items()} for bucket in rank_buckets(ranks)])
    literal = F.from_json(F.lit(text), "array<map<string,int>>")  # folded to a literal once

    def rank(piece: Column) -> Column:
        bucket = F.get(literal, F.pmod(F.crc32(piece), F.lit(BUCKETS)).cast("int"))
        return F.try_element_at(bucket, F.hex(piece))

    def merged(pieces: Column, pairs: Column) -> Column:
        least = F.array_min(F.transform(pairs, lambda pair: pair["rank"]))

        def at(k: Column) -> Column:
            size = F.size(pieces)
            return F.concat(
                F.slice(pieces, F.lit(1), k), F.array(F.get(pairs, k)["piece"]),
                F.slice(pieces, k + 3, F.greatest(size - k - 2, F.lit(0))))

        return F.when(least.isNull(), pieces).otherwise(_bound(least, lambda low: _bound(
            (F.array_position(F.transform(pairs, lambda pair: pair["rank"]), low) - 1).cast("int"), at)))

    def step(pieces: Column, _: Column) -> Column:
        size = F.size(pieces)
        pairs = F.zip_with(F.slice(pieces, F.lit(1), size - 1), F.slice(pieces, F.lit(2), size - 1), lambda a, b: F.concat(a, b))
        ranked = F.transform(pairs, lambda piece: F.struct(piece.alias("piece"), rank(piece).alias("rank")))
        return F.when(size < 2, pieces).otherwise(_bound(ranked, lambda found: merged(pieces, found)))

    body = F.col(f"`{word}`")
    size = F.coalesce(F.length(body), F.lit(0))
    places = F.when(size > 0, F.sequence(F.lit(1), size)).otherwise(F.array().cast("array<int>"))
    letters = F.transform(places, lambda place: F.substring(body, place, F.lit(1)))
    whole = rank(body)
    folded = F.aggregate(F.slice(places, 1, F.greatest(size - 1, F.lit(0))), letters, step)
    return words.withColumn("ids", F.when(whole.isNotNull(), F.array(whole)).otherwise(F.transform(folded, rank)))


def join_pieces(words: DataFrame, ranks: dict[bytes, int], ids: str = "ids") -> DataFrame:
    """``words`` with ``decoded``: the binary pieces of the ids, concatenated."""
    pieces = [piece for piece, _ in sorted(ranks.items(), key=lambda pair: pair[1])]
    if [ranks[piece] for piece in pieces] != list(range(len(pieces))):
        raise ValueError("ranks have gaps")
    literal = F.from_json(F.lit(json.dumps([piece.hex() for piece in pieces])), "array<string>")
    return words.withColumn("decoded", F.aggregate(
        F.transform(F.col(ids), lambda i: F.unhex(F.get(literal, i))), F.lit(bytearray()), lambda a, b: F.concat(a, b)))
