"""Order-insensitive content fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: The fingerprint of no rows.
EMPTY_FINGERPRINT = "0:0"


def fingerprint_columns(names: list[str]) -> tuple[Column, Column]:
    """Row count and fingerprint as aggregates.

    The fingerprint joins the xor and the sum of the row hashes. The sum keeps
    duplicate rows from cancelling out; both can be partially aggregated.
    Columns are hashed in name order, so their order does not matter either.
    """
    row_hash = F.xxhash64(*[F.col(name) for name in sorted(names)])
    total = F.sum(row_hash.cast("decimal(20,0)"))
    return (
        F.count(F.lit(1)),
        F.concat_ws(
            ":",
            F.hex(F.coalesce(F.bit_xor(row_hash), F.lit(0))),
            F.coalesce(total, F.lit(0).cast("decimal(30,0)")).cast("string"),
        ),
    )


def fingerprint(df: DataFrame) -> DataFrame:
    rows, mark = fingerprint_columns(df.columns)
    return df.agg(rows.alias("row_count"), mark.alias("fingerprint"))
