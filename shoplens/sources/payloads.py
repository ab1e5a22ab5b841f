"""Raw API responses: contract detection, validation, normalised records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shoplens.constants import API_SOURCE
from shoplens.schemas import PAYLOAD

DATA_CONTRACT = "data_contract"
# fixed values: the keys of a complete data response
DATA_KEYS = ("success", "data", "count", "total_rows", "unread_rows")
RECORDS_CONTRACT = "records_contract"


def read_payload_text(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Responses as text: one per file, or one per line (splittable)."""
    return spark.read.text(path, wholetext=one_per_file).select(
        F.col("value").alias("body"), F.col("_metadata.file_path").alias("raw_response_file")
    )


def parse_payloads(bodies: DataFrame) -> DataFrame:
    """One row per response with its contract, counters and first problem.

    ``problem`` is NULL for a valid response. Key presence is read from the
    text, so an absent key and a null value stay apart.
    """
    keys = F.coalesce(F.json_object_keys("body"), F.array().cast("array<string>"))
    parsed = bodies.withColumns({"_keys": keys, "_p": F.from_json("body", PAYLOAD)})

    def has(key: str) -> Column:
        return F.array_contains("_keys", key)

    is_data = has("data")
    contract = F.when(is_data, DATA_CONTRACT).when(has("records"), RECORDS_CONTRACT)
    records = F.when(is_data, F.col("_p.data")).when(has("records"), F.col("_p.records"))
    success = F.when(is_data, F.coalesce("_p.success", F.lit(False))).otherwise(F.coalesce("_p.success", F.lit(True)))
    problem = (
        F.when(contract.isNull(), "neither data nor records")
        .when(records.isNull(), F.concat(F.when(is_data, "data").otherwise("records"), F.lit(" is not a list")))
        .when(is_data & ~success, "success is false")
        .when(is_data & (F.col("_p.count") != F.size(records)), "count differs from the number of records")
        .when(~is_data & ~has("next_cursor"), "next_cursor is missing")
        .when(~is_data & ~has("has_more"), "has_more is missing")
    )
    return parsed.select(
        *bodies.columns,
        contract.alias("api_contract"),
        records.alias("records"),
        F.when(is_data, F.coalesce("_p.count", F.size(records).cast("bigint")))
        .otherwise(F.size(records).cast("bigint"))
        .alias("api_count"),
        F.col("_p.total_rows").alias("total_rows"),
        F.col("_p.unread_rows").alias("unread_rows"),
        success.alias("api_success"),
        F.when(~is_data, F.col("_p.next_cursor")).alias("next_cursor"),
        F.when(~is_data, F.col("_p.has_more")).alias("has_more"),
        F.col("_keys").alias("response_keys"),
        problem.alias("problem"),
    )


def normalise_records(payloads: DataFrame, stamp: str | Column, source_system: str = API_SOURCE) -> DataFrame:
    """Records of valid responses, typed and stamped; no records, no rows."""
    run = F.lit(stamp) if isinstance(stamp, str) else stamp
    return (
        payloads.where(F.col("problem").isNull())
        .select(run.alias("ingestion_timestamp"), F.inline("records"))
        .select(
            F.col("timestamp").cast("bigint").alias("timestamp"),
            F.col("itemid").cast("bigint").alias("itemid"),
            "property",
            "value",
            F.lit(source_system).alias("source_system"),
            "ingestion_timestamp",
        )
    )


def require_valid(payloads: DataFrame) -> None:
    """Raise on the first response that breaks its contract."""
    bad = payloads.where(F.col("problem").isNotNull()).select("problem").first()
    if bad is not None:
        raise ValueError(f"API response rejected: {bad['problem']}")
