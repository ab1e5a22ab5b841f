"""Raw inputs to typed staged datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shoplens.constants import (
    API_SOURCE,
    BATCH_FEED,
    BATCH_SOURCE,
    DELTA_FEED,
    EVENT_SOURCE,
    SELECTED_PROPERTIES,
)
from shoplens.functions.values import instant, root_flag, text_or_null, whole_number


def _lineage(value: str | Column | None) -> Column:
    if value is None:
        return text_or_null()
    return F.lit(value) if isinstance(value, str) else value


def file_of_row() -> Column:
    """Lineage column for file sources: the file a row came from."""
    return F.col("_metadata.file_path")


def stage_events(raw: DataFrame, source_file: str | Column | None = None, source_system: str = EVENT_SOURCE) -> DataFrame:
    stamp = F.col("timestamp").cast("bigint")
    return raw.select(
        stamp.alias("event_timestamp_ms"),
        instant(stamp).alias("event_datetime"),
        F.col("visitorid").cast("bigint").alias("visitor_id"),
        F.col("event").cast("string").alias("event_type"),
        F.col("itemid").cast("bigint").alias("item_id"),
        whole_number(F.col("transactionid").cast("string")).alias("transaction_id"),
        F.lit(source_system).alias("_source_system"),
        _lineage(source_file).alias("_source_file"),
    )


def stage_category_tree(raw: DataFrame, source_file: str | Column | None = None, source_system: str = EVENT_SOURCE) -> DataFrame:
    return raw.select(
        F.col("categoryid").cast("bigint").alias("category_id"),
        whole_number(F.col("parentid").cast("string")).alias("parent_category_id"),
        root_flag("parentid").alias("is_root_category"),
        F.lit(source_system).alias("_source_system"),
        _lineage(source_file).alias("_source_file"),
    )


def _typed_properties(raw: DataFrame, feed: str, source_system: str, source_file: str | Column | None) -> list[Column]:
    stamp = F.col("timestamp").cast("bigint")
    columns = [
        stamp.alias("property_timestamp_ms"),
        instant(stamp).alias("property_datetime"),
        F.col("itemid").cast("bigint").alias("item_id"),
        F.col("property").cast("string").alias("property_name"),
        F.col("value").cast("string").alias("property_value"),
        F.lit(feed).alias("source_feed"),
        F.lit(source_system).alias("source_system"),
        _lineage(source_file).alias("source_file"),
    ]
    if "seq" in raw.columns:
        columns.append(F.col("seq"))
    return columns


def stage_properties_batch(raw: DataFrame, source_file: str | Column | None = None, source_system: str = BATCH_SOURCE) -> DataFrame:
    """Batch feed, reduced to the two properties used downstream."""
    return raw.where(F.col("property").isin(*SELECTED_PROPERTIES)).select(
        *_typed_properties(raw, BATCH_FEED, source_system, source_file)
    )


def stage_properties_delta(raw: DataFrame, source_file: str | Column | None = None, source_system: str = API_SOURCE) -> DataFrame:
    """Delta feed, every property and every landed row kept."""
    stamp = F.col("ingestion_timestamp").cast("string") if "ingestion_timestamp" in raw.columns else text_or_null()
    return raw.select(
        *_typed_properties(raw, DELTA_FEED, source_system, source_file),
        stamp.alias("ingestion_timestamp"),
    )


def combine_properties(batch: DataFrame, delta: DataFrame) -> DataFrame:
    """Both feeds, no deduplication; batch rows have no ingestion stamp."""
    return batch.withColumn("ingestion_timestamp", text_or_null()).unionByName(delta, allowMissingColumns=True)
