"""Latest category and latest availability of each item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shoplens.constants import AVAILABILITY_PROPERTY, CATEGORY_PROPERTY
from shoplens.functions.values import availability_flag, whole_number
from shoplens.operators.ranking import first_per_key


def newest_first(df: DataFrame) -> list[Column]:
    """Time, then source name, then sequence if there is one, then value."""
    order = [F.col("property_timestamp_ms").desc_nulls_last(), F.col("source_system").desc_nulls_last()]
    if "seq" in df.columns:
        order.append(F.col("seq").desc_nulls_last())
    return [*order, F.col("property_value").desc_nulls_last()]


def latest_property(properties: DataFrame, name: str) -> DataFrame:
    """The newest row of one property per item; the filter reaches the scan."""
    rows = properties.where(F.col("property_name") == name)
    return first_per_key(rows, ["item_id"], newest_first(rows))


def item_category_latest(properties: DataFrame) -> DataFrame:
    return latest_property(properties, CATEGORY_PROPERTY).select(
        "item_id",
        whole_number("property_value").alias("category_id"),
        F.col("property_timestamp_ms").alias("category_timestamp_ms"),
        F.col("property_datetime").alias("category_datetime"),
        F.col("source_system").alias("_source_system"),
        F.col("source_file").alias("_source_file"),
    )


def item_availability_latest(properties: DataFrame) -> DataFrame:
    return latest_property(properties, AVAILABILITY_PROPERTY).select(
        "item_id",
        F.col("property_value").alias("available_raw_value"),
        availability_flag("property_value").alias("is_available"),
        F.col("property_timestamp_ms").alias("availability_timestamp_ms"),
        F.col("property_datetime").alias("availability_datetime"),
        F.col("source_system").alias("_source_system"),
        F.col("source_file").alias("_source_file"),
    )
