"""Source files with explicit schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from shoplens.schemas import CATEGORY_TREE_CSV, EVENTS_CSV, ITEM_PROPERTIES_CSV


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names in the order of the file; all files of a folder must agree, which reading checks."""
    return spark.read.option("header", True).csv(path).columns


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The columns of ``schema``, found by their header names in any order.

    Other columns of the file are left out. A column that the file lacks, or
    a file with another header than the first, is an error.
    """
    header = csv_header(spark, path)
    missing = [name for name in schema.names if name not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; its header is {', '.join(header)}")
    known = {field.name: field for field in schema.fields}
    in_file = StructType([known.get(name, StructField(name, StringType())) for name in header])
    return spark.read.schema(in_file).option("header", True).option("enforceSchema", False).csv(path).select(*schema.names)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, EVENTS_CSV)


def read_item_properties(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, ITEM_PROPERTIES_CSV)


def read_category_tree(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, CATEGORY_TREE_CSV)


def read_json_array(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Files that each hold one JSON array of records."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_columns(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A Parquet dataset, only the named columns."""
    return spark.read.parquet(path).select(*columns)


def users_from(spark: SparkSession, ids: list[int]) -> DataFrame:
    """A short list of user ids as a table; larger sets are tables already."""
    return spark.createDataFrame([(user,) for user in ids], "user_id bigint")
