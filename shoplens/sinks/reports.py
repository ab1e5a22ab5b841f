"""Report files and per-model report tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from shoplens.operators.merge import replace_by_key
from shoplens.session import delete_path, path_exists, publish_path


def write_csv_report(df: DataFrame, path: str) -> None:
    """A small result as one CSV file with header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_model_report(df: DataFrame, path: str, key: str = "model_key") -> None:
    """Recommendations of any size: only this model's partition is replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def read_model_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def merge_csv_report(current: DataFrame, path: str, value: str, key: str = "model_key") -> DataFrame:
    """Replace one model's rows in a small CSV report.

    The merged report is written beside the old one and takes its name when it
    is whole. After a failure in between, one of the two is still there: the
    old one under its name, or the new one as ``<name>.merged-<run>``.
    """
    spark = current.sparkSession
    existing = spark.read.option("header", True).csv(path) if path_exists(spark, path) else None
    text = current.select(*[F.col(name).cast("string").alias(name) for name in current.columns])
    pending = f"{path.rstrip('/')}.merged-{uuid.uuid4().hex}"
    write_csv_report(replace_by_key(existing, text, key, value), pending)
    if existing is not None:
        delete_path(spark, path)
    publish_path(spark, pending, path)
    return spark.read.option("header", True).csv(path)
