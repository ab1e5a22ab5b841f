"""Layer tables: databases, managed tables, views, Parquet folders, inventory."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from shoplens.session import path_exists

LAYERS = ("staged", "curated", "mart", "features")
INVENTORY_SCHEMA = (
    "schema_name string, relation_name string, relation_type string, row_count bigint, column_count int, status string"
)
SUMMARY_SCHEMA = (
    "schema_name string, table_name string, column_name string, ordinal_position int, data_type string, is_nullable string"
)


def reset_layers(spark: SparkSession, layers: Iterable[str] = LAYERS) -> None:
    for layer in layers:
        spark.sql(f"DROP DATABASE IF EXISTS {layer} CASCADE")
        spark.sql(f"CREATE DATABASE {layer}")


def save_table(df: DataFrame, layer: str, name: str, bucket_by: str | None = None, buckets: int = 0) -> DataFrame:
    """Create or replace ``layer.name``.

    With ``bucket_by`` and a number of buckets the table is hash-bucketed and
    sorted, so later joins and aggregates on that key need no shuffle.
    """
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    writer = df.write.mode("overwrite").format("parquet")
    if bucket_by and buckets:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(f"{layer}.{name}")
    return df.sparkSession.table(f"{layer}.{name}")


def create_view(spark: SparkSession, layer: str, name: str, source: str) -> DataFrame:
    """A view over a stored table, all columns by name."""
    columns = ", ".join(f"`{column}`" for column in spark.table(source).columns)
    spark.sql(f"CREATE OR REPLACE VIEW {layer}.{name} AS SELECT {columns} FROM {source}")
    return spark.table(f"{layer}.{name}")


#: Bytes of a row group of keyed tables, and distinct keys that its Bloom filters are made for.
ROW_GROUP_BYTES, GROUP_KEYS = 8 << 20, 50_000


def write_keyed(df: DataFrame, path: str, keys: Sequence[str], row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """A Parquet folder in which a key is found in few row groups.

    Rows are range-partitioned and sorted by the keys, so the least and
    greatest value of a row group leave out nearly all others for the first
    key; Bloom filters do so for keys after the first. Row groups are small,
    as one is the least that a lookup reads.
    """
    order = [F.col(key) for key in keys]
    writer = df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").option(
        "partitionOverwriteMode", "static").option("parquet.block.size", row_group_bytes).option("parquet.bloom.filter.adaptive.enabled", "true")
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true").option(
            f"parquet.bloom.filter.expected.ndv#{key}", GROUP_KEYS)
    writer.parquet(path)


class LayerStore:
    """Datasets as Parquet folders: <root>/<layer>/<name>."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def save(self, df: DataFrame, layer: str, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        path = self.path(layer, name)
        # static: a rerun replaces the whole dataset, not single partitions
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def save_keyed(self, df: DataFrame, layer: str, name: str, keys: Sequence[str]) -> DataFrame:
        """As ``save``, for tables in which single keys are looked up."""
        path = self.path(layer, name)
        write_keyed(df, path, keys)
        return self.spark.read.schema(df.schema).parquet(path)

    def exists(self, layer: str, name: str) -> bool:
        return path_exists(self.spark, f"{self.path(layer, name)}/_SUCCESS")

    def load(self, layer: str, name: str, made_by: str = "the step that builds it") -> DataFrame:
        if not self.exists(layer, name):
            raise FileNotFoundError(f"{self.path(layer, name)} not found: run {made_by} first")
        return self.spark.read.parquet(self.path(layer, name))


def table_inventory(spark: SparkSession, relations: Iterable[tuple[str, str]]) -> DataFrame:
    """Type, row count and column count per relation; a missing one fails.

    All counts are one job over a union of aggregates.
    """
    parts = []
    for layer, name in relations:
        full = f"{layer}.{name}"
        if spark.catalog.tableExists(full):
            kind = "VIEW" if spark.catalog.getTable(full).tableType == "VIEW" else "BASE TABLE"
            parts.append(relation_counts(spark.table(full), layer, name, kind))
        else:
            parts.append(spark.createDataFrame([(layer, name, "MISSING", None, None, "FAIL")], INVENTORY_SCHEMA))
    return reduce(DataFrame.unionByName, parts)


def relation_counts(df: DataFrame, layer: str, name: str, kind: str) -> DataFrame:
    return df.agg(F.count("*").alias("row_count")).select(
        F.lit(layer).alias("schema_name"),
        F.lit(name).alias("relation_name"),
        F.lit(kind).alias("relation_type"),
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.when(F.col("row_count") > 0, "PASS").otherwise("FAIL").alias("status"),
    )


def schema_summary(spark: SparkSession, frames: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """Columns of every relation, ordered by schema, table and position."""
    rows = [
        (layer, name, field.name, place, field.dataType.simpleString(), "YES" if field.nullable else "NO")
        for (layer, name), df in frames.items()
        for place, field in enumerate(df.schema.fields, 1)
    ]
    return spark.createDataFrame(rows, SUMMARY_SCHEMA).orderBy("schema_name", "table_name", "ordinal_position")


def catalog_schema_summary(spark: SparkSession, layers: Iterable[str] = LAYERS) -> DataFrame:
    frames = {
        (layer, table.name): spark.table(f"{layer}.{table.name}")
        for layer in layers
        if spark.catalog.databaseExists(layer)
        for table in spark.catalog.listTables(layer)
        if not table.isTemporary
    }
    return schema_summary(spark, frames)
