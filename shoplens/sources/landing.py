"""Landed partitions: <root>/type=<t>/format=<f>/ingestion_timestamp=<s>/."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shoplens.operators.merge import stack
from shoplens.operators.ranking import first_per_key
from shoplens.schemas import DELTA_RECORD, MANIFEST
from shoplens.session import path_exists
from shoplens.sources.blocks import listed

# --- fixed values: a partition is read from the first format it has -------
FORMAT_PREFERENCE = ("parquet", "csv", "json")


# Landed CSV: quoted values may hold line breaks, a quote inside is doubled,
# and an empty text ("") is not a missing value (nothing). The null marker is
# a character that no text holds.
CSV_WRITE = {"header": True, "escape": '"'}
CSV_READ = {**CSV_WRITE, "multiLine": True, "nullValue": "\x01"}


def manifest_path(root: str) -> str:
    return f"{root}/manifest"


def type_path(root: str, data_type: str, fmt: str) -> str:
    return f"{root}/type={data_type}/format={fmt}"


def response_type(data_type: str) -> str:
    """The type under which the raw responses behind a delta type are landed."""
    return f"{data_type}_response"


def partition_path(root: str, data_type: str, fmt: str, stamp: str) -> str:
    return f"{type_path(root, data_type, fmt)}/ingestion_timestamp={stamp}"


def pending_path(root: str, run: str) -> str:
    """Where a landing lies until it is published; readers pass over names that begin with an underscore."""
    return f"{root}/_pending/{run}"


def path_fact(path: Column, name: str) -> Column:
    """The value of ``name=value`` in the path of a landed file."""
    return F.regexp_extract(path, rf"/{name}=([^/]*)/", 1)


def stored_partitions(spark: SparkSession, root: str) -> DataFrame:
    """data_type, format, ingestion_timestamp, stored_files, stored_bytes as the store lists them; no content is read.

    What was never published is in the list too: the manifest is not asked.
    """
    if not path_exists(spark, root):
        return spark.createDataFrame([], "data_type string, format string, ingestion_timestamp string, stored_files long, stored_bytes long")
    path = F.col("path")
    return (
        listed(spark, root).where(path.contains("/ingestion_timestamp=") & ~path.contains("/_pending/"))
        .groupBy(path_fact(path, "type").alias("data_type"), path_fact(path, "format").alias("format"),
                 path_fact(path, "ingestion_timestamp").alias("ingestion_timestamp"))
        .agg(F.count("*").alias("stored_files"), F.sum("length").alias("stored_bytes"))
        .where("data_type <> ''")
    )


def presence(spark: SparkSession, root: str) -> DataFrame:
    """Manifest against store, in both directions, one row per partition and format.

    ``present``, ``missing`` (declared, and no file is stored), ``incomplete``
    (other files or bytes than declared) or ``unlisted`` (stored, and no
    manifest row tells of it).
    """
    key = ["data_type", "format", "ingestion_timestamp"]
    declared = read_manifest(spark, root).groupBy(*key).agg(
        F.max("file_count").alias("declared_files"), F.max("file_bytes").alias("declared_bytes"))
    same = (F.col("declared_files") == F.col("stored_files")) & (F.col("declared_bytes") == F.col("stored_bytes"))
    return declared.join(stored_partitions(spark, root), key, "full").select(
        *key, "declared_files", "stored_files",
        F.when(F.col("declared_files").isNull(), "unlisted").when(F.col("stored_files").isNull(), "missing")
        .when(same, "present").otherwise("incomplete").alias("presence"))


def read_manifest(spark: SparkSession, root: str, required: bool = False) -> DataFrame:
    """The manifest table; empty when nothing was landed, unless required."""
    path = manifest_path(root)
    if path_exists(spark, path):
        return spark.read.schema(MANIFEST).parquet(path)
    if required:
        raise FileNotFoundError(f"no landing manifest at {path}")
    return spark.createDataFrame([], MANIFEST)


def read_sidecars(spark: SparkSession, root: str) -> DataFrame:
    """Manifest rows from the JSON sidecars, one file per partition."""
    return spark.read.schema(MANIFEST).option("multiLine", True).json(f"{root}/sidecars/*/*")


def read_type(spark: SparkSession, root: str, data_type: str, fmt: str, schema: StructType) -> DataFrame:
    """All partitions of one type; the partition column stays text."""
    fields = [field for field in schema.fields if field.name != "ingestion_timestamp"]
    full = StructType([*fields, StructField("ingestion_timestamp", StringType())])
    reader = spark.read.schema(full)
    if fmt == "csv":
        reader = reader.options(**CSV_READ)
    return reader.format(fmt).load(type_path(root, data_type, fmt))


def latest_stamp(manifest: DataFrame, data_type: str, fmt: str | None = None) -> str:
    """The newest stamp of a type, or of those of its partitions that have the format."""
    landed = manifest.where(F.col("data_type") == data_type)
    if fmt is not None:
        landed = landed.where(F.col("format") == fmt)
    row = landed.agg(F.max("ingestion_timestamp").alias("stamp")).first()
    if row is None or row["stamp"] is None:
        kind = data_type if fmt is None else f"{data_type} as {fmt}"
        raise FileNotFoundError(f"no landed partitions of {kind}: run the landing step first")
    return row["stamp"]


def read_latest(spark: SparkSession, root: str, data_type: str, fmt: str, schema: StructType) -> DataFrame:
    """Only the newest partition in that format; its stamp is a literal, so others are pruned."""
    stamp = latest_stamp(read_manifest(spark, root), data_type, fmt)
    return read_type(spark, root, data_type, fmt, schema).where(F.col("ingestion_timestamp") == stamp)


def preferred_formats(manifest: DataFrame, data_type: str) -> DataFrame:
    """The format to read for each partition: ingestion_timestamp, format."""
    place = F.array_position(F.array(*[F.lit(fmt) for fmt in FORMAT_PREFERENCE]), F.col("format"))
    landed = manifest.where(
        (F.col("data_type") == data_type) & F.col("format").isin(*FORMAT_PREFERENCE)
    ).select("ingestion_timestamp", "format")
    return first_per_key(landed, ["ingestion_timestamp"], [place])


def read_preferred(spark: SparkSession, root: str, data_type: str, schema: StructType = DELTA_RECORD) -> DataFrame:
    """Every partition once, each from its preferred format."""
    choice = preferred_formats(read_manifest(spark, root, required=True), data_type)
    formats = sorted(row["format"] for row in choice.select("format").distinct().collect())
    if not formats:
        raise FileNotFoundError(f"no landed partitions of {data_type}: run the landing step first")
    return stack(*[
        read_type(spark, root, data_type, fmt, schema).join(
            choice.where(F.col("format") == fmt).select("ingestion_timestamp"), "ingestion_timestamp", "left_semi"
        ).select(*schema.fieldNames())
        for fmt in formats
    ])
