"""Checks on landed raw data against its manifest."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from shoplens.constants import API_SOURCE, BATCH_SOURCE, DELTA_FEED
from shoplens.operators.fingerprint import fingerprint_columns
from shoplens.plans.expectations import FAIL, PASS, check
from shoplens.schemas import DELTA_RECORD, QUALITY_ROW
from shoplens.session import path_exists
from shoplens.sinks.landing import ingest_state
from shoplens.sources.blocks import digests, partition_totals
from shoplens.sources.landing import (
    latest_stamp, partition_path, presence, read_manifest, read_type, response_type, stored_partitions, type_path,
)
from shoplens.sources.payloads import DATA_CONTRACT, DATA_KEYS, parse_payloads

DELTA_DATASET = "raw_api_item_properties_delta"
STAMP_PATTERN = r"^\d{8}_\d{6}$"


def _rows(dataset: Column, source: DataFrame, checks: list[Column]) -> DataFrame:
    return source.select(dataset.alias("dataset_name"), F.inline(F.array(*checks)))


def _verdict(condition: Column) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), PASS).otherwise(FAIL)


def _text(value: str | Column) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return F.coalesce(column.cast("string"), F.lit("none"))


def landed_facts(spark: SparkSession, root: str, data_type: str, fmt: str, schema: StructType) -> DataFrame:
    """Rows and fingerprint of every landed partition, in one pass over the type."""
    rows = read_type(spark, root, data_type, fmt, schema)
    count, mark = fingerprint_columns(schema.fieldNames())
    return rows.groupBy("ingestion_timestamp").agg(count.alias("actual_rows"), mark.alias("actual_fingerprint"))


def batch_report(spark: SparkSession, root: str, data_types: Iterable[str], fmt: str = "csv") -> DataFrame:
    """The newest partition of every batch type in that format: its files, hashed again, against its manifest row."""
    manifest = read_manifest(spark, root, required=True)
    parts = []
    for data_type in data_types:
        name = f"raw_batch_{data_type}"
        try:
            stamp = latest_stamp(manifest, data_type, fmt)
        except FileNotFoundError as error:
            parts.append(spark.createDataFrame([(name, "raw_batch_validation", FAIL, str(error))], QUALITY_ROW))
            continue
        declared = manifest.where(
            (F.col("data_type") == data_type) & (F.col("format") == fmt) & (F.col("ingestion_timestamp") == stamp))
        path = partition_path(root, data_type, fmt, stamp)
        if not path_exists(spark, path):
            parts.append(_rows(F.lit(name), declared.limit(1), [check("raw_file_exists", FAIL, F.col("landing_path"))]))
            continue
        totals = digests(spark, path).agg(
            *partition_totals(), F.sum(F.greatest(F.col("records") - 1, F.lit(0))).alias("actual_rows"))
        joined = declared.join(totals.select(
            F.lit(stamp).alias("ingestion_timestamp"), "actual_rows", F.col("checksum_sha256").alias("actual_checksum")),
            "ingestion_timestamp", "left")
        same_rows = (F.col("row_count") == F.col("actual_rows")) & (F.col("actual_rows") > 0)
        same_bytes = F.col("checksum_sha256") == F.col("actual_checksum")
        partition = F.concat(F.lit("ingestion_timestamp="), F.col("ingestion_timestamp"))
        parts.append(_rows(F.lit(name), joined, [
            check("raw_file_exists", _verdict(F.col("actual_checksum").isNotNull()), F.col("landing_path")),
            check("partition_name", _verdict(F.col("ingestion_timestamp").rlike(STAMP_PATTERN)), partition),
            check("row_count_matches_metadata", _verdict(same_rows), _matching(same_rows, "row_count", "actual_rows")),
            check("checksum_matches_metadata", _verdict(same_bytes), _matching(same_bytes, "checksum_sha256", "actual_checksum")),
            check("source_system", _verdict(F.col("source_system") == BATCH_SOURCE), _text("source_system")),
        ]))
    return reduce(DataFrame.unionByName, parts)


def presence_report(spark: SparkSession, root: str) -> DataFrame:
    """A row for every partition and format that the manifest or the store knows; what only one of them knows fails."""
    found = F.col("presence")
    dataset = F.concat(F.col("data_type"), F.lit(":ingestion_timestamp="), F.col("ingestion_timestamp"))
    files = F.concat(F.lit("files declared="), _text("declared_files"), F.lit(", stored="), _text("stored_files"))
    return _rows(dataset, presence(spark, root), [
        check(F.concat(F.col("format"), F.lit("_presence")), _verdict(found == "present"), F.concat(found, F.lit(": "), files))])


def _matching(condition: Column, declared: str, actual: str) -> Column:
    differing = F.concat(F.lit("metadata="), _text(declared), F.lit(", actual="), _text(actual))
    return F.when(F.coalesce(condition, F.lit(False)), _text(actual)).otherwise(differing)


def response_checks(raw: DataFrame, manifest: DataFrame) -> DataFrame:
    """Contract and record count of the landed responses of each partition.

    ``raw``: value (response text), ingestion_timestamp.
    """
    parsed = parse_payloads(raw.select(F.col("value").alias("body"), "ingestion_timestamp"))
    # landing accepts a data response without counters; the check does not
    absent = F.array_except(F.array(*map(F.lit, DATA_KEYS)), "response_keys")
    incomplete = (F.col("api_contract") == DATA_CONTRACT) & (F.size(absent) > 0)
    parsed = parsed.withColumn("problem", F.coalesce(
        "problem", F.when(incomplete, F.concat(F.lit("missing keys: "), F.array_join(absent, ", ")))))
    per_partition = parsed.groupBy("ingestion_timestamp").agg(
        F.min("problem").alias("problem"),
        F.max("api_contract").alias("contract"),
        F.sum(F.coalesce(F.size("records"), F.lit(0))).alias("record_count"),
    )
    declared = manifest.where(F.col("format") == "parquet").select("ingestion_timestamp", "row_count")
    joined = per_partition.join(declared, "ingestion_timestamp", "left")
    valid = F.col("problem").isNull()
    same = F.col("record_count") == F.col("row_count")
    return _rows(_partition_dataset(), joined, [
        check("raw_response_contract", _verdict(valid), F.when(valid, F.col("contract")).otherwise(F.col("problem"))),
        check("row_count_matches_metadata", _verdict(same), _matching(same, "row_count", "record_count")),
    ])


def _partition_dataset() -> Column:
    return F.concat(F.lit(f"{DELTA_DATASET}:ingestion_timestamp="), F.col("ingestion_timestamp"))


def delta_report(
    spark: SparkSession, root: str, data_type: str = DELTA_FEED, schema: StructType = DELTA_RECORD,
    expected_formats: tuple[str, ...] = ("json", "csv", "parquet"), with_responses: bool = True,
) -> DataFrame:
    """Every delta partition against its manifest row, then totals and state.

    ``with_responses``: the raw responses must have been landed too.
    """
    everything = read_manifest(spark, root)
    manifest = everything.where(F.col("data_type") == data_type)
    if manifest.isEmpty():
        missing = f"no landed partitions of {data_type}"
        return spark.createDataFrame([(DELTA_DATASET, "raw_api_validation", FAIL, missing)], QUALITY_ROW)
    parts = []

    # presence in the store: every expected format of every partition, missing ones fail
    raw_type = response_type(data_type)
    expected = [*expected_formats, *(["raw_response"] if with_responses else [])]
    wanted = manifest.select("ingestion_timestamp").distinct().select(
        "ingestion_timestamp", F.explode(F.array(*[F.lit(name) for name in expected])).alias("format")
    )
    stored = stored_partitions(spark, root).where(F.col("data_type").isin(data_type, raw_type)).select(
        "ingestion_timestamp", F.when(F.col("data_type") == raw_type, "raw_response").otherwise(F.col("format")).alias("format"),
        F.concat(F.lit(f"{root}/type="), F.col("data_type"), F.lit("/format="), F.col("format"),
                 F.lit("/ingestion_timestamp="), F.col("ingestion_timestamp")).alias("stored_path"))
    found = F.col("stored_path").isNotNull()
    parts.append(wanted.join(stored, ["ingestion_timestamp", "format"], "left").select(
        _partition_dataset().alias("dataset_name"),
        F.concat(F.col("format"), F.lit("_exists")).alias("check_name"),
        F.when(found, PASS).otherwise(FAIL).alias("status"),
        F.coalesce("stored_path", F.lit("not landed")).alias("details"),
    ))

    if with_responses:
        text = StructType().add("value", "string")
        if path_exists(spark, type_path(root, raw_type, "parquet")):
            parts.append(response_checks(read_type(spark, root, raw_type, "parquet", text), manifest))
        else:
            parts.append(spark.createDataFrame([(DELTA_DATASET, "raw_response_contract", FAIL, f"no landed {raw_type}")], QUALITY_ROW))

    facts = landed_facts(spark, root, data_type, "parquet", schema)
    declared = manifest.where(F.col("format") == "parquet")
    joined = declared.join(facts, "ingestion_timestamp", "left")
    missing_columns = sorted(set(DELTA_RECORD.fieldNames()) - set(spark.read.parquet(type_path(root, data_type, "parquet")).columns))
    same_rows = (F.col("row_count") == F.col("actual_rows")) & (F.col("actual_rows") > 0)
    same_mark = F.col("fingerprint") == F.col("actual_fingerprint")
    parts.append(_rows(_partition_dataset(), joined, [
        check(
            "normalized_parquet_schema", FAIL if missing_columns else PASS,
            str(missing_columns or sorted(DELTA_RECORD.fieldNames())),
        ),
        check("normalized_parquet_row_count", _verdict(same_rows), _matching(same_rows, "row_count", "actual_rows")),
        check("checksum_matches_metadata", _verdict(same_mark), _matching(same_mark, "fingerprint", "actual_fingerprint")),
        check("source_system", _verdict(F.col("source_system") == API_SOURCE), _text("source_system")),
    ]))

    totals = joined.agg(
        F.count("*").alias("partitions"), F.coalesce(F.sum("actual_rows"), F.lit(0)).alias("rows")
    )
    parts.append(_rows(F.lit(DELTA_DATASET), totals, [
        check(
            "partition_count_positive", _verdict(F.col("partitions") > 0),
            F.concat(F.lit("Found "), F.col("partitions").cast("string"), F.lit(" API delta partitions")),
        ),
        check(
            "total_partition_rows_positive", _verdict(F.col("rows") > 0),
            F.concat(F.lit("Total rows across API partitions: "), F.col("rows").cast("string")),
        ),
    ]))
    parts.append(_rows(F.lit(DELTA_DATASET), ingest_state(manifest, data_type), [
        check("state_file_exists", _verdict(F.col("landed_partitions") > 0), _text("last_ingestion_timestamp")),
        check("state_cursor", PASS, _text("cursor")),
    ]))
    return reduce(DataFrame.unionByName, parts)
