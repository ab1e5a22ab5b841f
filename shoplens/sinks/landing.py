"""Immutable landing of raw data with a manifest row per partition."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shoplens.constants import API_SOURCE, BATCH_SOURCE
from shoplens.operators.fingerprint import EMPTY_FINGERPRINT, fingerprint_columns
from shoplens.operators.merge import stack
from shoplens.schemas import MANIFEST
from shoplens.session import delete_path, materialise, path_exists, publish_path
from shoplens.sources.blocks import digests, partition_totals
from shoplens.sources.external import csv_header
from shoplens.sources.landing import (
    CSV_READ, CSV_WRITE, manifest_path, partition_path, path_fact, pending_path, read_manifest, response_type,
)
from shoplens.sources.payloads import normalise_records, parse_payloads, read_payload_text, require_valid

STAMP = "ingestion_timestamp"


def _read_back(spark: SparkSession, path: str, fmt: str, schema: StructType) -> DataFrame:
    """A pending format with its partition column, as text."""
    fields = [field for field in schema.fields if field.name != STAMP]
    reader = spark.read.schema(StructType([*fields, StructField(STAMP, StringType())]))
    return (reader.options(**CSV_READ) if fmt == "csv" else reader).format(fmt).load(path)


def _write(df: DataFrame, fmt: str, path: str, stamp: str | None) -> None:
    """One partition of that stamp, which may be empty, or a partition for every stamp of the rows."""
    writer = (df if stamp is None else df.drop(STAMP)).write.mode("errorifexists").format(fmt)
    writer = writer.options(**CSV_WRITE) if fmt == "csv" else writer
    if stamp is None:
        writer.partitionBy(STAMP).save(path)
    else:
        writer.save(f"{path}/{STAMP}={stamp}")


def _refuse_published(spark: SparkSession, root: str, data_type: str, formats: Iterable[str], stamps: DataFrame) -> None:
    taken = read_manifest(spark, root).where((F.col("data_type") == data_type) & F.col("format").isin(*formats)).join(
        stamps, STAMP, "left_semi").select("landing_path").first()
    if taken is not None:
        raise FileExistsError(f"landing partition exists: {taken['landing_path']}")


def _publish(spark: SparkSession, manifest: DataFrame, root: str, pending: str) -> None:
    """Moves the pending partitions to their places, then lists them in the manifest.

    Until its manifest row is there a partition is not published: a failure
    between the two steps leaves one that ``presence`` calls unlisted and that
    the next landing of the same stamp takes over.
    """
    for row in manifest.select("data_type", "format", STAMP, "landing_path").collect():  # a row per partition of this landing
        if path_exists(spark, row["landing_path"]):
            delete_path(spark, row["landing_path"])  # never published
        publish_path(spark, f"{pending}/{row['format']}/{STAMP}={row[STAMP]}", row["landing_path"])
    append_manifest(manifest, root)
    delete_path(spark, pending)


def land(
    df: DataFrame,
    root: str,
    data_type: str,
    stamp: str,
    source_system: str,
    formats: tuple[str, ...] = ("parquet",),
    source_file: str | None = None,
    **facts,
) -> DataFrame:
    """Write ``df`` as a new partition in every format; return manifest rows.

    Fails if the partition is in the manifest. See ``land_partitions``.
    """
    known = df.sparkSession.createDataFrame([(stamp,)], f"{STAMP} string").select(
        STAMP, *(F.lit(value).alias(name) for name, value in facts.items()))
    return _land(df, root, data_type, source_system, formats, source_file, known, stamp)


def land_partitions(
    df: DataFrame,
    root: str,
    data_type: str,
    source_system: str,
    formats: tuple[str, ...] = ("parquet",),
    source_file: str | None = None,
    facts: DataFrame | None = None,
) -> DataFrame:
    """Write the rows of ``df`` as one new partition for each ``ingestion_timestamp``, in every format; return manifest rows.

    All partitions are written together and described together. Fails if one
    of them is in the manifest. The second and later formats are copied from
    the first, and counts, fingerprints and checksums come from the written
    files, so the manifest describes what was stored and not what was meant to
    be. ``facts``: further manifest columns by ``ingestion_timestamp``.
    """
    known = df.select(STAMP).distinct() if facts is None else facts
    return _land(df, root, data_type, source_system, formats, source_file, known, None)


def _land(df, root, data_type, source_system, formats, source_file, facts: DataFrame, stamp: str | None) -> DataFrame:
    spark = df.sparkSession
    _refuse_published(spark, root, data_type, formats, facts.select(STAMP))
    pending = pending_path(root, uuid.uuid4().hex)
    rows, landed = [], df
    for fmt in formats:
        path = f"{pending}/{fmt}"
        _write(landed, fmt, path, stamp)
        landed = _read_back(spark, path, fmt, df.schema)
        count, mark = fingerprint_columns(df.columns)
        counts = landed.groupBy(STAMP).agg(count.alias("row_count"), mark.alias("fingerprint"))
        files = digests(spark, path, "part-*", with_records=False).groupBy(path_fact(F.col("path"), STAMP).alias(STAMP)).agg(*partition_totals())
        rows.append(facts.join(files, STAMP).join(counts, STAMP, "left").withColumns({
            "row_count": F.coalesce("row_count", F.lit(0)), "fingerprint": F.coalesce("fingerprint", F.lit(EMPTY_FINGERPRINT)),
            "format": F.lit(fmt),
            "landing_path": F.concat(F.lit(partition_path(root, data_type, fmt, "")), F.col(STAMP))}))
    manifest = _manifest_rows(stack(*rows), source_system=source_system, data_type=data_type, source_file=source_file)
    _publish(spark, manifest, root, pending)
    return manifest


def _manifest_rows(described: DataFrame, **same) -> DataFrame:
    """Stored rows of the manifest's schema; ``same`` are the values that all rows share."""
    known = {**{name: F.col(name) for name in described.columns}, **{name: F.lit(value) for name, value in same.items()},
             "ingested_at": F.current_timestamp()}
    return materialise(described.select(*[
        known.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name) for field in MANIFEST.fields
    ]), "manifest-rows")


def append_manifest(rows: DataFrame, root: str) -> None:
    rows.coalesce(1).write.mode("append").parquet(manifest_path(root))


def write_sidecar(manifest: DataFrame, root: str) -> None:
    """The manifest rows of one landing as JSON, next to the partitions."""
    manifest.coalesce(1).write.mode("errorifexists").partitionBy("data_type", "ingestion_timestamp").json(
        f"{root}/sidecars"
    )


def land_batch(
    spark: SparkSession, source_file: str, root: str, data_type: str, stamp: str, columns: list[str],
    source_system: str = BATCH_SOURCE,
) -> DataFrame:
    """Land a CSV file, or a folder of them, byte for byte; return the manifest row.

    ``columns`` must be in the header; further columns are landed too. The
    executors copy the files in blocks, with digest and record count on the
    way, to a pending folder; the copies are read back and must have the
    digests of what was read. Then the folder gets its name and its manifest
    row. A landing of the same files that failed between these two steps is
    adopted, one of other files is replaced.
    """
    header = csv_header(spark, source_file)
    missing = [name for name in columns if name not in header]
    if missing:
        raise ValueError(f"{source_file} has no column {', '.join(missing)}; its header is {', '.join(header)}")
    _refuse_published(spark, root, data_type, ["csv"], spark.createDataFrame([(stamp,)], f"{STAMP} string"))
    final = partition_path(root, data_type, "csv", stamp)
    if path_exists(spark, final) and _same_files(digests(spark, source_file), digests(spark, final)):
        landed = digests(spark, final)
        manifest = _batch_manifest(landed, stamp, data_type, source_system, source_file, final)
        append_manifest(manifest, root)
        return manifest
    pending = pending_path(root, uuid.uuid4().hex)
    target = f"{pending}/csv/{STAMP}={stamp}"
    read = materialise(digests(spark, source_file, copy_to=target), "copied")
    landed = materialise(digests(spark, target), "landed")
    if not _same_files(read, landed):
        raise OSError(f"the copy of {source_file} at {target} differs from it")
    manifest = _batch_manifest(landed, stamp, data_type, source_system, source_file, final)
    _publish(spark, manifest, root, pending)
    return manifest


def _same_files(left: DataFrame, right: DataFrame) -> bool:
    """Whether both have the same names with the same content."""
    names = ["name", "file_bytes", "checksum_sha256"]
    return stack(left.select(*names).exceptAll(right.select(*names)), right.select(*names).exceptAll(left.select(*names))).isEmpty()


def _batch_manifest(landed, stamp, data_type, source_system, source_file, final) -> DataFrame:
    totals = landed.agg(*partition_totals(), F.sum(F.greatest(F.col("records") - 1, F.lit(0))).alias("row_count"))
    return _manifest_rows(
        totals.withColumn(STAMP, F.lit(stamp)), source_system=source_system, data_type=data_type, source_file=source_file,
        format="csv", landing_path=final)


def land_payloads(
    spark: SparkSession, source: str, root: str, stamp: str, data_type: str = "item_properties_delta",
    source_system: str = API_SOURCE, one_per_file: bool = True,
) -> DataFrame:
    """Land API responses: the raw text, and the records in three formats.

    Responses may span lines, so their text is a column of a Parquet
    partition of its own type. A response that breaks its contract stops the landing before anything is
    written.
    """
    payloads = parse_payloads(read_payload_text(spark, source, one_per_file))
    require_valid(payloads)
    last = payloads.agg(
        F.max("api_contract").alias("api_contract"),
        F.sum("api_count").alias("api_count"),
        F.max("total_rows").alias("total_rows"),
        F.min("unread_rows").alias("unread_rows"),
        F.min("api_success").alias("api_success"),
        # the page with the fewest rows still to read is the last one; then the highest page number in the name
        F.max_by("next_cursor", F.when(F.col("next_cursor").isNotNull(), F.struct(
            -F.col("unread_rows"), F.length("raw_response_file"), "raw_response_file", "next_cursor"
        ))).alias("cursor"),
    ).first()
    facts = last.asDict()
    bodies = payloads.select(F.col("body").alias("value"))
    raw = land(bodies, root, response_type(data_type), stamp, source_system, ("parquet",), source, **facts)
    records = normalise_records(payloads, stamp, source_system)
    return stack(raw, land(records, root, data_type, stamp, source_system, ("parquet", "csv", "json"), source, **facts))


def ingest_state(manifest: DataFrame, data_type: str = "item_properties_delta") -> DataFrame:
    """Cumulative counters over landings; a landing without cursor keeps the last one."""
    stamp = F.col("ingestion_timestamp")
    cursor_stamp = F.when(F.col("cursor").isNotNull(), stamp)
    return manifest.where((F.col("data_type") == data_type) & (F.col("format") == "parquet")).agg(
        F.max_by("cursor", cursor_stamp).alias("cursor"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("records_ingested_total"),
        F.max(stamp).alias("last_ingestion_timestamp"),
        F.max_by("api_count", stamp).alias("last_api_count"),
        F.max_by("total_rows", stamp).alias("last_api_total_rows"),
        F.max_by("unread_rows", stamp).alias("last_api_unread_rows"),
        F.max_by("api_success", stamp).alias("last_api_success"),
        F.count("*").alias("landed_partitions"),
    )
