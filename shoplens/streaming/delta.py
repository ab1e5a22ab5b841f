"""Delta landings as a stream, appended to the staged delta dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from shoplens.plans.staging import file_of_row, stage_properties_delta
from shoplens.schemas import DELTA_RECORD
from shoplens.sources.landing import CSV_READ


def read_delta_stream(
    spark: SparkSession, source: str, schema: StructType = DELTA_RECORD, fmt: str = "parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """New landed files as typed delta rows. The checkpoint is the cursor."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.options(**CSV_READ)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return stage_properties_delta(reader.load(source), file_of_row())


def append_delta(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append every new row, none removed; each landed file is taken once."""
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(target)
    )
