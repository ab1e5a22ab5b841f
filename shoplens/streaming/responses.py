"""Landed API responses as a stream: records of valid pages, and rejected pages with their reason."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from shoplens.session import path_exists
from shoplens.sources.landing import response_type, type_path
from shoplens.sources.payloads import normalise_records, parse_payloads

_RESPONSE = StructType([StructField("value", StringType()), StructField("ingestion_timestamp", StringType())])


class ResponseSplit:
    """Two tables below ``target``, ``records`` and ``rejected``, each page in one of them and once.

    A batch writes one partition of each table, named by the batch. After a
    failure the checkpoint replays the same files under the same name, so the
    partition is replaced and no page is taken twice.
    """

    def __init__(self, spark: SparkSession, target: str):
        self.spark = spark
        self.target = target.rstrip("/")

    def absorb(self, root: str, data_type: str, files_per_batch: int | None = None) -> StreamingQuery:
        """Takes in the responses that were landed since the last run."""
        reader = self.spark.readStream.schema(_RESPONSE)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        return (
            reader.parquet(type_path(root, response_type(data_type), "parquet")).writeStream.foreachBatch(self._write)
            .option("checkpointLocation", f"{self.target}/checkpoint").trigger(availableNow=True).start()
        )

    def _write(self, batch: DataFrame, batch_id: int) -> None:
        pages = parse_payloads(batch.select(F.col("value").alias("body"), "ingestion_timestamp"))
        for name, rows in (
            ("records", normalise_records(pages, F.col("ingestion_timestamp"))),
            ("rejected", pages.where(F.col("problem").isNotNull()).select("ingestion_timestamp", "problem", "body")),
        ):
            rows.write.mode("overwrite").parquet(f"{self.target}/{name}/batch_id={batch_id}")

    def read(self, name: str) -> DataFrame:
        if not path_exists(self.spark, f"{self.target}/{name}"):
            raise FileNotFoundError(f"no {name} at {self.target}: run the stream first")
        return self.spark.read.parquet(f"{self.target}/{name}").drop("batch_id")
