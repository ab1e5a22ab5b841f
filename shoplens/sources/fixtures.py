"""Views that give the star-schema test tables the shapes of the sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from shoplens.constants import (
    ADD_TO_CART,
    API_SOURCE,
    AVAILABILITY_PROPERTY,
    BATCH_SOURCE,
    CATEGORY_PROPERTY,
    TRANSACTION,
    VIEW,
)


_schemas: dict[str, StructType] = {}


class FixtureTables:
    """The four source-shaped inputs over one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        """A test table; its schema is read from the file once per process."""
        path = f"{self.folder}/{name}.parquet"
        if path not in _schemas:
            _schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_schemas[path]).parquet(path)

    @staticmethod
    def _millis(column: str):
        return F.unix_millis(F.col(column).cast("timestamp"))

    def click_events(self) -> DataFrame:
        """Dense sub-second events, with types outside the known three."""
        kind = F.col("event_type")
        return self.table("events").select(
            self._millis("ts").alias("timestamp"),
            F.col("user_id").alias("visitorid"),
            F.when(kind == "click", ADD_TO_CART)
            .when(kind == "purchase", TRANSACTION)
            .otherwise(kind)
            .alias("event"),
            F.get_json_object("props", "$.k").cast("bigint").alias("itemid"),
            F.when(kind == "purchase", F.col("event_id")).cast("string").alias("transactionid"),
        )

    def order_events(self) -> DataFrame:
        """Larger, at day granularity, with many equal timestamps."""
        mark = F.col("l_returnflag")
        lines = self.table("lineitem").select("l_orderkey", "l_partkey", "l_returnflag")
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            self._millis("o_orderdate").alias("timestamp"),
            F.col("o_custkey").alias("visitorid"),
            F.when(mark == "N", VIEW).when(mark == "A", ADD_TO_CART).otherwise(TRANSACTION).alias("event"),
            F.col("l_partkey").alias("itemid"),
            F.when(mark == "R", F.col("o_orderkey")).cast("string").alias("transactionid"),
        )

    def item_properties(self) -> DataFrame:
        """Property log of both feeds; ``seq`` settles equal timestamps."""
        lines = self.table("lineitem")
        common = (
            self._millis("l_shipdate").alias("timestamp"),
            F.col("l_partkey").alias("itemid"),
        )
        lineage = (
            F.when(F.col("l_returnflag") == "A", API_SOURCE).otherwise(BATCH_SOURCE).alias("source_system"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
        )
        categories = (
            lines.where("l_quantity >= 48")
            .join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .select(
                *common,
                F.lit(CATEGORY_PROPERTY).alias("property"),
                (F.col("s_nationkey") + 10).cast("string").alias("value"),
                *lineage,
            )
        )
        availability = lines.where("l_quantity <= 3").select(
            *common,
            F.lit(AVAILABILITY_PROPERTY).alias("property"),
            F.when(F.col("l_linestatus") == "O", "1").otherwise("False").alias("value"),
            *lineage,
        )
        return categories.unionByName(availability)

    def category_tree(self) -> DataFrame:
        """Nations are leaves below regions, regions are roots."""
        leaves = self.table("nation").select(
            (F.col("n_nationkey") + 10).cast("bigint").alias("categoryid"),
            F.col("n_regionkey").cast("string").alias("parentid"),
        )
        roots = self.table("region").select(
            F.col("r_regionkey").cast("bigint").alias("categoryid"),
            F.lit(None).cast("string").alias("parentid"),
        )
        return leaves.unionByName(roots)
