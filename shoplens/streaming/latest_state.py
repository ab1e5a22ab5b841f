"""Latest property values per item, kept up to date by a streaming aggregation.

The state is Spark's own: one row per item and property in the state store of
the query's checkpoint, the newest by the order that the batch computation
uses. RocksDB holds it outside the heap, and a batch commits a changelog of
the keys that it changed, so its cost follows the batch; Spark itself makes
snapshots and drops old versions. Readers take the last committed version
through the state data source. The newest of the newest is the newest, so the
result equals the batch computation over all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from shoplens.constants import SELECTED_PROPERTIES
from shoplens.session import path_exists

KEY = ("item_id", "property_name")
#: The newest row is the greatest in these columns, as in the batch computation.
ORDER = ("property_timestamp_ms", "source_system", "seq", "property_value")

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


class LatestPropertyState:
    """State below ``root``; the checkpoint keeps it together with the files that it has taken in."""

    def __init__(self, spark: SparkSession, root: str, properties: tuple[str, ...] = SELECTED_PROPERTIES):
        self.spark = spark
        self.root = root.rstrip("/")
        self.properties = properties

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"

    @property
    def _seed(self) -> str:
        return f"{self.root}/seed"

    def seed(self, rows: DataFrame) -> None:
        """Start from a history that does not come through the stream; only before the first run."""
        if path_exists(self.spark, self.checkpoint):
            raise FileExistsError(f"the state at {self.root} has begun: its seed is fixed")
        rows.where(F.col("property_name").isin(*self.properties)).write.mode("errorifexists").parquet(self._seed)

    def newest(self, rows: DataFrame) -> DataFrame:
        """Key and, as one struct, the newest row of each; the same for a table and a stream."""
        kept = rows.where(F.col("property_name").isin(*self.properties))
        first = [name for name in ORDER if name in kept.columns]
        rest = [name for name in kept.columns if name not in first and name not in KEY]
        return kept.groupBy(*KEY).agg(F.max(F.struct(*first, *rest)).alias("newest"))

    def absorb(self, stream: DataFrame) -> StreamingQuery:
        """Takes in what the stream has to offer now; started again it goes on where it stopped."""
        if path_exists(self.spark, self._seed):
            schema = self.spark.read.parquet(self._seed).schema
            stream = stream.unionByName(self.spark.readStream.schema(schema).parquet(self._seed), allowMissingColumns=True)
        before = {name: self.spark.conf.get(name, None) for name in STATE_SETTINGS}
        for name, value in STATE_SETTINGS.items():
            self.spark.conf.set(name, value)
        try:  # a query keeps the settings that it starts with
            return (
                self.newest(stream).writeStream.outputMode("update").format("noop")
                .option("checkpointLocation", self.checkpoint).trigger(availableNow=True).start()
            )
        finally:
            for name, value in before.items():
                self.spark.conf.unset(name) if value is None else self.spark.conf.set(name, value)

    def current(self) -> DataFrame:
        """The newest row of each item and property, of the last committed batch."""
        if not path_exists(self.spark, f"{self.checkpoint}/commits"):
            raise FileNotFoundError(f"no state at {self.root}: run the stream first")
        state = self.spark.read.format("statestore").load(self.checkpoint)
        value = state.schema["value"].dataType.fieldNames()[0]  # the one aggregate of the query
        return state.select("key.*", F.col("value").getField(value).alias("newest")).select(*KEY, "newest.*")
