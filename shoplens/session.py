"""Session settings and scratch tables on shared storage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "shoplens", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Instants are printed and parsed in UTC, whatever the machine's zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables that every executor can reach.

    The session names it in ``spark.checkpoint.dir`` or as its checkpoint
    folder; without either it lies in the warehouse, which is shared too.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return root.rstrip("/")


_scratch_paths: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark)}/shoplens/{label}-{uuid.uuid4().hex}"
    _scratch_paths.append(path)
    return path


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Deletes, at the end, the scratch tables made inside the block."""
    known = len(_scratch_paths)
    try:
        yield
    finally:
        for path in _scratch_paths[known:]:
            delete_path(spark, path)
        del _scratch_paths[known:]


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as a scratch table and read it back.

    Cuts lineage like a reliable checkpoint, survives lost executors, and
    stays columnar with known size, so readers prune columns and AQE sees
    real statistics.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def delete_path(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def publish_path(spark: SparkSession, pending: str, final: str) -> None:
    """Moves a finished folder to its final name; one step where the store can rename folders."""
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(path) for path in (pending, final))
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(target.getParent())
    if not store.rename(source, target):
        raise OSError(f"{pending} could not be moved to {final}")
