"""Helpers shared by the operators: batches, words, stored tables, row numbers."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from shoplens.session import materialise, scratch_path

__all__ = ["SPACE", "apply_rows", "carry", "documents", "materialise", "need", "numbered", "restore", "scratch_path", "table", "with_columns"]

#: The white space between words, as in ``[\x20\x09-\x0D]``; bytes.split() cuts at the same.
SPACE = " \t\n\x0b\x0c\r"

#: Rows held as Python objects at once; texts may be long.
SLICE = 256


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def need(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns, cast, and nothing else; other columns may have any name."""
    return df.select(*(F.col(f"`{name}`").cast(kind).alias(name) for name, kind in columns.items()))


def documents(df: DataFrame) -> DataFrame:
    return need(df, doc_id="long", text="string")


CARRIED = "__carried"


def carry(df: DataFrame, *needed: str) -> DataFrame:
    """``needed`` and one struct with all other columns, so these may have any name while helpers add their own."""
    rest = [F.col(f"`{name}`") for name in df.columns if name not in needed] or [F.lit(0).alias("none")]
    return df.select(*(F.col(f"`{name}`") for name in needed), F.struct(*rest).alias(CARRIED))


def restore(df: DataFrame, columns: Sequence[str], *needed: str) -> DataFrame:
    """``columns`` of the table that was carried: ``needed`` as they are now, all others as they were."""
    return df.select(*(F.col(f"`{name}`") if name in needed else F.col(CARRIED).getField(name).alias(name) for name in columns))


def with_columns(schema: StructType, added: Sequence[StructField]) -> StructType:
    """``schema`` with ``added``; a column of the same name (in any case) gives way."""
    names = {field.name.lower() for field in added}
    return StructType([f for f in schema.fields if f.name.lower() not in names] + list(added))


def apply_rows(
    df: DataFrame, added: Sequence[StructField], make: Callable[[], Callable[[list], Iterable[Sequence]]],
    source: str = "text", keep: Sequence[str] | None = None,
) -> DataFrame:
    """Adds columns computed in Arrow batches from one column.

    ``make`` runs once per task and gives a function from a list of values to
    a list of rows of new values.  Only a slice of each batch is held as
    Python objects.
    """
    kept = df if keep is None or source in keep else df.select(*keep, source)
    final = with_columns(StructType([f for f in kept.schema.fields if keep is None or f.name in keep]), added)
    names = [f.name for f in final.fields[: len(final.fields) - len(added)]]
    new = [f.name for f in added]
    # arrow types by name: the closure carries no Spark types
    kinds = [{"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64(),
              "binary": pa.binary(), "int": pa.int32()}[f.dataType.simpleString()] for f in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                rows = list(compute(part.column(source).to_pylist()))
                columns = [pa.array([row[k] for row in rows], kinds[k]) for k in range(len(new))]
                yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + columns, names=names + new)

    return kept.mapInArrow(run, final)


def numbered(df: DataFrame, order: Sequence[Column], group: Sequence[str], name: str) -> DataFrame:
    """Adds ``name``: gapless numbers from 0 inside each ``group``, in the given order.

    No task holds a group: range partitioning by (group, order) and a sort
    inside partitions give each row its partition and place, and the sizes of
    the groups' parts turn places into numbers.  The sorted rows are stored
    once, as range bounds come from a sample.  A group's part is a run of
    rows of a partition, so there are fewer parts than partitions and groups
    together; that is what is broadcast.  Rows equal in the whole order are
    numbered in any order.  ``df`` must not have columns that begin with
    ``__n_``.
    """
    keys = [F.col(g) for g in group]
    placed = materialise(
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("__n_place", F.monotonically_increasing_id()),
        "numbered",
    ).withColumn("__n_block", F.shiftright("__n_place", 33))
    before = Window.partitionBy(*(f"__n_{i}" for i in range(len(group)))).orderBy("__n_part").rowsBetween(
        Window.unboundedPreceding, -1)
    parts = (
        placed.groupBy(*(key.alias(f"__n_{i}") for i, key in enumerate(keys)), F.col("__n_block").alias("__n_part"))
        .agg(F.count("*").alias("__n_size"), F.min("__n_place").alias("__n_least"))
        .withColumn("__n_shift", F.coalesce(F.sum("__n_size").over(before), F.lit(0)) - F.col("__n_least"))
        .drop("__n_size", "__n_least")
    )
    on = F.col("__n_block") == F.col("__n_part")
    for i, key in enumerate(keys):
        on = on & key.eqNullSafe(F.col(f"__n_{i}"))
    return placed.join(F.broadcast(parts), on).select(
        *(F.col(f"`{c}`") for c in df.columns), (F.col("__n_place") + F.col("__n_shift")).alias(name))


LONG, STRING = LongType(), StringType()


def field(name: str, kind) -> StructField:
    return StructField(name, kind, True)
