"""Feature registry: views, their description, and retrieval by entity key."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shoplens.functions.columns import column_role, row_as_json


@dataclass(frozen=True)
class FeatureView:
    name: str
    entity_keys: tuple[str, ...]
    source_table: str
    transformation: str
    description: str
    used_for: tuple[str, ...] = ("training", "inference", "profiling")
    version: str = "v1"
    created_by: str = "shoplens.plans.features"


REGISTRY_NAME = "recommendation_feature_registry"
REGISTRY_VERSION = "v1"

USER_VIEW = FeatureView(
    "user_features", ("user_id",), "features.user_features",
    "User rollup of the pair table plus activity span and event-type rates.",
    "How active each user is and how often that leads to carts and purchases.",
)
ITEM_VIEW = FeatureView(
    "item_features", ("item_id",), "features.item_features",
    "Item rollup of the pair table joined to the latest category and availability, plus conversion rates.",
    "Demand, conversion and metadata of each item.",
    ("training", "inference", "profiling", "candidate filtering"),
)
USER_ITEM_VIEW = FeatureView(
    "user_item_features", ("user_id", "item_id"), "features.user_item_features",
    "Pair table with item metadata, pair conversion rates and an implicit label.",
    "What each user did with each item, labelled by the strongest event.",
)
VIEWS = (USER_VIEW, ITEM_VIEW, USER_ITEM_VIEW)


def find_view(name: str) -> FeatureView:
    for view in VIEWS:
        if view.name == name:
            return view
    raise ValueError(f"unknown feature view: {name}")


def _described(view: FeatureView) -> list[Column]:
    return [
        F.lit(REGISTRY_NAME).alias("registry_name"),
        F.lit(REGISTRY_VERSION).alias("registry_version"),
        F.lit(view.name).alias("feature_view_name"),
        F.lit(view.version).alias("feature_view_version"),
        F.lit(json.dumps(list(view.entity_keys))).alias("entity_keys"),
        F.lit(view.source_table).alias("source_table"),
    ]


def _explained(view: FeatureView) -> list[Column]:
    return [
        F.lit(view.transformation).alias("transformation"),
        F.lit(", ".join(view.used_for)).alias("used_for"),
        F.lit(view.created_by).alias("created_by"),
        F.lit(view.description).alias("description"),
    ]


def _keys(view: FeatureView) -> Column:
    return F.array(*[F.lit(key) for key in view.entity_keys])


def schema_rows(spark: SparkSession, view: FeatureView, df: DataFrame) -> DataFrame:
    """One row per column: name, position, type, role."""
    fields = [(field.name, place, field.dataType.simpleString()) for place, field in enumerate(df.schema.fields, 1)]
    rows = spark.createDataFrame(fields, "column_name string, ordinal_position int, data_type string")
    return rows.withColumn("feature_role", column_role("column_name", _keys(view)))


def _view_summary(spark: SparkSession, view: FeatureView, df: DataFrame | None) -> DataFrame:
    if df is None:
        return spark.range(1).select(
            *_described(view), F.lit(False).alias("source_exists"), F.lit(0).alias("feature_count"),
            F.lit("").alias("feature_names"), F.lit("{}").alias("data_types"), F.lit("{}").alias("feature_roles"),
            F.lit(None).cast("bigint").alias("row_count"), F.lit(None).cast("bigint").alias("distinct_keys"),
            *_explained(view),
        )
    schema = schema_rows(spark, view, df)
    is_feature = F.col("feature_role") != "entity_key"

    def as_object(value: str) -> Column:
        entries = F.array_sort(F.collect_list(F.struct("column_name", value)))
        return F.to_json(F.map_from_entries(entries))

    described = schema.agg(
        F.count_if(is_feature).cast("int").alias("feature_count"),
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.when(is_feature, F.struct("ordinal_position", "column_name")))),
                lambda pair: pair["column_name"],
            ),
            ", ",
        ).alias("feature_names"),
        as_object("data_type").alias("data_types"),
        as_object("feature_role").alias("feature_roles"),
    )
    # Key uniqueness by grouping on the key: partial counts, no distinct pass.
    measured = df.groupBy(*view.entity_keys).agg(F.count("*").alias("_n")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"), F.count("*").alias("distinct_keys")
    )
    return described.select(
        *_described(view),
        F.lit(True).alias("source_exists"),
        *described.columns,
        measured.select("row_count").scalar().alias("row_count"),
        measured.select("distinct_keys").scalar().alias("distinct_keys"),
        *_explained(view),
    )


def registry_summary(
    spark: SparkSession, sources: Mapping[str, DataFrame], views: Sequence[FeatureView] | None = None
) -> DataFrame:
    """One row per view, by default the registered ones; a view without a source is marked as such."""
    return reduce(
        DataFrame.unionByName, [_view_summary(spark, view, sources.get(view.name)) for view in (views or VIEWS)]
    )


def _cells(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """ordinal_position and one column per type: every value of every row, in the column of its type; their names.

    Values keep their types, as text costs more to make and to compare than a number. ``UNPIVOT`` makes the rows inside
    the task that has the row, so ``df`` is read once.
    """
    kinds = list(dict.fromkeys(field.dataType for field in df.schema.fields))
    typed = [f"as_{number}" for number in range(len(kinds))]
    places = range(1, len(df.columns) + 1)
    wide = df.select(
        *[F.col(name).alias(f"column_{place}") for place, name in zip(places, df.columns)],
        *[F.lit(place).alias(f"place_{place}") for place in places],
        *[F.lit(None).cast(kind).alias(f"no_{number}") for number, kind in enumerate(kinds)],
    )
    cells = ", ".join(
        "(" + ", ".join([f"place_{place}", *[
            f"column_{place}" if field.dataType == kind else f"no_{number}" for number, kind in enumerate(kinds)
        ]]) + ")"
        for place, field in zip(places, df.schema.fields)
    )
    names = ", ".join(["ordinal_position", *typed])
    query = f"SELECT {names} FROM {{wide}} UNPIVOT INCLUDE NULLS (({names}) FOR place IN ({cells}))"
    return df.sparkSession.sql(query, wide=wide), typed


def column_statistics(df: DataFrame) -> DataFrame:
    """ordinal_position, null_rate, distinct_values, min_value, max_value: exact, none for a table without rows.

    All follow from the distinct values of each column and how often they occur: one pass over ``df``, whose shuffle has
    what is distinct in a task.
    """
    cells, typed = _cells(df)
    is_null = reduce(lambda left, right: left & right, [F.col(name).isNull() for name in typed])
    values = cells.groupBy("ordinal_position", *typed).agg(F.count("*").alias("_n")).withColumn("_is_null", is_null)

    def extreme(function: Callable[[str], Column]) -> Column:
        return F.coalesce(*[function(name).cast("string") for name in typed])

    return values.groupBy("ordinal_position").agg(
        (F.sum(F.when(F.col("_is_null"), F.col("_n")).otherwise(0)) / F.sum("_n")).alias("null_rate"),
        F.count_if(~F.col("_is_null")).alias("distinct_values"),
        extreme(F.min).alias("min_value"),
        extreme(F.max).alias("max_value"),
    )


def _view_documentation(spark: SparkSession, view: FeatureView, df: DataFrame | None) -> DataFrame:
    if df is None:
        nothing = F.lit(None).cast("string")
        return spark.range(1).select(
            *_described(view), F.lit(False).alias("source_exists"), F.lit("").alias("column_name"),
            F.lit(0).alias("ordinal_position"), F.lit("").alias("data_type"),
            F.lit("missing_source_file").alias("feature_role"), F.lit(None).cast("double").alias("null_rate"),
            F.lit(None).cast("bigint").alias("distinct_values"), nothing.alias("min_value"), nothing.alias("max_value"),
            *_explained(view),
        )
    known = schema_rows(spark, view, df).join(column_statistics(df), "ordinal_position", "left")
    return known.withColumn("distinct_values", F.coalesce("distinct_values", F.lit(0))).select(
        *_described(view), F.lit(True).alias("source_exists"), "column_name", "ordinal_position", "data_type",
        "feature_role", "null_rate", "distinct_values", "min_value", "max_value", *_explained(view),
    )


def feature_documentation(
    spark: SparkSession, sources: Mapping[str, DataFrame], views: Sequence[FeatureView] | None = None
) -> DataFrame:
    """One row per column of every view, by default the registered ones, with role and measured statistics."""
    return reduce(
        DataFrame.unionByName, [_view_documentation(spark, view, sources.get(view.name)) for view in (views or VIEWS)]
    )


def point_lookup(source: DataFrame, view: FeatureView, columns: list[str] | None = None, **entity: int) -> DataFrame:
    """Features of one entity, at most one row; the key filter reaches the scan."""
    if set(entity) != set(view.entity_keys):
        raise ValueError(f"{view.name} is keyed by {view.entity_keys}")
    condition = reduce(lambda left, right: left & right, [F.col(key) == value for key, value in entity.items()])
    found = source.where(condition).limit(1)
    return found.select(*columns) if columns else found


def retrieve(entities: DataFrame, source: DataFrame, view: FeatureView, columns: list[str] | None = None) -> DataFrame:
    """Features for a table of entity keys; unknown keys keep a row of NULLs."""
    keys = list(view.entity_keys)
    wanted = [name for name in (columns or source.columns) if name not in keys]
    return entities.join(source.select(*keys, *wanted), keys, "left")


def sample_pair(user_items: DataFrame) -> DataFrame:
    """The strongest pair: bought, then carted, then score, then lowest ids."""
    return user_items.select("user_id", "item_id", "interaction_score", "has_transaction", "has_addtocart").orderBy(
        F.col("has_transaction").desc(), F.col("has_addtocart").desc(), F.col("interaction_score").desc(),
        F.col("user_id").asc(), F.col("item_id").asc(),
    ).limit(1)


def retrieval_summary(entity: DataFrame, source: DataFrame, view: FeatureView) -> DataFrame:
    """What a retrieval of one entity returned, values as a JSON object.

    ``entity`` holds one row of keys; no match gives zero rows and ``{}``.
    """
    keys = list(view.entity_keys)
    found = source.join(F.broadcast(entity.select(*keys).limit(1)), keys, "left_semi").limit(1)
    entity_filter = F.concat_ws(",", *[F.concat(F.lit(f"{key}="), F.col(key).cast("string")) for key in keys])
    return entity.limit(1).select(
        F.lit(view.name).alias("retrieval_type"),
        F.lit(view.name).alias("feature_view_name"),
        F.lit(view.version).alias("feature_view_version"),
        entity_filter.alias("entity_filter"),
        found.agg(F.count("*")).scalar().alias("rows_returned"),
        F.lit(len(source.columns)).alias("columns_returned"),
        F.coalesce(found.select(row_as_json(found)).scalar(), F.lit("{}")).alias("sample_values_json"),
    )
