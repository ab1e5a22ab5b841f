"""Profiles of the source inputs and chart data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shoplens.constants import (
    CLIP_QUANTILE,
    HISTOGRAM_BINS,
    PLOTTED_TOP_N,
    TOP_PROPERTY_LIMIT,
    TREE_SAMPLE_LIMIT,
)
from shoplens.functions.columns import preferred
from shoplens.functions.values import clip_upper, instant
from shoplens.operators.merge import stack
from shoplens.session import materialise

# --- fixed values: leading columns of the profile report ------------------
PROFILE_COLUMNS = (
    "dataset_name", "row_count", "distinct_visitors", "distinct_items", "distinct_properties",
    "distinct_categories", "distinct_parent_categories", "root_category_rows",
    "rows_with_transaction_id", "rows_without_transaction_id", "null_value_rows",
    "min_timestamp_ms", "max_timestamp_ms", "min_timestamp_datetime", "max_timestamp_datetime",
)


def _with_instants(profile: DataFrame) -> DataFrame:
    return profile.withColumns({
        "min_timestamp_datetime": instant("min_timestamp_ms"),
        "max_timestamp_datetime": instant("max_timestamp_ms"),
    })


def _measured(
    raw: DataFrame, by: list[str], keys: dict[str, str], sums: dict[str, Column], span: str | None, approximate: bool
) -> DataFrame:
    """Sums, an optional time span and distinct counts of several columns per group.

    ``keys``: result name to column. Exact counts first reduce the rows to
    groups of all keys with their sums; each group then gives one row per
    key column, and the keys are counted after one more reduction. So no raw
    row is copied per distinct count, and no group is counted in one task.
    """
    spans = {"min_timestamp_ms": F.min, "max_timestamp_ms": F.max} if span else {}
    if approximate:
        return raw.groupBy(*by).agg(
            *[value.alias(name) for name, value in sums.items()],
            *[F.approx_count_distinct(column).alias(name) for name, column in keys.items()],
            *[end(span).alias(name) for name, end in spans.items()],
        )
    columns = list(keys.values())
    reduced = raw.groupBy(*by, *columns).agg(
        *[value.alias(name) for name, value in sums.items()], *[end(span).alias(name) for name, end in spans.items()]
    )

    # keys of one type stay what they are: numbers take less of a task's memory than their texts
    kinds = set(dict(raw.select(*columns).dtypes).values())

    def entry(place: int, column: str) -> Column:
        kept = [(F.col(name) if place == 0 else F.lit(0).cast("bigint")).alias(name) for name in sums]
        key = F.col(column) if len(kinds) == 1 else F.col(column).cast("string")
        return F.struct(F.lit(place).alias("_kind"), key.alias("_key"), *kept, *map(F.col, spans))

    listed = reduced.select(*by, F.inline(F.array(*[entry(place, column) for place, column in enumerate(columns)])))
    totals = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in sums]
    ends = [end(name).alias(name) for name, end in spans.items()]
    counts = [
        F.count_if((F.col("_kind") == place) & F.col("_key").isNotNull()).alias(name) for place, name in enumerate(keys)
    ]
    return listed.groupBy(*by, "_kind", "_key").agg(*totals, *ends).groupBy(*by).agg(*totals, *counts, *ends)


def profile_events(raw: DataFrame, approximate: bool = False) -> DataFrame:
    """Global profile; ``approximate`` trades exact distinct counts for one pass."""
    sums = {
        "row_count": F.count("*"),
        "rows_with_transaction_id": F.count("transactionid"),
        "rows_without_transaction_id": F.count_if(F.col("transactionid").isNull()),
    }
    keys = {"distinct_visitors": "visitorid", "distinct_items": "itemid"}
    return _with_instants(_measured(raw, [], keys, sums, "timestamp", approximate)).select(
        "row_count", "distinct_visitors", "distinct_items", "min_timestamp_ms", "max_timestamp_ms",
        "rows_with_transaction_id", "rows_without_transaction_id", "min_timestamp_datetime", "max_timestamp_datetime",
    )


def event_type_summary(raw: DataFrame, approximate: bool = False) -> DataFrame:
    sums = {"row_count": F.count("*"), "rows_with_transaction_id": F.count("transactionid")}
    keys = {"distinct_visitors": "visitorid", "distinct_items": "itemid"}
    return (
        _measured(raw, ["event"], keys, sums, None, approximate)
        .select("event", "row_count", "distinct_visitors", "distinct_items", "rows_with_transaction_id")
        .orderBy(F.col("row_count").desc(), F.col("event").asc_nulls_last())
    )


def profile_properties(raw: DataFrame, approximate: bool = False) -> DataFrame:
    sums = {"row_count": F.count("*"), "null_value_rows": F.count_if(F.col("value").isNull())}
    keys = {"distinct_items": "itemid", "distinct_properties": "property"}
    return _with_instants(_measured(raw, [], keys, sums, "timestamp", approximate)).select(
        "row_count", "distinct_items", "distinct_properties", "min_timestamp_ms", "max_timestamp_ms", "null_value_rows",
        "min_timestamp_datetime", "max_timestamp_datetime",
    )


def top_properties(raw: DataFrame, limit: int = TOP_PROPERTY_LIMIT, approximate: bool = False) -> DataFrame:
    keys = {"distinct_items": "itemid", "distinct_values": "value"}
    return (
        _measured(raw, ["property"], keys, {"row_count": F.count("*")}, None, approximate)
        .select("property", "row_count", "distinct_items", "distinct_values")
        .orderBy(F.col("row_count").desc(), F.col("property").asc_nulls_last())
        .limit(limit)
    )


def profile_category_tree(raw: DataFrame) -> DataFrame:
    return raw.agg(
        F.count("*").alias("row_count"),
        F.count_distinct("categoryid").alias("distinct_categories"),
        F.count_distinct("parentid").alias("distinct_parent_categories"),
        F.count_if(F.col("parentid").isNull()).alias("root_category_rows"),
    )


def tree_sample(raw: DataFrame, limit: int = TREE_SAMPLE_LIMIT) -> DataFrame:
    return raw.orderBy("categoryid").limit(limit)


def source_profile(events: DataFrame, properties: DataFrame, tree: DataFrame, approximate: bool = False) -> DataFrame:
    """One row per input, columns that do not apply are NULL."""
    parts = {
        "events": profile_events(events, approximate),
        "item_properties_part1": profile_properties(properties, approximate),
        "category_tree": profile_category_tree(tree),
    }
    named = [frame.withColumn("dataset_name", F.lit(name)) for name, frame in parts.items()]
    return preferred(stack(*named), PROFILE_COLUMNS)


def activity_histogram(users: DataFrame, bins: int = HISTOGRAM_BINS, quantile: float = CLIP_QUANTILE) -> DataFrame:
    """Users per bin of events-per-user, clipped at a quantile.

    Works on the frequency table of the counts, stored once; it stays small
    however many users there are. Columns: bin, bin_start, bin_end, user_count.
    """
    counts = materialise(users.groupBy("total_events").agg(F.count("*").alias("users")), "activity-counts")
    edges = counts.agg(
        F.min("total_events").cast("double").alias("low"),
        F.percentile("total_events", quantile, F.col("users")).alias("high"),
    )
    low, high = edges.select("low").scalar(), edges.select("high").scalar()
    clipped = counts.select(
        clip_upper(F.col("total_events").cast("double"), high).alias("value"), "users", low.alias("low"), high.alias("high")
    )
    width = (F.col("high") - F.col("low")) / bins
    place = F.when(width > 0, F.floor((F.col("value") - F.col("low")) / width)).otherwise(F.lit(0))
    return (
        clipped.withColumn("bin", F.least(place, F.lit(bins - 1)).cast("int"))
        .groupBy("bin", "low", "high")
        .agg(F.sum("users").alias("user_count"))
        .select(
            "bin",
            (F.col("low") + F.col("bin") * width).alias("bin_start"),
            (F.col("low") + (F.col("bin") + 1) * width).alias("bin_end"),
            "user_count",
        )
    )


def event_distribution(raw: DataFrame) -> DataFrame:
    """Rows by type, as in ``event_type_summary`` but without its distinct counts: one row per type is shuffled."""
    counts = raw.groupBy("event").agg(F.count("*").alias("row_count"))
    return counts.orderBy(F.col("row_count").desc(), F.col("event").asc_nulls_last())


def top_item_bars(ranked: DataFrame, limit: int = PLOTTED_TOP_N) -> DataFrame:
    return ranked.where(F.col("rank") <= limit).select(F.col("item_id").cast("string").alias("item_id"), "popularity_score")
