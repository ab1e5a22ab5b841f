"""Data-quality checks on staged and curated datasets.

Each dataset is aggregated once into one row of counters; the counters become
report rows (dataset_name, check_name, status, details).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shoplens.constants import EVENT_TYPES, MIN_COVERAGE, SELECTED_PROPERTIES, VALID_WEIGHTS
from shoplens.functions.columns import missing_columns
from shoplens.plans.curation import metadata_coverage
from shoplens.schemas import QUALITY_ROW, REQUIRED_COLUMNS

PASS, WARN, FAIL = "PASS", "WARN", "FAIL"


def check(name: str, status: Column | str, details: Column | str) -> Column:
    def as_literal(value: Column | str) -> Column:
        return F.lit(value) if isinstance(value, str) else value

    return F.struct(
        F.lit(name).alias("check_name"),
        as_literal(status).alias("status"),
        as_literal(details).alias("details"),
    )


def none_bad(name: str, counter: str, label: str, otherwise: str = FAIL) -> Column:
    """PASS when the counter is zero; details are ``label: counter``."""
    bad = F.coalesce(F.col(counter), F.lit(0))
    return check(name, F.when(bad == 0, PASS).otherwise(otherwise), F.concat(F.lit(f"{label}: "), bad.cast("string")))


def report_rows(dataset: str, counters: DataFrame, checks: list[Column]) -> DataFrame:
    return counters.select(F.lit(dataset).alias("dataset_name"), F.inline(F.array(*checks)))


def presence_checks(dataset: str, df: DataFrame, rows: str = "rows") -> list[Column]:
    missing = missing_columns(df, REQUIRED_COLUMNS[dataset])
    count = F.coalesce(F.col(rows), F.lit(0))
    return [
        check("file_exists", PASS, f"Found dataset: {dataset}"),
        check("read_parquet", PASS, F.concat(count.cast("string"), F.lit(f" rows, {len(df.columns)} columns"))),
        check("required_columns", FAIL, f"Missing columns: {missing}")
        if missing
        else check("required_columns", PASS, "All required columns found"),
        check(
            "row_count_positive",
            F.when(count > 0, PASS).otherwise(FAIL),
            F.concat(F.lit("Found "), count.cast("string"), F.lit(" rows")),
        ),
    ]


def duplicate_event_groups(events: DataFrame) -> DataFrame:
    """Groups of events equal in all five columns, with their size."""
    return (
        events.groupBy("event_timestamp_ms", "visitor_id", "event_type", "item_id", "transaction_id")
        .agg(F.count("*").alias("row_count"))
        .where("row_count > 1")
    )


def _rows_where(condition: Column) -> Column:
    return F.sum(F.when(condition, F.col("_n")).otherwise(F.lit(0)))


def _events(df: DataFrame) -> tuple[DataFrame, list[Column]]:
    # The groups that reveal duplicates also carry every column the other
    # counters need, so the events are scanned and shuffled once.
    groups = df.groupBy("event_timestamp_ms", "visitor_id", "event_type", "item_id", "transaction_id").agg(
        F.count("*").alias("_n"), F.count_if(F.col("event_datetime").isNull()).alias("_no_datetime")
    )
    stamp = F.col("event_timestamp_ms")
    counters = groups.agg(
        F.sum("_n").alias("rows"),
        _rows_where(~F.col("event_type").isin(*EVENT_TYPES)).alias("bad_types"),
        F.sum(F.when(stamp.isNull() | (stamp <= 0), F.col("_n")).otherwise(F.col("_no_datetime"))).alias("bad_stamps"),
        *[_rows_where(F.col(name).isNull()).alias(f"null_{name}") for name in ("visitor_id", "event_type", "item_id")],
        F.count_if(F.col("_n") > 1).alias("duplicates"),
    )
    return counters, [
        none_bad("valid_event_types", "bad_types", "Invalid rows"),
        none_bad("valid_timestamps", "bad_stamps", "Invalid timestamp rows"),
        none_bad("null_visitor_id", "null_visitor_id", "Null rows"),
        none_bad("null_event_type", "null_event_type", "Null rows"),
        none_bad("null_item_id", "null_item_id", "Null rows"),
        none_bad("duplicate_event_rows", "duplicates", "Duplicate event groups", otherwise=WARN),
    ]


def _unique(df: DataFrame, keys: list[str], name: str, label: str) -> tuple[DataFrame, list[Column]]:
    counters = df.groupBy(*keys).agg(F.count("*").alias("_n")).agg(
        F.sum("_n").alias("rows"), F.count_if(F.col("_n") > 1).alias("duplicates")
    )
    return counters, [none_bad(name, "duplicates", label)]


def _batch(df: DataFrame) -> tuple[DataFrame, list[Column]]:
    counters = df.agg(
        F.count("*").alias("rows"), F.count_if(~F.col("property_name").isin(*SELECTED_PROPERTIES)).alias("unexpected")
    )
    return counters, [none_bad("selected_property_names", "unexpected", "Unexpected batch property rows")]


def _delta(df: DataFrame) -> tuple[DataFrame, list[Column]]:
    names = ("property_timestamp_ms", "item_id", "property_name", "property_value")
    counters = df.agg(
        F.count("*").alias("rows"), *[F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in names]
    )
    return counters, [none_bad(f"null_{name}", f"null_{name}", "Null rows") for name in names]


def _combined(df: DataFrame, batch: DataFrame | None, delta: DataFrame | None) -> tuple[DataFrame, list[Column]]:
    stamp = F.col("property_timestamp_ms")
    bad = stamp.isNull() | (stamp <= 0) | F.col("property_datetime").isNull()
    counters = df.agg(F.count("*").alias("rows"), F.count_if(bad).alias("bad_stamps"))
    checks = [none_bad("valid_property_timestamps", "bad_stamps", "Invalid rows")]
    if batch is not None and delta is not None:
        counters = counters.select(
            "*",
            batch.agg(F.count("*")).scalar().alias("batch_rows"),
            delta.agg(F.count("*")).scalar().alias("delta_rows"),
        )
        matches = F.col("batch_rows") + F.col("delta_rows") == F.col("rows")
        text = F.format_string("batch=%d, api=%d, combined=%d", "batch_rows", "delta_rows", "rows")
        checks.insert(0, check("combined_row_count", F.when(matches, PASS).otherwise(FAIL), text))
    return counters, checks


def _availability(df: DataFrame) -> tuple[DataFrame, list[Column]]:
    value = F.col("is_available")
    bad = ~value.isin(0, 1) | value.isNull()
    counters = df.groupBy("item_id").agg(F.count("*").alias("_n"), F.count_if(bad).alias("_bad")).agg(
        F.sum("_n").alias("rows"), F.count_if(F.col("_n") > 1).alias("duplicates"), F.sum("_bad").alias("bad_values")
    )
    return counters, [
        none_bad("unique_item_id", "duplicates", "Duplicate item IDs"),
        none_bad("valid_availability_values", "bad_values", "Invalid availability rows"),
    ]


def _weights(df: DataFrame) -> tuple[DataFrame, list[Column]]:
    counters = df.agg(
        F.count("*").alias("rows"), F.count_if(~F.col("interaction_weight").isin(*VALID_WEIGHTS)).alias("bad_weights")
    )
    return counters, [none_bad("valid_interaction_weights", "bad_weights", "Invalid weights")]


def _dataset_rules(name: str, df: DataFrame, datasets: Mapping[str, DataFrame]) -> tuple[DataFrame, list[Column]]:
    if name == "events":
        return _events(df)
    if name == "category_tree":
        return _unique(df, ["category_id"], "unique_category_id", "Duplicate category IDs")
    if name == "item_properties_batch":
        return _batch(df)
    if name == "item_properties_api_delta":
        return _delta(df)
    if name == "item_properties_combined":
        return _combined(df, datasets.get("item_properties_batch"), datasets.get("item_properties_api_delta"))
    if name == "item_availability_latest":
        return _availability(df)
    if name == "curated_interactions":
        return _weights(df)
    if name == "curated_user_item_interactions":
        return _unique(df, ["user_id", "item_id"], "unique_user_item_key", "Duplicate user-item keys")
    return _unique(df, ["item_id"], "unique_item_id", "Duplicate item IDs")


def coverage_report(coverage: DataFrame) -> DataFrame:
    """WARN when under half of the event items have a category or an availability."""
    total = F.col("event_distinct_items")

    def covered(name: str, counter: str) -> Column:
        ratio = F.when(total > 0, F.col(counter) / total).otherwise(0.0)
        status = F.when(ratio >= MIN_COVERAGE, PASS).otherwise(WARN)
        return check(name, status, F.format_string("%d/%d (%.4f)", F.col(counter), total, ratio))

    return report_rows(
        "referential_coverage",
        coverage,
        [
            covered("event_items_with_category", "items_with_category"),
            covered("event_items_with_availability", "items_with_availability"),
        ],
    )


def readable(load: Callable[[], DataFrame]) -> tuple[DataFrame | None, str | None]:
    """The dataset that ``load`` gives, or the reason why it cannot be read: its schema, or the footer of any of its files."""
    try:
        df = load()
        df.agg(F.count("*")).collect()  # no column is read
        return df, None
    except (AnalysisException, Py4JError, PySparkException) as error:
        return None, str(error).strip().splitlines()[0]


def quality_report(
    spark: SparkSession, datasets: Mapping[str, DataFrame], unreadable: Mapping[str, str] | None = None
) -> DataFrame:
    """All checks on the given datasets; a dataset that is absent fails once.

    A dataset that lacks required columns gets its presence rows only, and one
    of ``unreadable`` (name and reason, see ``readable``) a failed read.
    """
    parts: list[DataFrame] = []
    unreadable = unreadable or {}
    for name in REQUIRED_COLUMNS:
        df = datasets.get(name)
        if name in unreadable:
            parts.append(spark.createDataFrame([
                (name, "file_exists", PASS, f"Found dataset: {name}"), (name, "read_parquet", FAIL, unreadable[name])], QUALITY_ROW))
        elif df is None:
            parts.append(
                spark.createDataFrame([(name, "file_exists", FAIL, f"Missing dataset: {name}")], QUALITY_ROW)
            )
        elif missing_columns(df, REQUIRED_COLUMNS[name]):
            parts.append(report_rows(name, df.agg(F.count("*").alias("rows")), presence_checks(name, df)))
        else:
            counters, checks = _dataset_rules(name, df, datasets)
            parts.append(report_rows(name, counters, presence_checks(name, df) + checks))
    needed = ("events", "item_category_latest", "item_availability_latest")
    absent = [name for name in needed if datasets.get(name) is None]
    if absent:
        missing = f"{'Unreadable' if set(absent) <= set(unreadable) else 'Missing'} dataset: {', '.join(absent)}"
        parts.append(spark.createDataFrame([("referential_coverage", "file_exists", FAIL, missing)], QUALITY_ROW))
    else:
        parts.append(coverage_report(metadata_coverage(*[datasets[name] for name in needed])))
    return reduce(DataFrame.unionByName, parts)


def status_counts(report: DataFrame) -> DataFrame:
    return report.groupBy("status").agg(F.count("*").alias("check_count"))


def problems(report: DataFrame, *statuses: str) -> DataFrame:
    return report.where(F.col("status").isin(*(statuses or (WARN, FAIL))))


def require_passed(report: DataFrame) -> None:
    """Raise when any check failed; warnings pass."""
    failed = problems(report, FAIL).count()
    if failed:
        raise RuntimeError(f"validation failed with {failed} failed checks")
