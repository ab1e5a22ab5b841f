"""Library functions over the test tables, one callable per registered query."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shoplens import constants as C
from shoplens.operators.fingerprint import fingerprint_columns
from shoplens.operators.merge import replace_by_key, stack
from shoplens.operators.rollup import pair_rollup
from shoplens.plans import comparison, content, expectations, popularity, profiling, registry, serving, split, training
from shoplens.plans import curation, features, latest, raw_checks, staging
from shoplens.session import delete_path, materialise, scratch_path, use_utc
from shoplens.sinks import landing as landing_sink, reports, tables
from shoplens.sources import blocks, external, landing as landing_source, payloads
from shoplens.sources.fixtures import FixtureTables
from shoplens.streaming.delta import append_delta, read_delta_stream
from shoplens.streaming.latest_state import LatestPropertyState
from shoplens.streaming.responses import ResponseSplit

TEST_DAYS = {"clicks": 7, "orders": 180}

# bounds that a caller may choose, below the number of users and items of every folder
SAMPLE_USERS, HEAD_ITEMS = 25, 100


def comparable(df: DataFrame) -> DataFrame:
    """Doubles at six decimals and instants as UTC text, for exact comparison."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = F.round(column, 6)
        elif isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSS")
        columns.append(column.alias(field.name))
    return df.select(*columns)


class Lab:
    """The layers over one folder of test tables, for one event source."""

    def __init__(self, spark: SparkSession, folder: str, source: str = "orders"):
        self.spark = use_utc(spark)
        self.fixtures = FixtureTables(spark, folder)
        self.source = source
        self.days = TEST_DAYS[source]

    @cached_property
    def raw_events(self) -> DataFrame:
        return self.fixtures.order_events() if self.source == "orders" else self.fixtures.click_events()

    @cached_property
    def raw_properties(self) -> DataFrame:
        return self.fixtures.item_properties()

    @cached_property
    def events(self) -> DataFrame:
        return staging.stage_events(self.raw_events, self.source)

    @cached_property
    def tree(self) -> DataFrame:
        return staging.stage_category_tree(self.fixtures.category_tree(), "tree")

    @cached_property
    def batch(self) -> DataFrame:
        return staging.stage_properties_batch(
            self.raw_properties.where(F.col("source_system") == C.BATCH_SOURCE), "batch"
        )

    @cached_property
    def delta(self) -> DataFrame:
        return staging.stage_properties_delta(self.raw_properties.where(F.col("source_system") == C.API_SOURCE), "delta")

    @cached_property
    def combined(self) -> DataFrame:
        return staging.combine_properties(self.batch, self.delta)

    @cached_property
    def category_latest(self) -> DataFrame:
        return latest.item_category_latest(self.combined)

    @cached_property
    def availability_latest(self) -> DataFrame:
        return latest.item_availability_latest(self.combined)

    @cached_property
    def metadata(self) -> DataFrame:
        return curation.item_metadata(self.category_latest, self.availability_latest, self.tree)

    @cached_property
    def stored_metadata(self) -> DataFrame:
        """Metadata as the table that training and serving read several times."""
        return materialise(self.metadata, "metadata")

    @cached_property
    def interactions(self) -> DataFrame:
        return curation.as_interactions(self.events)

    @cached_property
    def stored_interactions(self) -> DataFrame:
        """Interactions as the table that window, split, training and history read one after the other."""
        return materialise(self.interactions, "interactions")

    @cached_property
    def pairs(self) -> DataFrame:
        return curation.event_pairs(self.events)

    @cached_property
    def items(self) -> DataFrame:
        return curation.curated_items(self.pairs, self.metadata)

    @cached_property
    def user_items(self) -> DataFrame:
        return curation.curated_user_items(self.pairs, self.metadata)

    @cached_property
    def user_view(self) -> DataFrame:
        return features.user_features(features.mart_user_features(self.pairs))

    @cached_property
    def item_view(self) -> DataFrame:
        return features.item_features(features.mart_item_features(self.items))

    @cached_property
    def user_item_view(self) -> DataFrame:
        return features.user_item_features(self.user_items)

    @cached_property
    def stored_pairs(self) -> DataFrame:
        return materialise(self.pairs, "pairs")

    @cached_property
    def stored_user_view(self) -> DataFrame:
        return materialise(features.user_features(features.mart_user_features(self.stored_pairs)), "users")

    @cached_property
    def stored_item_view(self) -> DataFrame:
        items = curation.curated_items(self.stored_pairs, self.stored_metadata)
        return materialise(features.item_features(features.mart_item_features(items)), "items")

    @cached_property
    def stored_user_item_view(self) -> DataFrame:
        user_items = curation.curated_user_items(self.stored_pairs, self.stored_metadata)
        return materialise(features.user_item_features(user_items), "user-items")

    @property
    def stored_views(self) -> dict[str, DataFrame]:
        """The feature views as the tables that retrieval and reports read."""
        return {
            "user_features": self.stored_user_view,
            "item_features": self.stored_item_view,
            "user_item_features": self.stored_user_item_view,
        }

    @property
    def views(self) -> dict[str, DataFrame]:
        """The feature views over the stored pairs, for what reads each of them once."""
        items = curation.curated_items(self.stored_pairs, self.stored_metadata)
        user_items = curation.curated_user_items(self.stored_pairs, self.stored_metadata)
        return {
            "user_features": features.user_features(features.mart_user_features(self.stored_pairs)),
            "item_features": features.item_features(features.mart_item_features(items)),
            "user_item_features": features.user_item_features(user_items),
        }

    @cached_property
    def window(self) -> split.Window:
        return split.find_window(self.stored_interactions, self.days)

    def split(self, rule: split.SplitRule) -> DataFrame:
        return split.split_pairs(self.stored_interactions, self.window, rule)

    def train_split(self, rule: split.SplitRule) -> DataFrame:
        return split.train_split(self.stored_interactions, self.window, rule)

    @cached_property
    def scored_items(self) -> DataFrame:
        return popularity.score_items(self.train_split(split.POPULARITY_RULE), self.metadata)

    @cached_property
    def popularity_model(self) -> DataFrame:
        return popularity.rank_items(self.scored_items)

    @cached_property
    def content_model(self) -> DataFrame:
        rows = content.candidate_items(self.train_split(split.CONTENT_RULE), self.stored_metadata)
        return materialise(rows, "model")

    @cached_property
    def history(self) -> DataFrame:
        return materialise(serving.full_history(self.stored_interactions), "history")

    @cached_property
    def popularity(self) -> training.Training:
        return training.train_popularity(self.stored_interactions, self.metadata, test_days=self.days)

    @cached_property
    def content(self) -> training.Training:
        return training.train_content(self.stored_interactions, self.stored_metadata, test_days=self.days)

    @cached_property
    def stored_datasets(self) -> dict[str, DataFrame]:
        """What the quality checks read: layers that others build on are stored once."""
        events, combined = materialise(self.events, "events"), materialise(self.combined, "combined")
        categories = materialise(latest.item_category_latest(combined), "categories")
        availability = materialise(latest.item_availability_latest(combined), "availability")
        metadata = materialise(curation.item_metadata(categories, availability, self.tree), "metadata")
        pairs = materialise(curation.event_pairs(events), "pairs")
        is_batch = F.col("source_system") == C.BATCH_SOURCE
        return {
            "events": events,
            "category_tree": self.tree,
            "item_properties_batch": combined.where(is_batch).drop("ingestion_timestamp"),
            "item_properties_api_delta": combined.where(~is_batch),
            "item_properties_combined": combined,
            "item_category_latest": categories,
            "item_availability_latest": availability,
            "curated_interactions": curation.curated_interactions(events, metadata),
            "curated_items": curation.curated_items(pairs, metadata),
            "curated_user_item_interactions": curation.curated_user_items(pairs, metadata),
        }


# --- staging --------------------------------------------------------------

def stage_events(lab: Lab) -> DataFrame:
    return lab.events


def stage_category_tree(lab: Lab) -> DataFrame:
    return lab.tree


def stage_item_properties_batch(lab: Lab) -> DataFrame:
    return lab.batch


def stage_item_properties_delta(lab: Lab) -> DataFrame:
    return lab.delta


def combined_properties(lab: Lab) -> DataFrame:
    return lab.combined


def item_category_latest(lab: Lab) -> DataFrame:
    return lab.category_latest


def item_availability_latest(lab: Lab) -> DataFrame:
    return lab.availability_latest


# --- curation, marts, features ---------------------------------------------

def curated_interactions(lab: Lab) -> DataFrame:
    return curation.curated_interactions(lab.events, lab.metadata)


def curated_items(lab: Lab) -> DataFrame:
    return lab.items


def curated_user_items(lab: Lab) -> DataFrame:
    return lab.user_items


def mart_user_features(lab: Lab) -> DataFrame:
    return features.mart_user_features(lab.pairs)


def mart_item_features(lab: Lab) -> DataFrame:
    return features.mart_item_features(lab.items)


def user_features(lab: Lab) -> DataFrame:
    return lab.user_view


def item_features(lab: Lab) -> DataFrame:
    return lab.item_view


def user_item_features(lab: Lab) -> DataFrame:
    return lab.user_item_view


# --- profiles ---------------------------------------------------------------

def profile_events(lab: Lab) -> DataFrame:
    return profiling.profile_events(lab.raw_events)


def event_type_summary(lab: Lab) -> DataFrame:
    return profiling.event_type_summary(lab.raw_events)


def profile_properties(lab: Lab) -> DataFrame:
    return profiling.profile_properties(lab.raw_properties)


def top_properties(lab: Lab) -> DataFrame:
    return profiling.top_properties(lab.raw_properties)


def category_profile(lab: Lab) -> DataFrame:
    return profiling.profile_category_tree(lab.fixtures.category_tree())


def category_tree_sample(lab: Lab) -> DataFrame:
    return profiling.tree_sample(lab.fixtures.category_tree())


def source_profile(lab: Lab) -> DataFrame:
    return profiling.source_profile(lab.raw_events, lab.raw_properties, lab.fixtures.category_tree())


def event_distribution(lab: Lab) -> DataFrame:
    return profiling.event_distribution(lab.raw_events)


def activity_histogram(lab: Lab) -> DataFrame:
    return profiling.activity_histogram(lab.user_view)


def top_item_bars(lab: Lab) -> DataFrame:
    return profiling.top_item_bars(popularity.top_items(lab.scored_items, C.PLOTTED_TOP_N))


# --- expectations -------------------------------------------------------------

def quality_report(lab: Lab) -> DataFrame:
    return expectations.quality_report(lab.spark, lab.stored_datasets)


def quality_status(lab: Lab) -> DataFrame:
    return expectations.status_counts(expectations.quality_report(lab.spark, lab.stored_datasets))


def quality_problems(lab: Lab) -> DataFrame:
    return expectations.problems(expectations.quality_report(lab.spark, lab.stored_datasets))


def duplicate_events(lab: Lab) -> DataFrame:
    return expectations.duplicate_event_groups(lab.events)


def referential_coverage(lab: Lab) -> DataFrame:
    return curation.metadata_coverage(lab.events, lab.category_latest, lab.availability_latest)


# --- split, targets -----------------------------------------------------------

def time_bounds(lab: Lab) -> DataFrame:
    return split.time_bounds(lab.interactions)


def train_test_counts(lab: Lab) -> DataFrame:
    return split.event_counts(lab.split(split.POPULARITY_RULE))


def test_targets_latest(lab: Lab) -> DataFrame:
    return split.test_targets(lab.split(split.POPULARITY_RULE), split.POPULARITY_RULE)


def test_targets_earliest(lab: Lab) -> DataFrame:
    return split.test_targets(lab.split(split.CONTENT_RULE), split.CONTENT_RULE)


def scattered_user_sample(lab: Lab) -> DataFrame:
    return split.test_targets(lab.split(split.POPULARITY_RULE), split.POPULARITY_RULE, SAMPLE_USERS)


def first_user_sample(lab: Lab) -> DataFrame:
    return split.test_targets(lab.split(split.CONTENT_RULE), split.CONTENT_RULE, SAMPLE_USERS)


def train_seen_items(lab: Lab) -> DataFrame:
    pairs = materialise(lab.split(split.POPULARITY_RULE), "split")
    return split.seen_by(pairs, split.test_targets(pairs, split.POPULARITY_RULE)).select("user_id", "item_id")


# --- popularity -----------------------------------------------------------------

def popularity_topn(lab: Lab) -> DataFrame:
    return popularity.top_items(lab.scored_items, C.TOP_K)


def popularity_ranking(lab: Lab) -> DataFrame:
    return popularity.rank_items(lab.scored_items)


def popularity_metrics(lab: Lab) -> DataFrame:
    return lab.popularity.metrics


def popularity_metrics_sampled(lab: Lab) -> DataFrame:
    """Metrics over a sample of users, smaller than the users there are."""
    run = training.train_popularity(lab.stored_interactions, lab.metadata, test_days=lab.days, sample_users=SAMPLE_USERS)
    return run.metrics


def popularity_summary(lab: Lab) -> DataFrame:
    return lab.popularity.summary


def popularity_examples(lab: Lab) -> DataFrame:
    return lab.popularity.examples


def active_users(lab: Lab) -> DataFrame:
    return serving.active_users(lab.user_view)


def popularity_recommendations(lab: Lab) -> DataFrame:
    return serving.recommend_popularity(lab.history.select("user_id"), lab.history, lab.popularity_model)


def popularity_recommendations_head(lab: Lab) -> DataFrame:
    """Lists from the first items only: users who have seen many of them get fewer rows."""
    return serving.recommend_popularity(lab.history.select("user_id"), lab.history, lab.popularity_model, n=HEAD_ITEMS)


# --- content ----------------------------------------------------------------------

def content_candidates(lab: Lab) -> DataFrame:
    return content.candidate_items(lab.train_split(split.CONTENT_RULE), lab.metadata)


def user_profiles(lab: Lab) -> DataFrame:
    return content.user_profiles(serving.full_history(lab.interactions), lab.metadata)


def content_recommendations(lab: Lab) -> DataFrame:
    return serving.recommend_content(lab.history.select("user_id"), lab.history, lab.stored_metadata, lab.content_model)


def content_recommendations_head(lab: Lab) -> DataFrame:
    return serving.recommend_content(
        lab.history.select("user_id"), lab.history, lab.stored_metadata, lab.content_model, n=HEAD_ITEMS
    )


def content_metrics_sampled(lab: Lab) -> DataFrame:
    run = training.train_content(lab.stored_interactions, lab.stored_metadata, test_days=lab.days, sample_users=SAMPLE_USERS)
    return run.metrics


def content_metrics(lab: Lab) -> DataFrame:
    return lab.content.metrics


def content_summary(lab: Lab) -> DataFrame:
    return lab.content.summary


def content_examples(lab: Lab) -> DataFrame:
    return lab.content.examples


def active_user_recommendations(lab: Lab) -> DataFrame:
    """Both models for the default active users, in the common schema."""
    pairs = pair_rollup(lab.stored_interactions, C.CURATED_UNKNOWN_WEIGHT)
    users = materialise(serving.active_users(features.user_features(features.mart_user_features(pairs))), "users")
    theirs = lab.stored_interactions.join(users.select("user_id"), "user_id", "left_semi")
    history = materialise(serving.full_history(theirs), "history")
    return stack(
        serving.recommend_popularity(users, history, lab.popularity_model),
        serving.recommend_content(users, history, lab.stored_metadata, lab.content_model),
    )


# --- feature registry -------------------------------------------------------------

def feature_retrieval(lab: Lab) -> DataFrame:
    """User features for every customer key, known to the events or not."""
    keys = lab.fixtures.table("customer").select(F.col("c_custkey").alias("user_id"))
    columns = ["total_events", "unique_items", "total_interaction_score", "active_days", "events_per_unique_item"]
    return registry.retrieve(keys, lab.user_view, registry.USER_VIEW, columns)


def feature_point_lookup(lab: Lab) -> DataFrame:
    """The strongest pair, looked up in the view as it is stored for lookups."""
    store = tables.LayerStore(lab.spark, scratch_path(lab.spark, "store"))
    source = store.save_keyed(lab.user_item_view, "features", registry.USER_ITEM_VIEW.name, registry.USER_ITEM_VIEW.entity_keys)
    pair = registry.sample_pair(source).first()
    return registry.point_lookup(source, registry.USER_ITEM_VIEW, user_id=pair["user_id"], item_id=pair["item_id"])


def sample_pair(lab: Lab) -> DataFrame:
    return registry.sample_pair(lab.user_item_view)


def retrieval_summary(lab: Lab) -> DataFrame:
    """Retrieval of the strongest pair; two values are read back from the JSON."""
    pair = materialise(registry.sample_pair(lab.stored_views["user_item_features"]), "pair")
    parts = [registry.retrieval_summary(pair, lab.stored_views[view.name], view) for view in registry.VIEWS]
    values = F.col("sample_values_json")
    return stack(*parts).select(
        "retrieval_type", "feature_view_name", "feature_view_version", "entity_filter", "rows_returned", "columns_returned",
        F.get_json_object(values, "$.total_events").alias("total_events"),
        F.get_json_object(values, "$.first_event_timestamp_ms").alias("first_event_timestamp_ms"),
    )


def registry_summary(lab: Lab) -> DataFrame:
    return registry.registry_summary(lab.spark, lab.stored_views).select(
        "feature_view_name", "feature_view_version", "entity_keys", "source_table", "source_exists", "feature_count",
        "feature_names", "data_types", "feature_roles", "row_count", "distinct_keys",
    )


def feature_documentation(lab: Lab) -> DataFrame:
    """Every column with type, role, exact statistics and extremes; doubles as numbers, instants as text."""
    kind = F.col("data_type")
    extremes = []
    for name in ("min", "max"):
        value = F.col(f"{name}_value")
        instant = F.date_format(F.when(kind == "timestamp", value).cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSS")
        extremes += [F.when(kind == "timestamp", instant).when(kind != "double", value).alias(f"{name}_value"),
                     F.when(kind == "double", value).cast("double").alias(f"{name}_number")]
    return registry.feature_documentation(lab.spark, lab.views).select(
        "feature_view_name", "column_name", "ordinal_position", "data_type", "feature_role", "null_rate", "distinct_values", *extremes)


# --- comparison and reports ---------------------------------------------------------

def _comparison(lab: Lab) -> DataFrame:
    return comparison.compare_models(
        comparison.labelled(lab.popularity.summary, C.POPULARITY_FAMILY, "models/popularity_items", "models/popularity_summary"),
        comparison.labelled(lab.content.summary, C.CONTENT_FAMILY, "models/content_candidates", "models/content_summary"),
    )


def model_comparison(lab: Lab) -> DataFrame:
    return _comparison(lab)


def metric_matrix(lab: Lab) -> DataFrame:
    return comparison.metric_matrix(materialise(_comparison(lab), "comparison"), [C.POPULARITY_FAMILY, C.CONTENT_FAMILY])


def inference_summary(lab: Lab) -> DataFrame:
    users = lab.history.select("user_id").distinct()
    lists = materialise(serving.recommend_popularity(users, lab.history, lab.popularity.model), "lists")
    return serving.inference_summary(
        C.POPULARITY_KEY, users, lists, lab.popularity.summary, "models/popularity_items", C.SERVING_TOP_K
    )


def report_merge(lab: Lab) -> DataFrame:
    """A popularity rerun replaces its rows in a report of both models.

    The old report also has rows without a model key, which are dropped.
    """
    def rows(table: DataFrame, key, count: str) -> DataFrame:
        return table.groupBy("item_id").agg(F.count("*").alias(count)).withColumn("model_key", key)

    pairs = materialise(lab.pairs.select("user_id", "item_id", "transaction_count"), "pairs")
    old_keys = F.when(F.col("item_id") % 4 == 0, "popularity").when(F.col("item_id") % 4 == 1, " ").when(
        F.col("item_id") % 4 == 2, "content_based"
    )
    existing = rows(pairs, old_keys, "old_users")
    current = rows(pairs.where("transaction_count > 0"), F.lit("popularity"), "new_users")
    return replace_by_key(existing, current, "model_key", "popularity")


# --- landing ---------------------------------------------------------------------------

STAMPS = ("20260101_000000", "20260101_003000", "20260101_010000", "20260101_013000", "20260101_020000")


def _delta_rows(lab: Lab) -> DataFrame:
    """The api rows with the stamp of the partition that they are landed in."""
    stamp = F.element_at(F.array(*map(F.lit, STAMPS)), (F.col("seq") % len(STAMPS) + 1).cast("int"))
    return lab.raw_properties.where(F.col("source_system") == C.API_SOURCE).select(
        "timestamp", "itemid", "property", "value", "source_system", "seq", stamp.alias("ingestion_timestamp"))


def _land_deltas(lab: Lab, formats: tuple[str, ...] = ("parquet",)) -> str:
    """The api rows landed as five delta partitions; returns the raw root."""
    root = scratch_path(lab.spark, "raw")
    facts = lab.spark.createDataFrame(
        [(stamp, payloads.RECORDS_CONTRACT, True, str(part) if part < 4 else None) for part, stamp in enumerate(STAMPS)],
        "ingestion_timestamp string, api_contract string, api_success boolean, cursor string")
    landing_sink.land_partitions(_delta_rows(lab), root, C.DELTA_FEED, C.API_SOURCE, formats, facts=facts)
    return root


_SEQ = T.StructField("seq", T.LongType())


def _delta_schema() -> T.StructType:
    from shoplens.schemas import DELTA_RECORD

    return T.StructType([*DELTA_RECORD.fields, _SEQ])


def landing_manifest(lab: Lab) -> DataFrame:
    manifest = landing_source.read_manifest(lab.spark, _land_deltas(lab), required=True)
    return manifest.select("source_system", "data_type", "ingestion_timestamp", "format", "row_count", "cursor")


def landing_fingerprints(lab: Lab) -> DataFrame:
    """Whether every format of every partition has the fingerprint of its source rows, and a digest of its files."""
    count, mark = fingerprint_columns(_delta_rows(lab).columns)
    source = _delta_rows(lab).groupBy("ingestion_timestamp").agg(count.alias("source_rows"), mark.alias("source_fingerprint"))
    manifest = landing_source.read_manifest(lab.spark, _land_deltas(lab, ("parquet", "csv", "json")), required=True)
    return manifest.join(source, "ingestion_timestamp", "left").select(
        "ingestion_timestamp", "format", "row_count", "source_rows",
        (F.col("fingerprint") == F.col("source_fingerprint")).alias("same_fingerprint"),
        F.col("checksum_sha256").rlike("^[0-9a-f]{64}$").alias("has_digest"))


def landed_delta_rows(lab: Lab) -> DataFrame:
    """Every delta partition read back from its preferred format."""
    root = _land_deltas(lab, ("json", "csv"))
    rows = landing_source.read_preferred(lab.spark, root, C.DELTA_FEED, _delta_schema())
    return rows.select("timestamp", "itemid", "property", "value", "source_system", "ingestion_timestamp", "seq")


def latest_partition_rows(lab: Lab) -> DataFrame:
    root = _land_deltas(lab)
    return landing_source.read_latest(lab.spark, root, C.DELTA_FEED, "parquet", _delta_schema()).select(
        "timestamp", "itemid", "property", "value", "source_system", "ingestion_timestamp", "seq"
    )


def ingest_counters(lab: Lab) -> DataFrame:
    manifest = landing_source.read_manifest(lab.spark, _land_deltas(lab), required=True)
    return landing_sink.ingest_state(manifest).select(
        "cursor", "records_ingested_total", "last_ingestion_timestamp", "landed_partitions"
    )


def raw_quality_report(lab: Lab) -> DataFrame:
    root = _land_deltas(lab)
    report = raw_checks.delta_report(lab.spark, root, C.DELTA_FEED, _delta_schema(), ("parquet",), with_responses=False)
    # paths and fingerprints differ from run to run
    run_specific = F.col("check_name").isin("parquet_exists", "checksum_matches_metadata", "normalized_parquet_schema")
    return report.withColumn("details", F.when(~run_specific, F.col("details")))


def payload_records(lab: Lab) -> DataFrame:
    """API responses of both contracts, one per line, to normalised records."""
    rows = lab.raw_properties.where(F.col("source_system") == C.API_SOURCE)
    # a page holds the rows of at most ten orders, so it is small by construction
    pages = rows.groupBy(F.floor(F.col("seq") / 100).alias("page")).agg(
        F.collect_list(F.struct("timestamp", "itemid", "property", "value")).alias("records")
    )
    data_page = F.to_json(F.struct(
        F.col("records").alias("data"), F.lit(True).alias("success"), F.size("records").alias("count"),
        F.lit(0).alias("total_rows"), F.lit(0).alias("unread_rows"),
    ))
    record_page = F.to_json(F.struct(
        "records", F.col("page").cast("string").alias("next_cursor"), F.lit(False).alias("has_more")
    ))
    path = scratch_path(lab.spark, "payloads")
    pages.select(F.when(F.col("page") % 2 == 0, data_page).otherwise(record_page).alias("value")).write.text(path)
    parsed = payloads.parse_payloads(payloads.read_payload_text(lab.spark, path, one_per_file=False))
    return payloads.normalise_records(parsed, STAMPS[0])


def _write_csv(df: DataFrame, label: str) -> str:
    """A source folder of CSV files as a shop's export would be."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(**landing_source.CSV_WRITE).csv(path)
    return path


def _land_batches(lab: Lab) -> str:
    """Events, properties and category tree as CSV exports, landed byte for byte; returns the raw root."""
    root = scratch_path(lab.spark, "raw")
    for data_type, rows in (
        ("events", lab.raw_events), ("item_properties", lab.raw_properties.drop("seq", "source_system")),
        ("category_tree", lab.fixtures.category_tree()),
    ):
        source = _write_csv(rows, data_type)
        landing_sink.land_batch(lab.spark, source, root, data_type, STAMPS[0], rows.columns)
    return root


def batch_landing_manifest(lab: Lab) -> DataFrame:
    """Manifest of the batch landing; digests and sizes, which differ from run to run, against the stored files."""
    root = _land_batches(lab)
    manifest = landing_source.read_manifest(lab.spark, root, required=True)
    stored = blocks.digests(lab.spark, root, "part-*").groupBy(
        landing_source.path_fact(F.col("path"), "type").alias("data_type")).agg(*[
            column.alias(f"actual_{name}") for name, column in zip(("files", "bytes", "checksum"), blocks.partition_totals())])
    return manifest.join(stored, "data_type", "left").select(
        "source_system", "data_type", "ingestion_timestamp", "format", "row_count",
        (F.col("file_count") == F.col("actual_files")).alias("same_files"),
        (F.col("file_bytes") == F.col("actual_bytes")).alias("same_bytes"),
        (F.col("checksum_sha256") == F.col("actual_checksum")).alias("same_checksum"),
        "api_contract", "api_count", "total_rows", "unread_rows", "api_success", "cursor")


def batch_quality_report(lab: Lab) -> DataFrame:
    """The report after a landing of which one partition got further rows; one type was never landed."""
    root = _land_batches(lab)
    path = landing_source.partition_path(root, "category_tree", "csv", STAMPS[0])
    lab.fixtures.category_tree().write.mode("append").options(**landing_source.CSV_WRITE).csv(path)
    report = raw_checks.batch_report(lab.spark, root, ["events", "item_properties", "category_tree", "prices"])
    # paths and digests differ from run to run
    run_specific = F.col("check_name").isin("raw_file_exists", "checksum_matches_metadata")
    return report.withColumn("details", F.when(~run_specific, F.col("details")))


def csv_events_roundtrip(lab: Lab) -> DataFrame:
    """Events staged from their landed CSV files."""
    path = landing_source.partition_path(_land_batches(lab), "events", "csv", STAMPS[0])
    return staging.stage_events(external.read_events(lab.spark, path), lab.source)


def csv_properties_roundtrip(lab: Lab) -> DataFrame:
    path = landing_source.partition_path(_land_batches(lab), "item_properties", "csv", STAMPS[0])
    return external.read_item_properties(lab.spark, path)


ARRAY_ORDERS = 20_000


def json_array_rows(lab: Lab) -> DataFrame:
    """Properties from files that each hold one JSON array."""
    fields = ["timestamp", "itemid", "property", "value"]
    rows = lab.raw_properties.where(F.col("source_system") == C.API_SOURCE).select(*fields, "seq")
    # an array holds the rows of at most twenty thousand orders: files of some hundred KB, and not one per few rows
    arrays = rows.groupBy(F.floor(F.col("seq") / (10 * ARRAY_ORDERS)).alias("page")).agg(F.to_json(F.collect_list(F.struct(*fields))).alias("value"))
    path = scratch_path(lab.spark, "json-arrays")
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return external.read_json_array(lab.spark, path, rows.drop("seq").schema)


def landed_presence(lab: Lab) -> DataFrame:
    """Presence after one landed partition was lost and one came that no manifest row tells of."""
    root = _land_deltas(lab, ("parquet", "json"))
    delete_path(lab.spark, landing_source.partition_path(root, C.DELTA_FEED, "json", STAMPS[1]))
    lab.raw_properties.limit(1).coalesce(1).write.parquet(
        landing_source.partition_path(root, C.DELTA_FEED, "parquet", "20260101_023000"))
    return landing_source.presence(lab.spark, root).select("data_type", "format", "ingestion_timestamp", "presence")


def _land_responses(lab: Lab) -> str:
    """API pages landed as five partitions of raw responses with their records; every page of 25 that is third fails."""
    root = scratch_path(lab.spark, "raw")
    rows = lab.raw_properties.where(F.col("source_system") == C.API_SOURCE)
    # a page holds the rows of at most ten orders, so it is small by construction
    pages = rows.groupBy(F.floor(F.col("seq") / 100).alias("page")).agg(
        F.collect_list(F.struct("timestamp", "itemid", "property", "value")).alias("records"))
    stamp = F.element_at(F.array(*map(F.lit, STAMPS)), (F.col("page") % len(STAMPS) + 1).cast("int"))
    bodies = materialise(pages.select(stamp.alias("ingestion_timestamp"), F.to_json(F.struct(
        F.col("records").alias("data"), (F.col("page") % 25 != 3).alias("success"), F.size("records").alias("count"),
        F.lit(0).alias("total_rows"), F.lit(0).alias("unread_rows"))).alias("value")), "bodies")
    landing_sink.land_partitions(bodies, root, landing_source.response_type(C.DELTA_FEED), C.API_SOURCE)
    parsed = payloads.parse_payloads(bodies.withColumnRenamed("value", "body"))
    landing_sink.land_partitions(payloads.normalise_records(parsed, F.col("ingestion_timestamp")), root, C.DELTA_FEED, C.API_SOURCE)
    return root


def response_contract_report(lab: Lab) -> DataFrame:
    """The delta report with its raw responses, one partition of which breaks the contract; csv was never landed."""
    report = raw_checks.delta_report(lab.spark, _land_responses(lab), C.DELTA_FEED, expected_formats=("parquet", "csv"))
    run_specific = F.col("check_name").isin(
        "parquet_exists", "raw_response_exists", "checksum_matches_metadata", "normalized_parquet_schema")
    return report.withColumn("details", F.when(~run_specific, F.col("details")))


def _split_responses(lab: Lab) -> ResponseSplit:
    found = ResponseSplit(lab.spark, scratch_path(lab.spark, "responses"))
    found.absorb(_land_responses(lab), C.DELTA_FEED, files_per_batch=8).awaitTermination()
    return found


def quarantined_pages(lab: Lab) -> DataFrame:
    """Rejected pages of the stream with their reason and number of records."""
    return _split_responses(lab).read("rejected").select(
        "ingestion_timestamp", "problem", F.json_array_length(F.get_json_object("body", "$.data")).alias("n_records"))


def streamed_response_records(lab: Lab) -> DataFrame:
    return _split_responses(lab).read("records")


# --- stored layers --------------------------------------------------------------------------

def event_type_csv_report(lab: Lab) -> DataFrame:
    """A report written as one CSV file and read again."""
    report, path = profiling.event_type_summary(lab.raw_events), scratch_path(lab.spark, "report")
    reports.write_csv_report(report, path)
    return lab.spark.read.schema(report.schema).option("header", True).csv(path)


def _stored_layers(lab: Lab) -> dict[str, str]:
    """Databases of this run for the layers, with a bucketed table and a view over another."""
    run = uuid.uuid4().hex[:12]
    layers = {name: f"{name}_{run}" for name in ("staged", "curated", "mart")}
    tables.reset_layers(lab.spark, layers.values())
    tables.save_table(lab.events.drop("_source_system", "_source_file"), layers["staged"], "events", "visitor_id", 8)
    weighed = curation.curated_interactions(lab.events, lab.metadata)
    tables.save_table(weighed.select("user_id", "item_id", "event_type", "interaction_weight"), layers["curated"], "interactions")
    tables.create_view(lab.spark, layers["mart"], "interactions", f"{layers['curated']}.interactions")
    return layers


def layer_inventory(lab: Lab) -> DataFrame:
    """Tables and views of the catalog, one of them missing."""
    layers = _stored_layers(lab)
    wanted = [(layers["staged"], "events"), (layers["curated"], "interactions"), (layers["mart"], "interactions"), (layers["mart"], "gone")]
    return tables.table_inventory(lab.spark, wanted).withColumn("schema_name", F.split_part("schema_name", F.lit("_"), F.lit(1)))


def layer_schema_summary(lab: Lab) -> DataFrame:
    return tables.catalog_schema_summary(lab.spark, _stored_layers(lab).values()).withColumn(
        "schema_name", F.split_part("schema_name", F.lit("_"), F.lit(1)))


def mart_view_totals(lab: Lab) -> DataFrame:
    """Totals by type through the view over the stored table."""
    return lab.spark.table(f"{_stored_layers(lab)['mart']}.interactions").groupBy("event_type").agg(
        F.count("*").alias("row_count"), F.sum("interaction_weight").alias("total_weight"))


def stored_model_recommendations(lab: Lab) -> DataFrame:
    """Lists from a model that was stored and loaded again."""
    store = tables.LayerStore(lab.spark, scratch_path(lab.spark, "store"))
    store.save(lab.popularity_model, "models", "popularity_items")
    model = store.load("models", "popularity_items", "the training step")
    return serving.recommend_popularity(lab.history.select("user_id"), lab.history, model)


def listed_user_features(lab: Lab) -> DataFrame:
    """Features of a short list of users: the most active ones, with their ids as the list."""
    ids = [row["user_id"] for row in serving.active_users(lab.user_view).select("user_id").collect()]
    return registry.retrieve(external.users_from(lab.spark, ids), lab.user_view, registry.USER_VIEW, ["total_events", "unique_items"])


# --- inventory ------------------------------------------------------------------------------

def table_inventory(lab: Lab) -> DataFrame:
    frames = {
        ("staged", "events"): lab.events,
        ("staged", "category_tree"): lab.tree,
        ("staged", "item_properties_combined"): lab.combined,
        ("curated", "items"): lab.items,
        ("features", "user_features"): lab.user_view,
    }
    return stack(*[tables.relation_counts(df, layer, name, "BASE TABLE") for (layer, name), df in frames.items()])


# --- streaming --------------------------------------------------------------------------------

def _stream_state(lab: Lab) -> LatestPropertyState:
    """Batch rows as the seed, delta partitions through the stream."""
    root = _land_deltas(lab)
    state = LatestPropertyState(lab.spark, scratch_path(lab.spark, "state"))
    state.seed(lab.batch)
    stream = read_delta_stream(
        lab.spark, landing_source.type_path(root, C.DELTA_FEED, "parquet"), _delta_schema(), files_per_batch=8
    )
    state.absorb(stream).awaitTermination()
    return state


def stream_latest_category(lab: Lab) -> DataFrame:
    return latest.item_category_latest(_stream_state(lab).current()).drop("_source_file")


def stream_latest_availability(lab: Lab) -> DataFrame:
    return latest.item_availability_latest(_stream_state(lab).current()).drop("_source_file")


def stream_delta_append(lab: Lab) -> DataFrame:
    root = _land_deltas(lab)
    target = scratch_path(lab.spark, "staged-delta")
    stream = read_delta_stream(lab.spark, landing_source.type_path(root, C.DELTA_FEED, "parquet"), _delta_schema())
    append_delta(stream, target, scratch_path(lab.spark, "checkpoint")).awaitTermination()
    return lab.spark.read.parquet(target).drop("source_file")


_ON_ORDERS = (
    stage_category_tree, stage_item_properties_batch, stage_item_properties_delta, combined_properties,
    item_category_latest, item_availability_latest, curated_interactions, curated_items, curated_user_items,
    mart_user_features, mart_item_features, user_features, item_features, user_item_features,
    profile_events, event_type_summary, profile_properties, top_properties, category_profile,
    category_tree_sample, source_profile, event_distribution, activity_histogram, top_item_bars,
    quality_report, quality_status, quality_problems, duplicate_events, referential_coverage,
    time_bounds, train_test_counts, test_targets_latest, test_targets_earliest, scattered_user_sample,
    first_user_sample, train_seen_items,
    popularity_topn, popularity_ranking, popularity_metrics, popularity_summary, popularity_examples,
    active_users, popularity_recommendations, content_candidates, user_profiles, content_recommendations,
    content_metrics, content_summary, content_examples, popularity_metrics_sampled, content_metrics_sampled,
    popularity_recommendations_head, content_recommendations_head, active_user_recommendations,
    feature_retrieval, feature_point_lookup, sample_pair, retrieval_summary, registry_summary, feature_documentation,
    model_comparison, metric_matrix, inference_summary, report_merge,
    landing_manifest, landing_fingerprints, landed_delta_rows, latest_partition_rows, ingest_counters,
    raw_quality_report, payload_records, table_inventory,
    stream_latest_category, stream_latest_availability, stream_delta_append,
    batch_landing_manifest, batch_quality_report, csv_events_roundtrip, csv_properties_roundtrip, json_array_rows,
    landed_presence, response_contract_report, quarantined_pages, streamed_response_records,
    event_type_csv_report, layer_inventory, layer_schema_summary, mart_view_totals, stored_model_recommendations, listed_user_features,
)
_ON_CLICKS = (
    stage_events, curated_interactions, curated_items, curated_user_items, user_features, item_features,
    user_item_features, event_type_summary, quality_report, test_targets_latest, test_targets_earliest,
    popularity_ranking, popularity_metrics, popularity_recommendations, user_profiles, content_candidates,
    content_recommendations, content_metrics, popularity_metrics_sampled, content_metrics_sampled,
    popularity_recommendations_head, content_recommendations_head,
)


def _bind(build: Callable[[Lab], DataFrame], source: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return comparable(build(Lab(spark, folder, source)))

    run.__name__ = build.__name__
    return run


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Queries on the order events; ``_clicks`` marks those on the click events."""
    named = {"stage_events": _bind(stage_events, "orders")}
    named |= {build.__name__: _bind(build, "orders") for build in _ON_ORDERS}
    named |= {f"{build.__name__}_clicks": _bind(build, "clicks") for build in _ON_CLICKS}
    return named
