"""End-to-end runs over a layer store: build, train, recommend, retrieve.

Each step reads what earlier steps stored and stores its own results, so any
step can be rerun alone and a missing input names the step that makes it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from shoplens import constants as C
from shoplens.operators.merge import stack
from shoplens.plans import comparison, curation, expectations, features, latest, registry, serving, staging, training
from shoplens.session import temporary_tables
from shoplens.sinks.reports import write_model_report
from shoplens.sinks.tables import LayerStore, relation_counts


@dataclass(frozen=True)
class RawInputs:
    """The source-shaped inputs, read from files or from landed partitions."""

    events: DataFrame
    category_tree: DataFrame
    properties_batch: DataFrame
    properties_delta: DataFrame


MODEL_SPECS = {
    C.POPULARITY_KEY: ("popularity_items", "popularity_summary", "train(store, 'popularity')"),
    C.CONTENT_KEY: ("content_candidates", "content_summary", "train(store, 'content_based')"),
}


def build(store: LayerStore, raw: RawInputs, lineage: bool = False) -> None:
    """Raw inputs to staged, curated, mart and feature datasets.

    The events are read twice, for the interactions and for the pair table;
    every later dataset starts from the pairs.
    """
    file = staging.file_of_row() if lineage else None
    events = store.save(staging.stage_events(raw.events, file), "staged", "events")
    tree = store.save(staging.stage_category_tree(raw.category_tree, file), "staged", "category_tree")
    batch = store.save(staging.stage_properties_batch(raw.properties_batch, file), "staged", "item_properties_batch")
    delta = store.save(staging.stage_properties_delta(raw.properties_delta, file), "staged", "item_properties_api_delta")
    combined = store.save(staging.combine_properties(batch, delta), "staged", "item_properties_combined")
    categories = store.save(latest.item_category_latest(combined), "staged", "item_category_latest")
    availability = store.save(latest.item_availability_latest(combined), "staged", "item_availability_latest")

    metadata = store.save(curation.item_metadata(categories, availability, tree), "curated", "item_metadata")
    store.save(curation.curated_interactions(events, metadata), "curated", "curated_interactions")
    pairs = store.save(curation.event_pairs(events), "curated", "event_pairs")
    items = store.save(curation.curated_items(pairs, metadata), "curated", "curated_items")
    user_items = store.save(
        curation.curated_user_items(pairs, metadata), "curated", "curated_user_item_interactions"
    )

    users = store.save(features.mart_user_features(pairs), "mart", "user_features")
    mart_items = store.save(features.mart_item_features(items), "mart", "item_features")
    for view, rows in (
        (registry.USER_VIEW, features.user_features(users)), (registry.ITEM_VIEW, features.item_features(mart_items)),
        (registry.USER_ITEM_VIEW, features.user_item_features(user_items)),
    ):
        store.save_keyed(rows, "features", view.name, view.entity_keys)


_CURATED = ("curated_interactions", "curated_items", "curated_user_item_interactions")


def validate(store: LayerStore, strict: bool = True) -> DataFrame:
    """The quality report, stored; raises on a failed check when strict."""
    names = expectations.REQUIRED_COLUMNS
    layer = {name: "curated" if name in _CURATED else "staged" for name in names}
    found = {name: expectations.readable(lambda name=name: store.load(layer[name], name, "build"))
             for name in names if store.exists(layer[name], name)}
    datasets = {name: df for name, (df, _) in found.items() if df is not None}
    unreadable = {name: reason for name, (_, reason) in found.items() if reason is not None}
    report = store.save(expectations.quality_report(store.spark, datasets, unreadable), "reports", "quality")
    if strict:
        expectations.require_passed(report)
    return report


def _interactions(store: LayerStore) -> DataFrame:
    return curation.as_interactions(store.load("staged", "events", "build"))


def train(store: LayerStore, key: str, **parameters) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fit and evaluate one model; store and return model, summary, examples.

    Intermediate tables of the run are deleted at its end.
    """
    metadata = store.load("curated", "item_metadata", "build")
    fit = training.train_popularity if key == C.POPULARITY_KEY else training.train_content
    model_name, summary_name, _ = MODEL_SPECS[key]
    with temporary_tables(store.spark):
        run = fit(_interactions(store), metadata, **parameters)
        if key == C.POPULARITY_KEY:
            store.save(run.all_scores, "models", "popularity_item_scores")
        return (
            store.save(run.model, "models", model_name),
            store.save(run.summary, "models", summary_name),
            store.save(run.examples, "models", f"{key}_examples"),
        )


def recommend(
    store: LayerStore, key: str, users: DataFrame | None = None, k: int = C.SERVING_TOP_K, n: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Recommendations and their summary for the users, default the most active.

    Both replace this model's earlier rows in the stored reports.
    """
    model_name, summary_name, step = MODEL_SPECS[key]
    model = store.load("models", model_name, step)
    summary = store.load("models", summary_name, step)
    if users is None:
        users = serving.active_users(store.load("features", "user_features", "build"))
    users = users.select("user_id").distinct()
    history = serving.full_history(_interactions(store).join(users, "user_id", "left_semi"))
    if key == C.POPULARITY_KEY:
        rows = serving.recommend_popularity(users, history, model, k, n)
    else:
        metadata = store.load("curated", "item_metadata", "build")
        rows = serving.recommend_content(users, history, metadata, model, k, n)
    path = store.path("reports", "recommendations")
    write_model_report(rows, path)
    stored = store.spark.read.parquet(path).where(F.col("model_key") == key)
    report = serving.inference_summary(key, users, stored, summary, store.path("models", model_name), k)
    report_path = store.path("reports", "inference_summary")
    write_model_report(report, report_path)
    return stored, store.spark.read.parquet(report_path).where(F.col("model_key") == key)


def compare(store: LayerStore) -> DataFrame:
    families = {C.POPULARITY_KEY: C.POPULARITY_FAMILY, C.CONTENT_KEY: C.CONTENT_FAMILY}
    labelled = [
        comparison.labelled(
            store.load("models", summary, step), families[key], store.path("models", model), store.path("models", summary)
        )
        for key, (model, summary, step) in MODEL_SPECS.items()
    ]
    return store.save(comparison.compare_models(*labelled), "reports", "model_comparison")


def feature_sources(store: LayerStore) -> dict[str, DataFrame]:
    return {
        view.name: store.load("features", view.name, "build")
        for view in registry.VIEWS
        if store.exists("features", view.name)
    }


def describe_features(store: LayerStore) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Registry summary, feature documentation, retrieval of the strongest pair."""
    sources = feature_sources(store)
    summary = store.save(registry.registry_summary(store.spark, sources), "reports", "feature_registry")
    documentation = store.save(registry.feature_documentation(store.spark, sources), "reports", "feature_documentation")
    pair = store.save(
        registry.sample_pair(store.load("features", "user_item_features", "build")), "reports", "sample_pair"
    )
    retrieval = stack(*[
        registry.retrieval_summary(pair, store.load("features", view.name, "build"), view) for view in registry.VIEWS
    ])
    return summary, documentation, store.save(retrieval, "reports", "feature_retrieval")


def inventory(store: LayerStore, relations: list[tuple[str, str]]) -> DataFrame:
    """Row and column counts of stored datasets; a missing one fails."""
    parts = []
    for layer, name in relations:
        if store.exists(layer, name):
            parts.append(relation_counts(store.load(layer, name), layer, name, "BASE TABLE"))
        else:
            parts.append(
                store.spark.range(1).select(
                    F.lit(layer).alias("schema_name"), F.lit(name).alias("relation_name"),
                    F.lit("MISSING").alias("relation_type"), F.lit(None).cast("bigint").alias("row_count"),
                    F.lit(None).cast("int").alias("column_count"), F.lit("FAIL").alias("status"),
                )
            )
    return stack(*parts)
