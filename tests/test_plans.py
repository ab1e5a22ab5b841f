"""Plans keep their shape: native expressions, pushed filters, no quadratic joins."""

import pytest
from pyspark.sql import functions as F

from registered_queries import Lab
from shoplens.constants import DAY_MS
from shoplens.plans import content, curation, latest, popularity, profiling, registry, split
from shoplens.operators.ranking import rank_all
from shoplens.sinks.tables import LayerStore

QUADRATIC = ("CartesianProduct", "BroadcastNestedLoopJoin")
PYTHON = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plain_joins(spark):
    """Nothing is small enough to broadcast unless the code says so."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key in settings:
        spark.conf.unset(key)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    store = LayerStore(spark, str(tmp_path_factory.mktemp("plans")))
    events = spark.range(20_000).select(
        (F.col("id") % 997).alias("user_id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 501).cast("bigint").alias("item_id"),
        F.element_at(F.array(F.lit("view"), F.lit("addtocart"), F.lit("transaction")), (F.col("id") % 3 + 1).cast("int")).alias("event_type"),
        (F.col("id") * 60_000 + DAY_MS).alias("event_timestamp_ms"),
    )
    store.save(events, "staged", "interactions")
    metadata = spark.range(501).select(
        F.col("id").alias("item_id"), (F.col("id") % 9).alias("category_id"), (F.col("id") % 3).alias("parent_category_id"),
        F.lit(1).alias("is_available"), F.lit("1").alias("available_raw_value"),
        F.lit(1).alias("has_category_metadata"), F.lit(1).alias("has_availability_metadata"),
    )
    store.save(metadata, "curated", "item_metadata")
    properties = metadata.select(
        "item_id", F.lit("categoryid").alias("property_name"), F.col("category_id").cast("string").alias("property_value"),
        F.lit(1).cast("bigint").alias("property_timestamp_ms"), F.lit("s").alias("source_system"), F.lit("f").alias("source_file"),
        F.timestamp_millis(F.lit(1)).alias("property_datetime"),
    )
    store.save(properties, "staged", "properties")
    return store


def test_recommender_plans_have_no_python_and_no_quadratic_join(plain_joins, store):
    events, metadata = store.load("staged", "interactions"), store.load("curated", "item_metadata")
    window = split.find_window(events, 2)
    pairs = split.split_pairs(events, window, split.POPULARITY_RULE)
    scored = popularity.score_items(pairs, metadata)
    model = popularity.top_items(scored, 50)
    targets = split.test_targets(pairs, split.POPULARITY_RULE, 100)
    seen = split.seen_by(pairs, targets)
    frames = [
        model,
        popularity.recommend(targets, seen, model, 5, 50),
        popularity.filtered_positions(targets, seen, model, 10),
        popularity.recommend(targets, seen, model, 5),
        content.recommend(targets, seen, metadata, content.candidate_items(pairs, metadata, 50), 5, 50),
        content.user_profiles(seen, metadata),
        curation.with_metadata(events, metadata),
    ]
    for df in frames:
        plan = _plan(df)
        assert not [name for name in QUADRATIC + PYTHON if name in plan], plan


def test_cutoff_is_pushed_into_the_scan(spark, store):
    events = store.load("staged", "interactions")
    window = split.find_window(events, 2)
    plan = _plan(split.train_split(events, window, split.POPULARITY_RULE))
    assert f"LessThan(event_timestamp_ms,{window.cutoff_ms})" in plan


def test_latest_state_reduces_before_the_shuffle_and_prunes(spark, store):
    plan = _plan(latest.item_category_latest(store.load("staged", "properties")))
    assert "EqualTo(property_name,categoryid)" in plan
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle


def test_point_lookup_is_pushed_and_pruned(spark, store):
    plan = _plan(store.load("curated", "item_metadata").where("item_id = 7").select("category_id"))
    assert "EqualTo(item_id,7)" in plan and "available_raw_value" not in plan


def test_pair_rollup_aggregates_before_its_only_shuffle(spark, store):
    plan = _plan(split.split_pairs(store.load("staged", "interactions"), split.Window(0, 10 * DAY_MS, 2), split.CONTENT_RULE))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_count_if" in plan or "partial_count" in plan


def test_full_ranking_uses_range_partitions(spark, store):
    ranked = rank_all(store.load("curated", "item_metadata"), [F.col("category_id").desc(), F.col("item_id").asc()], "rank")
    windows = [line for line in _plan(ranked).splitlines() if "Window " in line]
    assert all("_block" in line for line in windows)  # a window over partition sizes only
    assert ranked.agg(F.max("rank")).first()[0] == 501


def test_hot_item_is_split_by_adaptive_skew_handling(plain_joins, store):
    spark = plain_joins
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        facts = store.load("staged", "interactions").repartition(16)
        joined = curation.with_metadata(facts, store.load("curated", "item_metadata"))
        assert len(joined.collect()) == 20_000
        assert "skew=true" in _plan(joined)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_profiles_copy_no_raw_row_per_distinct_count(spark):
    raw = spark.range(100).select(
        F.col("id").alias("timestamp"), (F.col("id") % 7).alias("visitorid"), (F.col("id") % 5).alias("itemid"),
        F.lit("view").alias("event"), F.lit(None).cast("bigint").alias("transactionid"),
        F.lit("p").alias("property"), F.col("id").cast("string").alias("value"),
    )
    for build in (profiling.profile_events, profiling.event_type_summary, profiling.profile_properties, profiling.top_properties):
        assert "Expand" not in _plan(build(raw))
    row = profiling.profile_events(raw).first()
    assert (row.row_count, row.distinct_visitors, row.distinct_items, row.max_timestamp_ms) == (100, 7, 5, 99)
    empty = profiling.profile_events(raw.where("false")).first()
    assert (empty.row_count, empty.distinct_visitors, empty.max_timestamp_ms) == (0, 0, None)


def test_content_lists_shuffle_no_pairs_of_users_and_candidates(spark, store):
    events, metadata = store.load("staged", "interactions"), store.load("curated", "item_metadata")
    pairs = split.split_pairs(events, split.find_window(events, 2), split.CONTENT_RULE)
    history = split.seen_by(pairs, events)
    lists = content.recommend(events.select("user_id"), history, metadata, content.candidate_items(pairs, metadata), 5)
    shuffles = [line for line in _plan(lists).splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 1 and "hashpartitioning(user_id" in shuffles[0] and "REPARTITION_BY_NUM" in shuffles[0]


def test_window_split_and_history_read_the_stored_interactions(spark, small):
    lab = Lab(spark, small)
    for df in (lab.split(split.POPULARITY_RULE), lab.train_split(split.CONTENT_RULE)):
        assert "Join" not in _plan(df)
    assert lab.stored_interactions.count() == lab.interactions.count()


def test_event_distribution_groups_by_type_alone(spark):
    raw = spark.range(100).select(F.lit("view").alias("event"), F.col("id").alias("visitorid"), F.col("id").alias("itemid"))
    found = profiling.event_distribution(raw)
    assert "visitorid" not in _plan(found) and [tuple(row) for row in found.collect()] == [("view", 100)]


def test_profiles_keep_number_keys_and_group_before_they_repeat_rows(spark, store):
    raw = spark.range(100).select(
        F.lit("view").alias("event"), (F.col("id") % 7).alias("visitorid"), (F.col("id") % 5).alias("itemid"), F.lit("t").alias("transactionid"))
    summary = profiling.event_type_summary(raw)
    assert "as string" not in _plan(summary) and tuple(summary.first()) == ("view", 100, 7, 5, 100)
    history = store.load("staged", "interactions").select("user_id", "item_id", F.lit(1.0).alias("weight"))
    plan = _plan(content.user_profiles(history, store.load("curated", "item_metadata")))
    below = plan[plan.index("Generate inline"):]
    assert "HashAggregate" in below


def test_feature_documentation_reads_a_view_once_and_groups_typed_values(spark, store):
    view = store.load("curated", "item_metadata")
    plan = _plan(registry.feature_documentation(spark, {"item_features": view}, [registry.ITEM_VIEW]))
    assert plan.count("FileScan") == 1 and "Generate" not in plan
    shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning(ordinal_position" in line and "as_1" in line]
    assert shuffled and "as string" not in plan[plan.index(shuffled[0]):]
