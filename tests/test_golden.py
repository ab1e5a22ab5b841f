"""Hand-made frames for the corner cases of single operators."""

import math

import pytest
from pyspark.sql import functions as F

from shoplens.constants import CONTENT_UNKNOWN_WEIGHT, CURATED_UNKNOWN_WEIGHT, DAY_MS
from shoplens.functions import columns, scores, values
from shoplens.operators import fingerprint, merge, ranking
from shoplens.plans import curation, evaluation, expectations, features, latest, profiling, registry, split, staging

HOUR = 3_600_000


def test_whole_number_reads_fractions_and_spaces(spark, rows):
    texts = ["1188", "12.6", "12.5", " 7 ", "abc", None, "-3", "12.4999999", "-12.5000001"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [v for _, v in rows(df.select("i", values.whole_number("t")))] == [1188, 13, 13, 7, None, None, -3, 12, -13]


def test_availability_flag(spark, rows):
    texts = ["1", "TRUE", "0", "False", "maybe", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [v for _, v in rows(df.select("i", values.availability_flag("t")))] == [1, 1, 0, 0, None, None]


def test_event_weights_differ_for_unknown_types(spark, rows):
    df = spark.createDataFrame([("view",), ("addtocart",), ("transaction",), ("signup",), (None,)], "t string")
    curated = {t: w for t, w in rows(df.select("t", scores.event_weight("t", CURATED_UNKNOWN_WEIGHT)))}
    content = {t: w for t, w in rows(df.select("t", scores.event_weight("t", CONTENT_UNKNOWN_WEIGHT)))}
    assert curated == {"view": 1.0, "addtocart": 3.0, "transaction": 5.0, "signup": 0.0, None: 0.0}
    assert content == {"view": 1.0, "addtocart": 3.0, "transaction": 5.0, "signup": 1.0, None: 1.0}


def test_ratios_are_zero_without_denominator(spark):
    row = spark.sql("select 3L carts, 0L views, 4L events").select(
        scores.guarded_ratio("carts", "views").alias("a"), scores.ratio_or_zero("carts", "views").alias("b"),
        scores.guarded_ratio("carts", "events").alias("c"), scores.ratio_or_zero("carts", "events").alias("d"),
    ).first()
    assert tuple(row) == (0.0, 0.0, 0.75, 0.75)


def test_active_days_counts_calendar_days(spark):
    df = spark.createDataFrame([(DAY_MS - 1, DAY_MS), (0, DAY_MS - 1)], "a bigint, b bigint")
    assert [r[0] for r in df.select(values.active_days("a", "b")).collect()] == [2, 1]


def test_active_days_ignores_the_session_zone(spark):
    df = spark.createDataFrame([(DAY_MS - 1, DAY_MS)], "a bigint, b bigint")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        assert df.select(values.active_days("a", "b")).first()[0] == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _properties(spark, data):
    schema = "property_timestamp_ms bigint, item_id bigint, property_name string, property_value string, source_system string, source_file string"
    return spark.createDataFrame(data, schema).withColumn("property_datetime", values.instant("property_timestamp_ms"))


def test_latest_category_prefers_time_then_batch(spark, rows):
    log = _properties(spark, [
        (20, 1, "categoryid", "5", "catalog_api", None),
        (20, 1, "categoryid", "6", "catalog_batch", None),
        (10, 1, "categoryid", "9", "catalog_batch", None),
        (10, 2, "categoryid", "12.6", "catalog_api", None),
        (30, 2, "available", "1", "catalog_api", None),
        (11, 3, "categoryid", "abc", "catalog_api", None),
    ])
    assert rows(latest.item_category_latest(log), "item_id", "category_id") == [(1, 6), (2, 13), (3, None)]
    assert rows(latest.item_availability_latest(log), "item_id", "available_raw_value", "is_available") == [(2, "1", 1)]


def _metadata(spark):
    categories = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "item_id bigint, category_id bigint")
    availability = spark.createDataFrame([(1, 1, "1"), (4, 0, "0")], "item_id bigint, is_available int, available_raw_value string")
    tree = spark.createDataFrame([(10, 1), (1, None)], "category_id bigint, parent_category_id bigint")
    return curation.item_metadata(categories, availability, tree)


def test_metadata_keeps_items_known_to_one_side(spark, rows):
    got = rows(_metadata(spark), "item_id", "category_id", "parent_category_id", "is_available", "has_category_metadata", "has_availability_metadata")
    assert got == [
        (1, 10, 1, 1, 1, 1), (2, 99, None, None, 1, None), (3, None, None, None, 1, None), (4, None, None, 0, None, 1),
    ]


def _events(spark, data):
    df = spark.createDataFrame(data, "event_timestamp_ms bigint, visitor_id bigint, event_type string, item_id bigint")
    return df.withColumns({
        "event_datetime": values.instant("event_timestamp_ms"), "transaction_id": F.lit(None).cast("bigint"),
        "_source_system": F.lit("s"), "_source_file": F.lit("f"),
    })


def test_interactions_never_fan_out_and_flag_unmatched(spark, rows):
    events = _events(spark, [(1, 7, "view", 1), (2, 7, "view", 3), (3, 7, "view", 5), (4, 7, "other", 4)])
    got = rows(curation.curated_interactions(events, _metadata(spark)), "item_id", "interaction_weight", "has_category_metadata", "has_availability_metadata")
    assert got == [(1, 1.0, 1, 1), (3, 1.0, 1, 0), (4, 0.0, 0, 1), (5, 1.0, 0, 0)]


def test_rollups_agree_with_direct_counts(spark):
    events = _events(spark, [
        (5, 1, "view", 1), (6, 1, "view", 1), (7, 2, "addtocart", 1), (8, None, "view", 1), (9, 2, "transaction", 2), (9, 2, "signup", 2),
    ])
    pairs = curation.event_pairs(events)
    item = curation.curated_items(pairs, _metadata(spark)).where("item_id = 1").first()
    assert (item.total_events, item.unique_users, item.view_events, item.addtocart_events) == (4, 2, 3, 1)
    user = features.mart_user_features(pairs).where("user_id = 2").first()
    assert (user.total_events, user.unique_items, user.total_interaction_score) == (3, 2, 8.0)
    assert user.avg_interaction_weight == pytest.approx(8 / 3)


def _interactions(spark, data):
    return spark.createDataFrame(data, "user_id bigint, item_id bigint, event_type string, event_timestamp_ms bigint")


def test_event_at_the_cutoff_is_test_for_popularity_and_train_for_content(spark):
    end = 10 * DAY_MS
    events = _interactions(spark, [(1, 1, "transaction", end - 2 * DAY_MS), (1, 2, "view", end), (1, 3, "view", 1)])
    window = split.find_window(events, 2)
    assert window.cutoff_ms == end - 2 * DAY_MS
    popularity = split.event_counts(split.split_pairs(events, window, split.POPULARITY_RULE)).first()
    content = split.event_counts(split.split_pairs(events, window, split.CONTENT_RULE)).first()
    assert tuple(popularity) == (1, 2) and tuple(content) == (2, 1)


def test_targets_break_ties_by_rule_then_item(spark, rows):
    events = _interactions(spark, [
        (1, 9, "addtocart", 100 * HOUR), (1, 5, "transaction", 101 * HOUR), (1, 4, "transaction", 103 * HOUR),
        (2, 8, "addtocart", 102 * HOUR), (2, 7, "addtocart", 102 * HOUR), (3, 1, "view", 103 * HOUR), (3, 1, "view", 1),
    ])
    window = split.find_window(events, 1)
    late = split.test_targets(split.split_pairs(events, window, split.POPULARITY_RULE), split.POPULARITY_RULE)
    early = split.test_targets(split.split_pairs(events, window, split.CONTENT_RULE), split.CONTENT_RULE)
    assert rows(late, "user_id", "target_item_id") == [(1, 4), (2, 7)]
    assert rows(early, "user_id", "target_item_id") == [(1, 5), (2, 7)]


def test_user_samples_are_bounded_and_ordered(spark, rows):
    events = _interactions(spark, [(user, 1, "addtocart", 100) for user in range(50)] + [(99, 1, "view", 1)])
    window = split.find_window(events, 0)
    content = split.split_pairs(events, window, split.SplitRule(False, 1.0, False))
    assert [r[0] for r in rows(split.test_targets(content, split.CONTENT_RULE, 3), "user_id")] == [0, 1, 2]
    hashed = split.test_targets(content, split.POPULARITY_RULE, 7)
    assert hashed.count() == 7
    assert rows(hashed) == rows(split.test_targets(content, split.POPULARITY_RULE, 7))


def test_empty_history_has_no_window(spark):
    with pytest.raises(ValueError):
        split.find_window(_interactions(spark, []), 14)


def test_metrics_of_nobody_are_zero(spark):
    none = spark.createDataFrame([], "user_id bigint, evaluated boolean, position int")
    assert tuple(evaluation.ranking_metrics(none, 10).first()) == (0, 0, 0.0, 0.0, 0.0, 0.0)


def test_metrics_count_full_slots(spark):
    df = spark.createDataFrame([(1, True, 1), (2, True, 3), (3, True, None), (4, False, None)], "user_id bigint, evaluated boolean, position int")
    row = evaluation.ranking_metrics(df, 10).first()
    assert (row.evaluated_users, row.hits) == (3, 2)
    assert row.precision_at_10 == pytest.approx(2 / 30) and row.recall_at_10 == pytest.approx(2 / 3)
    assert row.ndcg_at_10 == pytest.approx((1 + 1 / math.log2(4)) / 3)


@pytest.mark.parametrize("with_metadata, status", [(4, "PASS"), (1, "WARN")])
def test_coverage_warns_below_half(spark, with_metadata, status):
    events = _events(spark, [(1, 1, "view", item) for item in range(8)])
    known = spark.createDataFrame([(item,) for item in range(with_metadata)], "item_id bigint")
    report = expectations.coverage_report(curation.metadata_coverage(events, known, known)).collect()
    assert {r.status for r in report} == {status}


def test_coverage_of_nothing_warns(spark):
    empty = spark.createDataFrame([], "item_id bigint")
    report = expectations.coverage_report(curation.metadata_coverage(empty, empty, empty)).collect()
    assert [(r.status, r.details) for r in report] == [("WARN", "0/0 (0.0000)")] * 2


def test_quality_report_on_bad_data(spark):
    events = _events(spark, [(0, 1, "view", 1), (5, None, "view", 1), (5, 2, "oops", 1), (7, 2, "view", 2), (7, 2, "view", 2), (None, 3, None, None)])
    broken = spark.createDataFrame([(1,)], "item_id bigint")
    report = expectations.quality_report(spark, {"events": events, "curated_items": broken})
    got = {(r.dataset_name, r.check_name): (r.status, r.details) for r in report.collect()}
    assert got["events", "valid_event_types"] == ("FAIL", "Invalid rows: 1")
    assert got["events", "valid_timestamps"] == ("FAIL", "Invalid timestamp rows: 2")
    assert got["events", "null_visitor_id"] == ("FAIL", "Null rows: 1")
    assert got["events", "null_event_type"] == ("FAIL", "Null rows: 1")
    assert got["events", "duplicate_event_rows"] == ("WARN", "Duplicate event groups: 1")
    assert got["events", "row_count_positive"] == ("PASS", "Found 6 rows")
    assert got["category_tree", "file_exists"][0] == "FAIL"
    assert got["curated_items", "required_columns"][0] == "FAIL"
    with pytest.raises(RuntimeError):
        expectations.require_passed(report)


def test_merge_replaces_one_model_and_drops_blank_keys(spark, rows):
    existing = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), (" ", 3, "z"), (None, 4, "w")], "model_key string, n int, only_old string")
    current = spark.createDataFrame([("a", 9, 1.5)], "model_key string, n int, only_new double")
    merged = merge.replace_by_key(existing, current, "model_key", "a")
    assert rows(merged, "model_key", "n", "only_old", "only_new") == [("a", 9, None, 1.5), ("b", 2, "y", None)]
    keyless = spark.createDataFrame([(1,)], "n int")
    assert rows(merge.replace_by_key(keyless, current, "model_key", "a")) == rows(current)
    assert rows(merge.replace_by_key(None, current, "model_key", "a")) == rows(current)


def test_rank_all_is_dense_and_ordered(spark):
    df = spark.range(5000).select("id", (F.col("id") % 7).alias("score"))
    ranked = ranking.rank_all(df, [F.col("score").desc(), F.col("id").asc()], "rank").collect()
    expected = sorted(((r.score, r.id) for r in ranked), key=lambda p: (-p[0], p[1]))
    assert [(r.score, r.id) for r in sorted(ranked, key=lambda r: r["rank"])] == expected
    assert sorted(r["rank"] for r in ranked) == list(range(1, 5001))


def test_rank_all_of_nothing(spark):
    df = spark.range(0).select("id")
    assert ranking.rank_all(df, [F.col("id").asc()], "rank").count() == 0


def test_fingerprint_ignores_order_but_not_duplicates(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "i int, t string")
    b = spark.createDataFrame([(2, "y"), (1, "x")], "i int, t string")
    c = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z"), (3, "z")], "i int, t string")
    first = lambda df: tuple(fingerprint.fingerprint(df).first())
    assert first(a) == first(b) and first(a) != first(c)
    assert first(a.limit(0))[0] == 0


def test_activity_histogram_of_equal_counts_has_one_bin(spark, rows):
    users = spark.createDataFrame([(u, 3) for u in range(4)], "user_id bigint, total_events bigint")
    assert rows(profiling.activity_histogram(users), "bin", "user_count") == [(0, 4)]


def test_column_helpers(spark):
    df = spark.sql("select 1 b, 'x' a, cast(null as string) c")
    assert columns.preferred(df, ["a", "zz"]).columns == ["a", "b", "c"]
    assert columns.preferred(df, ["a"], keep_rest=False).columns == ["a"]
    assert columns.missing_columns(df, ["a", "zz"]) == ["zz"]
    assert df.select(columns.row_as_json(df)).first()[0] == '{"a":"x","b":"1","c":null}'


def test_staging_filters_batch_but_not_delta(spark, rows):
    raw = spark.createDataFrame(
        [(1, 1, "categoryid", "5"), (1, 1, "available", "1"), (1, 1, "888", "n1")],
        "timestamp bigint, itemid bigint, property string, value string",
    )
    batch, delta = staging.stage_properties_batch(raw), staging.stage_properties_delta(raw)
    assert (batch.count(), delta.count()) == (2, 3)
    combined = staging.combine_properties(batch, delta)
    assert combined.count() == 5 and "ingestion_timestamp" in combined.columns


def test_feature_documentation_counts_values_as_sql_does(spark):
    df = spark.sql("""
        select * from values
            (9L, 0.0D, 'b', true, date'2026-01-02', 1.50, array(2), cast(null as string)),
            (10L, -0.0D, '', null, date'2026-01-02', 1.5, array(10), null),
            (-1L, double('NaN'), null, false, null, null, array(2), null),
            (10L, null, 'b', true, null, 20, null, null)
        as t(user_id, ratio, name, flag, day, price, list, nothing)""")
    got = registry.feature_documentation(spark, {"user_features": df}, [registry.USER_VIEW])
    wanted = ["column_name", "ordinal_position", "null_rate", "distinct_values", "min_value", "max_value"]
    assert [tuple(row)[:6] for row in got.select(*wanted).orderBy("ordinal_position").collect()] == [
        ("user_id", 1, 0.0, 3, "-1", "10"), ("ratio", 2, 0.25, 2, "0.0", "NaN"), ("name", 3, 0.25, 2, "", "b"),
        ("flag", 4, 0.25, 2, "false", "true"), ("day", 5, 0.5, 1, "2026-01-02", "2026-01-02"),
        ("price", 6, 0.25, 2, "1.50", "20.00"), ("list", 7, 0.25, 2, "[2]", "[10]"), ("nothing", 8, 1.0, 0, None, None),
    ]
    for name in df.columns:
        assert got.where(got.column_name == name).first().distinct_values == df.select(F.count_distinct(name)).first()[0]
    empty = registry.feature_documentation(spark, {"user_features": df.where("false")}, [registry.USER_VIEW])
    assert {(row.null_rate, row.distinct_values, row.min_value) for row in empty.collect()} == {(None, 0, None)}
    assert empty.count() == 8
