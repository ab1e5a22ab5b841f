"""The oracle statement of every registered query that SQL can express.

Doubles are rounded to six decimals and instants are UTC text, as in the
queries. Paths, digests and fingerprints, which only the landing knows, are
compared in the queries themselves and told as true or false.
"""

from __future__ import annotations

from oracle.views import datetime, statement

_EVENT_DT = datetime("event_timestamp_ms")
_PROP_DT = datetime("property_timestamp_ms")
_FIRST_DT = datetime("first_event_timestamp_ms")
_LAST_DT = datetime("last_event_timestamp_ms")

_METADATA = "category_id, parent_category_id, is_available, available_raw_value, has_category_metadata, has_availability_metadata"
_COUNTS = "total_events, view_events, addtocart_events, transaction_events"
_SPAN = f"first_event_timestamp_ms, last_event_timestamp_ms, {_FIRST_DT} as first_event_datetime, {_LAST_DT} as last_event_datetime"


def _r(*names: str) -> str:
    return ", ".join(f"round({name}, 6) as {name}" for name in names)


_STAGED_PROPERTY = f"""
    select property_timestamp_ms, {_PROP_DT} as property_datetime, item_id, property_name, property_value,
           '{{feed}}' as source_feed, source_system, '{{file}}' as source_file, seq{{stamp}}
    from combined where source_system = '{{system}}'"""
_BATCH = _STAGED_PROPERTY.format(feed="item_properties_part1", file="batch", system="catalog_batch", stamp="{stamp}")
_DELTA = _STAGED_PROPERTY.format(
    feed="item_properties_delta", file="delta", system="catalog_api", stamp=", cast(null as varchar) as ingestion_timestamp"
)

_USER_VIEW = f"""
    select user_id, unique_items, {_COUNTS}, {_r('total_interaction_score', 'avg_interaction_weight')}, {_SPAN}, active_days,
           {_r('addtocart_event_rate', 'transaction_event_rate', 'events_per_unique_item')} from user_features_{{s}}"""
_ITEM_VIEW = f"""
    select item_id, unique_users, {_COUNTS}, {_r('total_interaction_score', 'avg_interaction_weight')}, {_SPAN}, {_METADATA},
           {_r('addtocart_rate', 'transaction_rate', 'cart_to_transaction_rate')} from item_features_{{s}}"""
_PAIR_VIEW = f"""
    select user_id, item_id, total_events, view_count, addtocart_count, transaction_count,
           {_r('interaction_score', 'max_event_weight')}, {_SPAN}, has_transaction, has_addtocart,
           category_id, parent_category_id, is_available, has_category_metadata, has_availability_metadata,
           {_r('user_item_addtocart_rate', 'user_item_transaction_rate', 'user_item_cart_to_transaction_rate', 'implicit_label')},
           strongest_event_type from user_item_features_{{s}}"""

_POP_COLUMNS = f"""
    item_id, train_event_count, train_unique_users, train_view_events, train_addtocart_events, train_transaction_events,
    round(train_interaction_score, 6) as train_interaction_score, category_id, parent_category_id, is_available,
    has_category_metadata, has_availability_metadata, {_r('addtocart_rate', 'transaction_rate', 'popularity_score')}, rank"""


def _metrics(view: str) -> str:
    return f"""
    select evaluated_users, hits,
           round(case when evaluated_users > 0 then hits::double / evaluated_users else 0.0 end, 6) as hit_rate_at_10,
           round(case when evaluated_users > 0 then hits::double / (evaluated_users * 10) else 0.0 end, 6) as precision_at_10,
           round(case when evaluated_users > 0 then hits::double / evaluated_users else 0.0 end, 6) as recall_at_10,
           round(case when evaluated_users > 0 then gain / evaluated_users else 0.0 end, 6) as ndcg_at_10
    from {view}"""


_POP_SUMMARY = f"""
    select 'popularity_recommender' as model_name, 'event_weighted_global_popularity' as model_type, 10 as top_k,
           180 as test_window_days, cast(null as integer) as evaluation_sample_users, min_timestamp_ms, max_timestamp_ms, cutoff_timestamp_ms,
           {datetime('min_timestamp_ms')} as min_event_datetime, {datetime('max_timestamp_ms')} as max_event_datetime,
           (select count(*) from staged_orders, bounds_orders where event_timestamp_ms < cutoff_timestamp_ms) as train_event_count,
           (select count(*) from staged_orders, bounds_orders where event_timestamp_ms >= cutoff_timestamp_ms) as test_event_count,
           (select count(*) from pop_scores_orders) as train_distinct_items,
           (select count(*) from pop_scores_orders) as model_saved_item_count,
           1.0::double as model_item_coverage,
           (select count(*) from pop_targets_orders) as test_target_users, m.*
    from bounds_orders, ({_metrics('pop_metrics_orders')}) m"""
_CONTENT_SUMMARY = f"""
    select 'content_based_recommender' as model_name, 'category_content_based_filtering' as model_type, 10 as top_k,
           180 as test_window_days, cast(null as integer) as evaluation_sample_users, min_timestamp_ms, max_timestamp_ms, cutoff_timestamp_ms,
           (select count(*) from candidates_orders) as candidate_item_count,
           (select count(*) from content_targets_orders) as test_target_users,
           (select count(distinct h.user_id) from train_history_orders h join content_targets_orders t on h.user_id = t.user_id) as user_profile_count,
           m.*
    from bounds_orders, ({_metrics('content_metrics_orders')}) m"""
_COMPARISON = f"""
    select 'global_popularity_baseline' as model_family, 'popularity_recommender' as model_name,
           'event_weighted_global_popularity' as model_type, 10 as top_k, a.*,
           'models/popularity_items' as model_artifact_path, 'models/popularity_summary' as training_report_path
    from ({_metrics('pop_metrics_orders')}) a
    union all
    select 'content_based_filtering', 'content_based_recommender', 'category_content_based_filtering', 10, b.*,
           'models/content_candidates', 'models/content_summary'
    from ({_metrics('content_metrics_orders')}) b"""

# every user walks the saved list past the items of the whole history
_POP_SERVED = """
    select u.user_id, r.*, row_number() over (partition by u.user_id order by r.rank) as recommendation_rank
    from full_users_{s} u cross join pop_ranked_{s} r
    where not exists (select 1 from full_history_{s} x where x.user_id = u.user_id and x.item_id = r.item_id)"""
_POP_SERVED_ROWS = f"""
    select 'popularity' as model_key, 'popularity_recommender' as model_name, 'event_weighted_global_popularity' as model_type,
           user_id, cast(recommendation_rank as integer) as recommendation_rank, item_id,
           round(popularity_score, 6) as recommendation_score, round(popularity_score, 6) as popularity_score,
           cast(null as double) as content_score, cast(null as double) as category_score,
           cast(null as double) as parent_category_score, cast(null as double) as metadata_score,
           cast(null as double) as conversion_score, cast(null as double) as popularity_prior,
           train_event_count, train_unique_users, train_view_events, train_addtocart_events, train_transaction_events,
           category_id, parent_category_id, is_available, has_category_metadata, has_availability_metadata,
           false as was_seen_before
    from ({_POP_SERVED}) where recommendation_rank <= 5"""
_CONTENT_SERVED_ROWS = f"""
    select 'content_based' as model_key, 'content_based_recommender' as model_name, 'category_content_based_filtering' as model_type,
           user_id, cast(recommendation_rank as integer) as recommendation_rank, item_id,
           round(content_score, 6) as recommendation_score, round(global_content_prior_score, 6) as popularity_score,
           {_r('content_score', 'category_score', 'parent_category_score', 'metadata_score', 'conversion_score', 'popularity_prior')},
           train_event_count, train_unique_users, train_view_events, train_addtocart_events, train_transaction_events,
           category_id, parent_category_id, is_available, has_category_metadata, has_availability_metadata,
           false as was_seen_before
    from full_lists_{{s}} where recommendation_rank <= 5"""
_ACTIVE = """
    select user_id, total_interaction_score, total_events from user_features_orders
    where addtocart_events > 0 or transaction_events > 0
    order by total_interaction_score desc, total_events desc, user_id limit 5"""

_PROFILES = """
    select user_id, 'category' as profile_kind, category_id as profile_key, round(weight, 6) as profile_weight,
           round(share, 6) as profile_share from full_categories_{s}
    union all
    select user_id, 'parent_category', parent_category_id, round(weight, 6), round(share, 6) from full_parents_{s}"""

_CANDIDATE_COLUMNS = f"""
    item_id, train_event_count, train_unique_users, train_view_events, train_addtocart_events, train_transaction_events,
    round(train_interaction_score, 6) as train_interaction_score, category_id, parent_category_id, is_available,
    has_category_metadata, has_availability_metadata, {_r('addtocart_rate', 'transaction_rate', 'global_content_prior_score')}"""

_SOURCE_PARTS = {
    "events": f"""
        select count(*) as row_count, count(distinct visitorid) as distinct_visitors, count(distinct itemid) as distinct_items,
               min("timestamp") as min_timestamp_ms, max("timestamp") as max_timestamp_ms,
               count(transactionid) as rows_with_transaction_id, count(*) - count(transactionid) as rows_without_transaction_id,
               {datetime('min("timestamp")')} as min_timestamp_datetime, {datetime('max("timestamp")')} as max_timestamp_datetime
        from raw_orders""",
    "properties": f"""
        select count(*) as row_count, count(distinct itemid) as distinct_items, count(distinct property) as distinct_properties,
               min("timestamp") as min_timestamp_ms, max("timestamp") as max_timestamp_ms,
               count(*) - count(value) as null_value_rows,
               {datetime('min("timestamp")')} as min_timestamp_datetime, {datetime('max("timestamp")')} as max_timestamp_datetime
        from raw_properties""",
    "tree": """
        select count(*) as row_count, count(distinct categoryid) as distinct_categories,
               count(distinct parentid) as distinct_parent_categories, count(*) - count(parentid) as root_category_rows from raw_tree""",
}

_TYPE_SUMMARY = """
    select event, count(*) as row_count, count(distinct visitorid) as distinct_visitors,
           count(distinct itemid) as distinct_items, count(transactionid) as rows_with_transaction_id
    from raw_{s} group by event"""

_DUPLICATES = """
    select event_timestamp_ms, visitor_id, event_type, item_id, transaction_id, count(*) as row_count
    from staged_{s} group by all having count(*) > 1"""
_COVERAGE = """
    select count(*) as event_distinct_items, count(c.item_id) as items_with_category, count(a.item_id) as items_with_availability
    from (select distinct item_id from staged_{s}) e left join category_latest c on e.item_id = c.item_id
    left join availability_latest a on e.item_id = a.item_id"""

# dataset: (columns, view, condition)
_DATASETS = {
    "events": (8, "staged_{s}", "true"),
    "category_tree": (5, "staged_tree", "true"),
    "item_properties_batch": (9, "combined", "source_system = 'catalog_batch'"),
    "item_properties_api_delta": (10, "combined", "source_system = 'catalog_api'"),
    "item_properties_combined": (10, "combined", "true"),
    "item_category_latest": (6, "category_latest", "true"),
    "item_availability_latest": (7, "availability_latest", "true"),
    "curated_interactions": (13, "interactions_{s}", "true"),
    "curated_items": (16, "items_{s}", "true"),
    "curated_user_item_interactions": (19, "user_items_{s}", "true"),
}


def _check(dataset: str, name: str, counter: str, label: str, bad: str = "FAIL") -> str:
    return f"""
    select '{dataset}' as dataset_name, '{name}' as check_name, case when n = 0 then 'PASS' else '{bad}' end as status,
           '{label}: ' || n as details from (select count(*) as n from {counter})"""


def _quality() -> str:
    parts = []
    for name, (columns, view, condition) in _DATASETS.items():
        n = f"(select count(*) from {view} where {condition})"
        parts += [
            f"select '{name}' as dataset_name, 'file_exists' as check_name, 'PASS' as status, 'Found dataset: {name}' as details",
            f"select '{name}', 'read_parquet', 'PASS', {n} || ' rows, {columns} columns'",
            f"select '{name}', 'required_columns', 'PASS', 'All required columns found'",
            f"select '{name}', 'row_count_positive', case when {n} > 0 then 'PASS' else 'FAIL' end, 'Found ' || {n} || ' rows'",
        ]

    def grouped(view: str, keys: str) -> str:
        return f"(select 1 from {view} group by {keys} having count(*) > 1)"

    stamp_bad = "event_timestamp_ms is null or event_timestamp_ms <= 0"
    parts += [
        _check("events", "valid_event_types", "staged_{s} where event_type not in ('view', 'addtocart', 'transaction')", "Invalid rows"),
        _check("events", "valid_timestamps", f"staged_{{s}} where {stamp_bad}", "Invalid timestamp rows"),
        *[_check("events", f"null_{c}", f"staged_{{s}} where {c} is null", "Null rows") for c in ("visitor_id", "event_type", "item_id")],
        _check("events", "duplicate_event_rows", f"({_DUPLICATES})", "Duplicate event groups", "WARN"),
        _check("category_tree", "unique_category_id", grouped("staged_tree", "category_id"), "Duplicate category IDs"),
        _check(
            "item_properties_batch", "selected_property_names",
            "combined where source_system = 'catalog_batch' and property_name not in ('categoryid', 'available')",
            "Unexpected batch property rows",
        ),
        *[
            _check("item_properties_api_delta", f"null_{c}", f"combined where source_system = 'catalog_api' and {c} is null", "Null rows")
            for c in ("property_timestamp_ms", "item_id", "property_name", "property_value")
        ],
        """
    select 'item_properties_combined', 'combined_row_count', case when b + d = n then 'PASS' else 'FAIL' end,
           printf('batch=%d, api=%d, combined=%d', b, d, n)
    from (select count(*) filter (where source_system = 'catalog_batch') as b,
                 count(*) filter (where source_system = 'catalog_api') as d, count(*) as n from combined)""",
        _check(
            "item_properties_combined", "valid_property_timestamps",
            "combined where property_timestamp_ms is null or property_timestamp_ms <= 0", "Invalid rows",
        ),
        _check("item_category_latest", "unique_item_id", grouped("category_latest", "item_id"), "Duplicate item IDs"),
        _check("item_availability_latest", "unique_item_id", grouped("availability_latest", "item_id"), "Duplicate item IDs"),
        _check(
            "item_availability_latest", "valid_availability_values",
            "availability_latest where is_available not in (0, 1) or is_available is null", "Invalid availability rows",
        ),
        _check("curated_interactions", "valid_interaction_weights", "interactions_{s} where interaction_weight not in (1.0, 3.0, 5.0)", "Invalid weights"),
        _check("curated_items", "unique_item_id", grouped("items_{s}", "item_id"), "Duplicate item IDs"),
        _check("curated_user_item_interactions", "unique_user_item_key", grouped("user_items_{s}", "user_id, item_id"), "Duplicate user-item keys"),
        *[
            f"""
    select 'referential_coverage', 'event_items_with_{name}', case when {column}::double / event_distinct_items >= 0.5 then 'PASS' else 'WARN' end,
           printf('%d/%d (%.4f)', {column}, event_distinct_items, {column}::double / event_distinct_items) from ({_COVERAGE})"""
            for name, column in (("category", "items_with_category"), ("availability", "items_with_availability"))
        ],
    ]
    return "\nunion all\n".join(parts)


_QUALITY = _quality()

_STAGED_EVENTS = f"""
    select event_timestamp_ms, {_EVENT_DT} as event_datetime, visitor_id, event_type, item_id, transaction_id,
           'catalog' as _source_system, '{{s}}' as _source_file from staged_{{s}}"""
_CATEGORY_LATEST = f"""
    select item_id, category_id, category_timestamp_ms, {datetime('category_timestamp_ms')} as category_datetime, _source_system
    from category_latest"""
_AVAILABILITY_LATEST = f"""
    select item_id, available_raw_value, is_available, availability_timestamp_ms,
           {datetime('availability_timestamp_ms')} as availability_datetime, _source_system from availability_latest"""
_WITH_FILE = "select *, case when _source_system = 'catalog_batch' then 'batch' else 'delta' end as _source_file from ({0})"

_LANDED = "select * from landed_delta"

# statements on the order events; "{s}" stands for the source
_BOTH = {
    "stage_events": _STAGED_EVENTS,
    "curated_interactions": f"""
        select user_id, item_id, event_type, event_timestamp_ms, {_EVENT_DT} as event_datetime, transaction_id,
               round(interaction_weight, 6) as interaction_weight, {_METADATA} from interactions_{{s}}""",
    "curated_items": f"select item_id, unique_users, {_COUNTS}, {_SPAN}, {_METADATA} from items_{{s}}",
    "curated_user_items": f"""
        select user_id, item_id, total_events, view_count, addtocart_count, transaction_count,
               {_r('interaction_score', 'max_event_weight')}, {_SPAN}, category_id, parent_category_id, is_available,
               has_category_metadata, has_availability_metadata, has_transaction, has_addtocart from user_items_{{s}}""",
    "user_features": _USER_VIEW,
    "item_features": _ITEM_VIEW,
    "user_item_features": _PAIR_VIEW,
    "event_type_summary": _TYPE_SUMMARY,
    "quality_report": _QUALITY,
    "test_targets_latest": "select user_id, target_item_id, round(target_weight, 6) as target_weight, last_target_ms from pop_targets_{s}",
    "test_targets_earliest": "select user_id, target_item_id, round(target_weight, 6) as target_weight, first_target_ms from content_targets_{s}",
    "popularity_ranking": f"select {_POP_COLUMNS} from pop_ranked_{{s}}",
    "popularity_metrics": _metrics("pop_metrics_{s}"),
    "popularity_recommendations": _POP_SERVED_ROWS,
    "user_profiles": _PROFILES,
    "content_candidates": f"select {_CANDIDATE_COLUMNS} from candidates_all_{{s}}",
    "popularity_metrics_sampled": _metrics("""(
        select count(distinct user_id) as evaluated_users, count(*) filter (where item_id = target_item_id) as hits,
               coalesce(sum(1.0::double / log2(position + 1)) filter (where item_id = target_item_id), 0.0) as gain
        from pop_lists_{s} where position <= 10 and user_id in (select user_id from pop_sample_{s}))"""),
    "content_metrics_sampled": _metrics("""(
        select count(distinct l.user_id) as evaluated_users, count(*) filter (where item_id = target_item_id) as hits,
               coalesce(sum(1.0::double / log2(recommendation_rank + 1)) filter (where item_id = target_item_id), 0.0) as gain
        from train_lists_{s} l join content_sample_{s} t on l.user_id = t.user_id where recommendation_rank <= 10)"""),
    "popularity_recommendations_head": _POP_SERVED_ROWS.replace("cross join pop_ranked_{s} r", "cross join (select * from pop_ranked_{s} where rank <= 100) r"),
    "content_recommendations_head": _CONTENT_SERVED_ROWS.replace("from full_lists_{s}", """from (
        select * replace (row_number() over (partition by user_id order by recommendation_rank) as recommendation_rank)
        from full_lists_{s} where item_id in (select item_id from head_candidates_{s}))"""),
    "content_recommendations": _CONTENT_SERVED_ROWS,
    "content_metrics": _metrics("content_metrics_{s}"),
}
_ORDERS_ONLY = {
    "stage_category_tree": "select *, 'catalog' as _source_system, 'tree' as _source_file from staged_tree",
    "stage_item_properties_batch": _BATCH.format(stamp=""),
    "stage_item_properties_delta": _DELTA,
    "combined_properties": _BATCH.format(stamp=", cast(null as varchar) as ingestion_timestamp") + " union all " + _DELTA,
    "item_category_latest": _WITH_FILE.format(_CATEGORY_LATEST),
    "item_availability_latest": _WITH_FILE.format(_AVAILABILITY_LATEST),
    "mart_user_features": f"""
        select user_id, unique_items, {_COUNTS}, {_r('total_interaction_score', 'avg_interaction_weight')}, {_SPAN} from mart_users_{{s}}""",
    "mart_item_features": f"""
        select item_id, unique_users, {_COUNTS}, {_r('total_interaction_score', 'avg_interaction_weight')}, {_SPAN}, {_METADATA}
        from mart_items_{{s}}""",
    "profile_events": _SOURCE_PARTS["events"],
    "profile_properties": _SOURCE_PARTS["properties"],
    "category_profile": _SOURCE_PARTS["tree"],
    "source_profile": f"""
        select 'events' as dataset_name, * from ({_SOURCE_PARTS['events']})
        union all by name select 'item_properties_part1' as dataset_name, * from ({_SOURCE_PARTS['properties']})
        union all by name select 'category_tree' as dataset_name, * from ({_SOURCE_PARTS['tree']})""",
    "top_properties": """
        select property, count(*) as row_count, count(distinct itemid) as distinct_items, count(distinct value) as distinct_values
        from raw_properties group by property order by row_count desc, property limit 30""",
    "category_tree_sample": "select categoryid, cast(parentid as varchar) as parentid from raw_tree order by categoryid limit 20",
    "event_distribution": f"select event, row_count from ({_TYPE_SUMMARY})",
    "activity_histogram": """
        select cast(bin as integer) as bin, round(low + bin * (high - low) / 50, 6) as bin_start,
               round(low + (bin + 1) * (high - low) / 50, 6) as bin_end, user_count
        from (select bin, low, high, count(*) as user_count
              from (select least(floor((least(total_events, high) - low) / ((high - low) / 50)), 49) as bin, low, high
                    from user_features_{s}, (select min(total_events)::double as low, quantile_cont(total_events, 0.99) as high
                                             from user_features_{s})) group by bin, low, high)""",
    "top_item_bars": "select cast(item_id as varchar) as item_id, round(popularity_score, 6) as popularity_score from pop_ranked_{s} where rank <= 20",
    "quality_status": f"select status, count(*) as check_count from ({_QUALITY}) group by status",
    "quality_problems": f"select * from ({_QUALITY}) where status in ('WARN', 'FAIL')",
    "duplicate_events": _DUPLICATES,
    "referential_coverage": _COVERAGE,
    "time_bounds": "select min_timestamp_ms, max_timestamp_ms from bounds_{s}",
    "train_test_counts": """
        select count(*) filter (where event_timestamp_ms < cutoff_timestamp_ms) as train_event_count,
               count(*) filter (where event_timestamp_ms >= cutoff_timestamp_ms) as test_event_count from staged_{s}, bounds_{s}""",
    "scattered_user_sample": """
        select user_id, target_item_id, round(target_weight, 6) as target_weight, last_target_ms from pop_sample_{s}""",
    "first_user_sample": """
        select user_id, target_item_id, round(target_weight, 6) as target_weight, first_target_ms from content_sample_{s}""",
    "popularity_examples": """
        select l.user_id, cast(l.position as integer) as recommendation_rank, l.item_id, l.target_item_id,
               l.item_id = l.target_item_id as is_hit, round(r.popularity_score, 6) as popularity_score, r.train_event_count,
               r.train_unique_users, r.train_addtocart_events, r.train_transaction_events, r.category_id, r.parent_category_id,
               r.is_available
        from pop_lists_{s} l join pop_ranked_{s} r on l.item_id = r.item_id
        where l.position <= 5 and l.user_id in (
            select user_id from pop_targets_{s}
            order by (user_id % 1000003 + 1000003) % 1000003 * 2654435761 % 4294967296, user_id limit 5)""",
    "train_seen_items": "select s.user_id, s.item_id from pop_seen_{s} s join pop_targets_{s} t on s.user_id = t.user_id",
    "popularity_topn": f"select {_POP_COLUMNS} from pop_ranked_{{s}} where rank <= 10",
    "popularity_summary": _POP_SUMMARY,
    "active_users": "select user_id, round(total_interaction_score, 6) as total_interaction_score, total_events from (" + _ACTIVE + ")",
    "content_summary": _CONTENT_SUMMARY,
    "content_examples": f"""
        select l.user_id, item_id, {_r('content_score', 'category_score', 'parent_category_score', 'metadata_score',
                                        'conversion_score', 'popularity_prior')}, category_id, parent_category_id, is_available,
               train_event_count, round(train_interaction_score, 6) as train_interaction_score,
               cast(recommendation_rank as integer) as recommendation_rank, target_item_id, item_id = target_item_id as is_hit
        from train_lists_{{s}} l join content_targets_{{s}} t on l.user_id = t.user_id
        join (select user_id, coalesce(sum(n) over (order by user_id rows between unbounded preceding and 1 preceding), 0) as before
              from (select user_id, count(*) as n from train_lists_{{s}} where recommendation_rank <= 5 group by user_id)) b
          on b.user_id = l.user_id
        where recommendation_rank <= 5 and before < 25""",
    "active_user_recommendations": f"""
        select * from ({_POP_SERVED_ROWS}) where user_id in (select user_id from ({_ACTIVE}))
        union all by name
        select * from ({_CONTENT_SERVED_ROWS}) where user_id in (select user_id from ({_ACTIVE}))""",
    "feature_retrieval": f"""
        select c_custkey as user_id, total_events, unique_items,
               {_r('total_interaction_score')}, active_days, {_r('events_per_unique_item')}
        from customer left join user_features_{{s}} on c_custkey = user_id""",
    "feature_point_lookup": f"""
        select v.* from ({_PAIR_VIEW}) v
        join (select user_id, item_id from user_item_features_{{s}}
              order by has_transaction desc, has_addtocart desc, interaction_score desc, user_id, item_id limit 1) p
          on v.user_id = p.user_id and v.item_id = p.item_id""",
    "sample_pair": """
        select user_id, item_id, round(interaction_score, 6) as interaction_score, has_transaction, has_addtocart
        from user_item_features_{s}
        order by has_transaction desc, has_addtocart desc, interaction_score desc, user_id, item_id limit 1""",
    "model_comparison": _COMPARISON,
    "metric_matrix": f"""
        select metric, max(case when model_family = 'global_popularity_baseline' then score end) as global_popularity_baseline,
               max(case when model_family = 'content_based_filtering' then score end) as content_based_filtering
        from (unpivot (select model_family, hit_rate_at_10, precision_at_10, recall_at_10, ndcg_at_10 from ({_COMPARISON}))
              on hit_rate_at_10, precision_at_10, recall_at_10, ndcg_at_10 into name metric value score)
        group by metric""",
    "inference_summary": f"""
        select 'popularity' as model_key, 'popularity_recommender' as model_name, 'event_weighted_global_popularity' as model_type,
               'models/popularity_items' as model_artifact_path, (select count(*) from full_users_{{s}}) as requested_user_count,
               5 as top_k, (select count(*) from ({_POP_SERVED}) where recommendation_rank <= 5) as recommendation_rows,
               (select count(distinct item_id) from ({_POP_SERVED}) where recommendation_rank <= 5) as distinct_recommended_items,
               model_saved_item_count as candidate_or_saved_item_count, hit_rate_at_10 as training_hit_rate_at_10,
               precision_at_10 as training_precision_at_10, recall_at_10 as training_recall_at_10, ndcg_at_10 as training_ndcg_at_10,
               train_event_count, test_event_count, test_target_users
        from ({_POP_SUMMARY})""",
    "report_merge": """
        select item_id, count(*) as old_users, 'content_based' as model_key, cast(null as bigint) as new_users
        from user_items_{s} where item_id % 4 = 2 group by item_id
        union all
        select item_id, null, 'popularity', count(*) from user_items_{s} where transaction_count > 0 group by item_id""",
    "landing_manifest": f"""
        select 'catalog_api' as source_system, 'item_properties_delta' as data_type, ingestion_timestamp, 'parquet' as format,
               count(*) as row_count, case when min(seq % 5) < 4 then cast(min(seq % 5) as varchar) end as cursor
        from ({_LANDED}) group by ingestion_timestamp""",
    "landed_delta_rows": _LANDED,
    "latest_partition_rows": f"select * from ({_LANDED}) where ingestion_timestamp = '20260101_020000'",
    "ingest_counters": f"""
        select '3' as cursor, count(*) as records_ingested_total, max(ingestion_timestamp) as last_ingestion_timestamp,
               count(distinct ingestion_timestamp) as landed_partitions from ({_LANDED})""",
    "payload_records": """
        select "timestamp", itemid, property, value, source_system, '20260101_000000' as ingestion_timestamp
        from raw_properties where source_system = 'catalog_api'""",
    "table_inventory": "\nunion all\n".join(
        f"select '{layer}' as schema_name, '{name}' as relation_name, 'BASE TABLE' as relation_type, count(*) as row_count, "
        f"{columns} as column_count, case when count(*) > 0 then 'PASS' else 'FAIL' end as status from {view}"
        for layer, name, columns, view in (
            ("staged", "events", 8, "staged_{s}"), ("staged", "category_tree", 5, "staged_tree"),
            ("staged", "item_properties_combined", 10, "combined"), ("curated", "items", 16, "items_{s}"),
            ("features", "user_features", 16, "user_features_{s}"),
        )
    ),
    "stream_latest_category": _CATEGORY_LATEST,
    "stream_latest_availability": _AVAILABILITY_LATEST,
    "stream_delta_append": f"""
        select "timestamp" as property_timestamp_ms, {datetime('"timestamp"')} as property_datetime, itemid as item_id,
               property as property_name, value as property_value, 'item_properties_delta' as source_feed, source_system, seq,
               ingestion_timestamp from ({_LANDED})""",
}


_VIEW_COLUMNS = {
    "user_features": (
        "user_id total_events unique_items view_events addtocart_events transaction_events total_interaction_score "
        "avg_interaction_weight first_event_timestamp_ms last_event_timestamp_ms first_event_datetime last_event_datetime "
        "active_days addtocart_event_rate transaction_event_rate events_per_unique_item"
    ).split(),
    "item_features": (
        "item_id total_events unique_users view_events addtocart_events transaction_events total_interaction_score "
        "avg_interaction_weight first_event_timestamp_ms last_event_timestamp_ms first_event_datetime last_event_datetime "
        "category_id parent_category_id is_available available_raw_value has_category_metadata has_availability_metadata "
        "addtocart_rate transaction_rate cart_to_transaction_rate"
    ).split(),
    "user_item_features": (
        "user_id item_id total_events view_count addtocart_count transaction_count interaction_score max_event_weight "
        "first_event_timestamp_ms last_event_timestamp_ms first_event_datetime last_event_datetime has_transaction "
        "has_addtocart category_id parent_category_id is_available has_category_metadata has_availability_metadata "
        "user_item_addtocart_rate user_item_transaction_rate user_item_cart_to_transaction_rate implicit_label "
        "strongest_event_type"
    ).split(),
}
_VIEW_KEYS = {"user_features": ["user_id"], "item_features": ["item_id"], "user_item_features": ["user_id", "item_id"]}
_DESCRIPTIVE = {
    "category_id", "parent_category_id", "is_available", "available_raw_value", "has_category_metadata",
    "has_availability_metadata", "first_event_timestamp_ms", "last_event_timestamp_ms", "first_event_datetime",
    "last_event_datetime", "strongest_event_type",
}
_DOUBLES = ("_rate", "_score", "_weight", "_label", "events_per_unique_item")
_INTEGERS = ("is_available", "has_category_metadata", "has_availability_metadata", "has_transaction", "has_addtocart")
_TEXTS = ("available_raw_value", "strongest_event_type")


def _type(name: str) -> str:
    if name.endswith(_DOUBLES):
        return "double"
    return "timestamp" if name.endswith("_datetime") else "int" if name in _INTEGERS else "string" if name in _TEXTS else "bigint"


def _role(view: str, name: str) -> str:
    return "entity_key" if name in _VIEW_KEYS[view] else "metadata" if name in _DESCRIPTIVE else "feature"


def _documented(view: str, name: str, place: int) -> str:
    source, kind = name.replace("_datetime", "_timestamp_ms"), _type(name)
    extremes = []
    for end in ("min", "max"):
        value = f"{end}({source})"
        text = "cast(null as varchar)" if kind == "double" else datetime(value) if kind == "timestamp" else f"cast({value} as varchar)"
        number = f"round({value}, 6)" if kind == "double" else "cast(null as double)"
        extremes += [f"{text} as {end}_value", f"{number} as {end}_number"]
    return f"""
    select '{view}' as feature_view_name, '{name}' as column_name, {place} as ordinal_position, '{kind}' as data_type,
           '{_role(view, name)}' as feature_role, round(count(*) filter (where {source} is null)::double / count(*), 6) as null_rate,
           count(distinct {source}) as distinct_values, {", ".join(extremes)} from {view}_{{s}}"""


def _object(entries: dict[str, str]) -> str:
    return "{" + ",".join(f'"{key}":"{value}"' for key, value in sorted(entries.items())) + "}"


def _registered(view: str) -> str:
    keys = _VIEW_KEYS[view]
    names = [name for name in _VIEW_COLUMNS[view] if name not in keys]
    quoted = ", ".join(f'"{key}"' for key in keys)
    return f"""
    select '{view}' as feature_view_name, 'v1' as feature_view_version, '[{quoted}]' as entity_keys,
           'features.{view}' as source_table, true as source_exists, {len(names)} as feature_count,
           '{", ".join(names)}' as feature_names,
           '{_object({name: _type(name) for name in _VIEW_COLUMNS[view]})}' as data_types,
           '{_object({name: _role(view, name) for name in _VIEW_COLUMNS[view]})}' as feature_roles, count(*) as row_count, count(distinct ({", ".join(keys)})) as distinct_keys
    from {view}_{{s}}"""


_STRONGEST = """
    select user_id, item_id from user_item_features_{s}
    order by has_transaction desc, has_addtocart desc, interaction_score desc, user_id, item_id limit 1"""


def _retrieved(view: str) -> str:
    keys = _VIEW_KEYS[view]
    text = " || ',' || ".join(f"'{key}=' || p.{key}" for key in keys)
    match = " and ".join(f"v.{key} = p.{key}" for key in keys)
    return f"""
    select '{view}' as retrieval_type, '{view}' as feature_view_name, 'v1' as feature_view_version, {text} as entity_filter,
           cast(1 as bigint) as rows_returned, {len(_VIEW_COLUMNS[view])} as columns_returned, cast(v.total_events as varchar) as total_events,
           cast(v.first_event_timestamp_ms as varchar) as first_event_timestamp_ms
    from {view}_{{s}} v join ({_STRONGEST}) p on {match}"""


_ORDERS_ONLY |= {
    "feature_documentation": "\nunion all\n".join(
        _documented(view, name, place) for view, names in _VIEW_COLUMNS.items() for place, name in enumerate(names, 1)
    ),
    "registry_summary": "\nunion all\n".join(_registered(view) for view in _VIEW_COLUMNS),
    "retrieval_summary": "\nunion all\n".join(_retrieved(view) for view in _VIEW_COLUMNS),
    "raw_quality_report": """
        select 'raw_api_item_properties_delta:ingestion_timestamp=' || ingestion_timestamp as dataset_name,
               check_name, 'PASS' as status,
               case check_name when 'normalized_parquet_row_count' then cast(n as varchar)
                               when 'source_system' then 'catalog_api' end as details
        from landed_counts, (values ('parquet_exists'), ('normalized_parquet_schema'), ('normalized_parquet_row_count'),
                             ('checksum_matches_metadata'), ('source_system')) c(check_name)
        union all
        select 'raw_api_item_properties_delta', check_name, 'PASS',
               case check_name when 'partition_count_positive' then 'Found ' || partitions || ' API delta partitions'
                               when 'total_partition_rows_positive' then 'Total rows across API partitions: ' || total
                               when 'state_file_exists' then last_stamp else '3' end
        from (select count(*) as partitions, sum(n) as total, max(ingestion_timestamp) as last_stamp from landed_counts),
             (values ('partition_count_positive'), ('total_partition_rows_positive'), ('state_file_exists'), ('state_cursor')) c(check_name)""",
}


_PAGES = """(
        select page, count(*) as n_records, page % 25 = 3 as bad,
               case page % 5 when 0 then '20260101_000000' when 1 then '20260101_003000' when 2 then '20260101_010000'
                             when 3 then '20260101_013000' else '20260101_020000' end as ingestion_timestamp
        from (select seq // 100 as page from raw_properties where source_system = 'catalog_api') group by page)"""
_PAGE_TOTALS = f"""(
        select ingestion_timestamp, sum(n_records) as found, coalesce(sum(n_records) filter (where not bad), 0) as landed,
               count(*) filter (where bad) > 0 as broken
        from {_PAGES} group by ingestion_timestamp)"""
_BATCHES = """(
        select 'events' as data_type, count(*) as n from raw_{s} union all
        select 'item_properties', count(*) from raw_properties union all select 'category_tree', count(*) from raw_tree)"""

_ORDERS_ONLY |= {
    "batch_landing_manifest": f"""
        select 'catalog_batch' as source_system, data_type, '20260101_000000' as ingestion_timestamp, 'csv' as format, n as row_count,
               true as same_files, true as same_bytes, true as same_checksum, cast(null as varchar) as api_contract,
               cast(null as bigint) as api_count, cast(null as bigint) as total_rows, cast(null as bigint) as unread_rows,
               cast(null as boolean) as api_success, cast(null as varchar) as cursor from {_BATCHES}""",
    "batch_quality_report": f"""
        select 'raw_batch_' || data_type as dataset_name, check_name,
               case when data_type = 'category_tree' and check_name in ('row_count_matches_metadata', 'checksum_matches_metadata')
                    then 'FAIL' else 'PASS' end as status,
               case check_name
                    when 'partition_name' then 'ingestion_timestamp=20260101_000000'
                    when 'row_count_matches_metadata' then
                        case when data_type = 'category_tree' then 'metadata=' || n || ', actual=' || 2 * n else cast(n as varchar) end
                    when 'source_system' then 'catalog_batch' end as details
        from {_BATCHES}, (values ('raw_file_exists'), ('partition_name'), ('row_count_matches_metadata'),
                                 ('checksum_matches_metadata'), ('source_system')) c(check_name)
        union all
        select 'raw_batch_prices', 'raw_batch_validation', 'FAIL', 'no landed partitions of prices as csv: run the landing step first'""",
    "landing_fingerprints": """
        select ingestion_timestamp, format, n as row_count, n as source_rows, true as same_fingerprint, true as has_digest
        from landed_counts, (values ('parquet'), ('csv'), ('json')) f(format)""",
    "csv_events_roundtrip": _STAGED_EVENTS,
    "csv_properties_roundtrip": 'select "timestamp", itemid, property, value from raw_properties',
    "json_array_rows": """select "timestamp", itemid, property, value from raw_properties where source_system = 'catalog_api'""",
    "landed_presence": """
        select 'item_properties_delta' as data_type, format, ingestion_timestamp,
               case when format = 'json' and ingestion_timestamp = '20260101_003000' then 'missing' else 'present' end as presence
        from landed_counts, (values ('parquet'), ('json')) f(format)
        union all select 'item_properties_delta', 'parquet', '20260101_023000', 'unlisted'""",
    "response_contract_report": f"""
        select 'raw_api_item_properties_delta:ingestion_timestamp=' || ingestion_timestamp as dataset_name, check_name,
               case check_name when 'csv_exists' then 'FAIL'
                               when 'raw_response_contract' then case when broken then 'FAIL' else 'PASS' end
                               when 'row_count_matches_metadata' then case when found = landed then 'PASS' else 'FAIL' end
                               else 'PASS' end as status,
               case check_name when 'csv_exists' then 'not landed'
                               when 'raw_response_contract' then case when broken then 'success is false' else 'data_contract' end
                               when 'row_count_matches_metadata' then case when found = landed then cast(found as varchar)
                                    else 'metadata=' || landed || ', actual=' || found end
                               when 'normalized_parquet_row_count' then cast(landed as varchar)
                               when 'source_system' then 'catalog_api' end as details
        from {_PAGE_TOTALS}, (values ('parquet_exists'), ('csv_exists'), ('raw_response_exists'), ('raw_response_contract'),
                                     ('row_count_matches_metadata'), ('normalized_parquet_schema'), ('normalized_parquet_row_count'),
                                     ('checksum_matches_metadata'), ('source_system')) c(check_name)
        union all
        select 'raw_api_item_properties_delta', check_name, 'PASS',
               case check_name when 'partition_count_positive' then 'Found ' || partitions || ' API delta partitions'
                               when 'total_partition_rows_positive' then 'Total rows across API partitions: ' || total
                               when 'state_file_exists' then last_stamp else 'none' end
        from (select count(*) as partitions, sum(landed) as total, max(ingestion_timestamp) as last_stamp from {_PAGE_TOTALS}),
             (values ('partition_count_positive'), ('total_partition_rows_positive'), ('state_file_exists'), ('state_cursor')) c(check_name)""",
    "quarantined_pages": f"""
        select ingestion_timestamp, 'success is false' as problem, cast(n_records as integer) as n_records from {_PAGES} where bad""",
    "streamed_response_records": f"""
        select "timestamp", itemid, property, value, source_system, ingestion_timestamp
        from raw_properties join {_PAGES} p on seq // 100 = page where source_system = 'catalog_api' and not bad""",
    "event_type_csv_report": _TYPE_SUMMARY,
    "layer_inventory": """
        select schema_name, relation_name, relation_type, n as row_count, column_count, 'PASS' as status
        from (select count(*) as n from staged_{s}),
             (values ('staged', 'events', 'BASE TABLE', 6), ('curated', 'interactions', 'BASE TABLE', 4), ('mart', 'interactions', 'VIEW', 4))
             r(schema_name, relation_name, relation_type, column_count)
        union all select 'mart', 'gone', 'MISSING', null, null, 'FAIL'""",
    "layer_schema_summary": """
        select schema_name, table_name, column_name, ordinal_position, data_type, 'YES' as is_nullable
        from (values ('staged', 'events', 'event_timestamp_ms', 1, 'bigint'), ('staged', 'events', 'event_datetime', 2, 'timestamp'),
                     ('staged', 'events', 'visitor_id', 3, 'bigint'), ('staged', 'events', 'event_type', 4, 'string'),
                     ('staged', 'events', 'item_id', 5, 'bigint'), ('staged', 'events', 'transaction_id', 6, 'bigint'),
                     ('curated', 'interactions', 'user_id', 1, 'bigint'), ('curated', 'interactions', 'item_id', 2, 'bigint'),
                     ('curated', 'interactions', 'event_type', 3, 'string'), ('curated', 'interactions', 'interaction_weight', 4, 'double'),
                     ('mart', 'interactions', 'user_id', 1, 'bigint'), ('mart', 'interactions', 'item_id', 2, 'bigint'),
                     ('mart', 'interactions', 'event_type', 3, 'string'), ('mart', 'interactions', 'interaction_weight', 4, 'double'))
             c(schema_name, table_name, column_name, ordinal_position, data_type)""",
    "mart_view_totals": """
        select event_type, count(*) as row_count, round(sum(interaction_weight), 6) as total_weight from interactions_{s} group by event_type""",
    "stored_model_recommendations": _POP_SERVED_ROWS,
    "listed_user_features": """
        select user_id, total_events, unique_items from user_features_{s} where user_id in (select user_id from (""" + _ACTIVE + "))",
}


def all_statements() -> dict[str, str]:
    found = {}
    for name, body in {**_BOTH, **_ORDERS_ONLY}.items():
        found[name] = statement(body.replace("{s}", "orders"))
    for name, body in _BOTH.items():
        found[f"{name}_clicks"] = statement(body.replace("{s}", "clicks"))
    return found
