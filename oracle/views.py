"""Named subqueries shared by the oracle statements.

A statement names the views it needs; ``statement`` prefixes them as CTEs in
dependency order. Views ending in _orders or _clicks exist for both sources.
"""

from __future__ import annotations

import re

DAY_MS = 86_400_000
DATETIME = "strftime(make_timestamp(({ms}) * 1000), '%Y-%m-%d %H:%M:%S.%g')"


def datetime(ms: str) -> str:
    return DATETIME.format(ms=ms)


VIEWS: dict[str, str] = {
    "raw_clicks": """
        select epoch_us(ts) // 1000 as "timestamp", user_id as visitorid,
               case event_type when 'click' then 'addtocart' when 'purchase' then 'transaction' else event_type end as event,
               cast(json_extract_string(props, '$.k') as bigint) as itemid,
               case when event_type = 'purchase' then event_id end as transactionid
        from events""",
    "raw_orders": """
        select epoch_ms(o_orderdate) as "timestamp", o_custkey as visitorid,
               case l_returnflag when 'N' then 'view' when 'A' then 'addtocart' else 'transaction' end as event,
               l_partkey as itemid, case when l_returnflag = 'R' then o_orderkey end as transactionid
        from lineitem join orders on l_orderkey = o_orderkey""",
    "raw_properties": """
        select epoch_ms(l_shipdate) as "timestamp", l_partkey as itemid, 'categoryid' as property,
               cast(s_nationkey + 10 as varchar) as value,
               case when l_returnflag = 'A' then 'catalog_api' else 'catalog_batch' end as source_system,
               l_orderkey * 10 + l_linenumber as seq
        from lineitem join supplier on l_suppkey = s_suppkey where l_quantity >= 48
        union all
        select epoch_ms(l_shipdate), l_partkey, 'available', case when l_linestatus = 'O' then '1' else 'False' end,
               case when l_returnflag = 'A' then 'catalog_api' else 'catalog_batch' end,
               l_orderkey * 10 + l_linenumber
        from lineitem where l_quantity <= 3""",
    "raw_tree": """
        select cast(n_nationkey + 10 as bigint) as categoryid, cast(n_regionkey as bigint) as parentid from nation
        union all select cast(r_regionkey as bigint), null from region""",
    "staged_tree": """
        select categoryid as category_id, parentid as parent_category_id,
               case when parentid is null then 1 else 0 end as is_root_category from raw_tree""",
    "combined": """
        select "timestamp" as property_timestamp_ms, itemid as item_id, property as property_name,
               value as property_value, source_system, seq from raw_properties""",
    "category_latest": """
        select item_id, try_cast(property_value as bigint) as category_id, property_timestamp_ms as category_timestamp_ms,
               source_system as _source_system
        from (select *, row_number() over (partition by item_id
                     order by property_timestamp_ms desc, source_system desc, seq desc) as rn
              from combined where property_name = 'categoryid') where rn = 1""",
    "availability_latest": """
        select item_id, property_value as available_raw_value,
               case when lower(property_value) in ('1', 'true') then 1
                    when lower(property_value) in ('0', 'false') then 0 end as is_available,
               property_timestamp_ms as availability_timestamp_ms, source_system as _source_system
        from (select *, row_number() over (partition by item_id
                     order by property_timestamp_ms desc, source_system desc, seq desc) as rn
              from combined where property_name = 'available') where rn = 1""",
    "landed_delta": """
        select "timestamp", itemid, property, value, source_system, seq,
               case seq % 5 when 0 then '20260101_000000' when 1 then '20260101_003000' when 2 then '20260101_010000'
                            when 3 then '20260101_013000' else '20260101_020000' end as ingestion_timestamp
        from raw_properties where source_system = 'catalog_api'""",
    "landed_counts": "select ingestion_timestamp, count(*) as n from landed_delta group by ingestion_timestamp",
}

_PER_SOURCE = {
    "staged": """
        select "timestamp" as event_timestamp_ms, visitorid as visitor_id, event as event_type, itemid as item_id,
               try_cast(transactionid as bigint) as transaction_id from raw_{s}""",
    "interactions": """
        select e.visitor_id as user_id, e.item_id, e.event_type, e.event_timestamp_ms, e.transaction_id,
               cast(case when e.event_type = 'view' then 1.0 when e.event_type = 'addtocart' then 3.0
                         when e.event_type = 'transaction' then 5.0 else 0.0 end as double) as interaction_weight,
               c.category_id, t.parent_category_id, a.is_available, a.available_raw_value,
               case when c.item_id is not null then 1 else 0 end as has_category_metadata,
               case when a.item_id is not null then 1 else 0 end as has_availability_metadata
        from staged_{s} e left join category_latest c on e.item_id = c.item_id
        left join staged_tree t on c.category_id = t.category_id
        left join availability_latest a on e.item_id = a.item_id""",
    "items": """
        select i.*, c.category_id, t.parent_category_id, a.is_available, a.available_raw_value,
               case when c.item_id is not null then 1 else 0 end as has_category_metadata,
               case when a.item_id is not null then 1 else 0 end as has_availability_metadata
        from (select item_id, count(*) as total_events, count(distinct visitor_id) as unique_users,
                     count(*) filter (where event_type = 'view') as view_events,
                     count(*) filter (where event_type = 'addtocart') as addtocart_events,
                     count(*) filter (where event_type = 'transaction') as transaction_events,
                     min(event_timestamp_ms) as first_event_timestamp_ms, max(event_timestamp_ms) as last_event_timestamp_ms
              from staged_{s} group by item_id) i
        left join category_latest c on i.item_id = c.item_id
        left join staged_tree t on c.category_id = t.category_id
        left join availability_latest a on i.item_id = a.item_id""",
    "user_items": """
        select user_id, item_id, count(*) as total_events,
               count(*) filter (where event_type = 'view') as view_count,
               count(*) filter (where event_type = 'addtocart') as addtocart_count,
               count(*) filter (where event_type = 'transaction') as transaction_count,
               sum(interaction_weight) as interaction_score, max(interaction_weight) as max_event_weight,
               min(event_timestamp_ms) as first_event_timestamp_ms, max(event_timestamp_ms) as last_event_timestamp_ms,
               max(category_id) as category_id, max(parent_category_id) as parent_category_id,
               max(is_available) as is_available, max(has_category_metadata) as has_category_metadata,
               max(has_availability_metadata) as has_availability_metadata,
               max(case when event_type = 'transaction' then 1 else 0 end) as has_transaction,
               max(case when event_type = 'addtocart' then 1 else 0 end) as has_addtocart
        from interactions_{s} group by user_id, item_id""",
    "mart_users": """
        select user_id, count(*) as total_events, count(distinct item_id) as unique_items,
               count(*) filter (where event_type = 'view') as view_events,
               count(*) filter (where event_type = 'addtocart') as addtocart_events,
               count(*) filter (where event_type = 'transaction') as transaction_events,
               sum(interaction_weight) as total_interaction_score, avg(interaction_weight) as avg_interaction_weight,
               min(event_timestamp_ms) as first_event_timestamp_ms, max(event_timestamp_ms) as last_event_timestamp_ms
        from interactions_{s} group by user_id""",
    "mart_items": """
        select item_id, total_events, unique_users, view_events, addtocart_events, transaction_events,
               cast(view_events * 1.0 + addtocart_events * 3.0 + transaction_events * 5.0 as double) as total_interaction_score,
               cast(view_events * 1.0 + addtocart_events * 3.0 + transaction_events * 5.0 as double) / total_events as avg_interaction_weight,
               first_event_timestamp_ms, last_event_timestamp_ms, category_id, parent_category_id, is_available,
               available_raw_value, has_category_metadata, has_availability_metadata
        from items_{s}""",
    "user_features": """
        select *, date_diff('day', cast(make_timestamp(first_event_timestamp_ms * 1000) as date),
                                   cast(make_timestamp(last_event_timestamp_ms * 1000) as date)) + 1 as active_days,
               case when total_events > 0 then addtocart_events::double / total_events else 0.0 end as addtocart_event_rate,
               case when total_events > 0 then transaction_events::double / total_events else 0.0 end as transaction_event_rate,
               case when unique_items > 0 then total_events::double / unique_items else 0.0 end as events_per_unique_item
        from mart_users_{s}""",
    "item_features": """
        select *, case when view_events > 0 then addtocart_events::double / view_events else 0.0 end as addtocart_rate,
               case when view_events > 0 then transaction_events::double / view_events else 0.0 end as transaction_rate,
               case when addtocart_events > 0 then transaction_events::double / addtocart_events else 0.0 end as cart_to_transaction_rate
        from mart_items_{s}""",
    "user_item_features": """
        select ui.user_id, ui.item_id, ui.total_events, ui.view_count, ui.addtocart_count, ui.transaction_count,
               ui.interaction_score, ui.max_event_weight, ui.first_event_timestamp_ms, ui.last_event_timestamp_ms,
               ui.has_transaction, ui.has_addtocart, i.category_id, i.parent_category_id, i.is_available,
               i.has_category_metadata, i.has_availability_metadata,
               case when ui.view_count > 0 then ui.addtocart_count::double / ui.view_count else 0.0 end as user_item_addtocart_rate,
               case when ui.view_count > 0 then ui.transaction_count::double / ui.view_count else 0.0 end as user_item_transaction_rate,
               case when ui.addtocart_count > 0 then ui.transaction_count::double / ui.addtocart_count else 0.0 end as user_item_cart_to_transaction_rate,
               cast(case when ui.has_transaction = 1 then 5.0 when ui.has_addtocart = 1 then 3.0 else 1.0 end as double) as implicit_label,
               case when ui.has_transaction = 1 then 'transaction' when ui.has_addtocart = 1 then 'addtocart' else 'view' end as strongest_event_type
        from user_items_{s} ui left join item_features_{s} i on ui.item_id = i.item_id""",
    "bounds": """
        select min(event_timestamp_ms) as min_timestamp_ms, max(event_timestamp_ms) as max_timestamp_ms,
               max(event_timestamp_ms) - cast({days} as bigint) * 86400000 as cutoff_timestamp_ms from staged_{s}""",
    # popularity: train strictly before the cutoff
    "pop_scores": """
        select a.*, f.category_id, f.parent_category_id, f.is_available, f.has_category_metadata, f.has_availability_metadata,
               case when train_view_events > 0 then train_addtocart_events::double / train_view_events else 0.0 end as addtocart_rate,
               case when train_view_events > 0 then train_transaction_events::double / train_view_events else 0.0 end as transaction_rate,
               round(0.40::double * ln(1 + train_interaction_score) + 0.25::double * ln(1 + train_unique_users::double)
                     + 0.20::double * ln(1 + train_transaction_events::double) + 0.10::double * ln(1 + train_addtocart_events::double)
                     + 0.05::double * coalesce(f.is_available, 0), 9) as popularity_score
        from (select item_id, count(*) as train_event_count, count(distinct user_id) as train_unique_users,
                     count(*) filter (where event_type = 'view') as train_view_events,
                     count(*) filter (where event_type = 'addtocart') as train_addtocart_events,
                     count(*) filter (where event_type = 'transaction') as train_transaction_events,
                     sum(interaction_weight) as train_interaction_score
              from interactions_{s}, bounds_{s} where event_timestamp_ms < cutoff_timestamp_ms group by item_id) a
        left join item_features_{s} f on a.item_id = f.item_id""",
    "pop_ranked": """
        select *, row_number() over (order by popularity_score desc, train_interaction_score desc,
                                              train_unique_users desc, item_id) as rank from pop_scores_{s}""",
    "pop_targets": """
        select user_id, item_id as target_item_id, target_weight, last_target_ms from (
          select *, row_number() over (partition by user_id order by target_weight desc, last_target_ms desc, item_id) as rn
          from (select user_id, item_id, max(interaction_weight) as target_weight, max(event_timestamp_ms) as last_target_ms
                from interactions_{s}, bounds_{s}
                where event_timestamp_ms >= cutoff_timestamp_ms and event_type in ('addtocart', 'transaction')
                group by user_id, item_id)) where rn = 1""",
    "pop_seen": """
        select distinct user_id, item_id from interactions_{s}, bounds_{s} where event_timestamp_ms < cutoff_timestamp_ms""",
    "pop_lists": """
        select user_id, target_item_id, item_id, row_number() over (partition by user_id order by rank) as position
        from pop_targets_{s} t cross join pop_ranked_{s} r
        where not exists (select 1 from pop_seen_{s} x where x.user_id = t.user_id and x.item_id = r.item_id)""",
    "pop_metrics": """
        select count(distinct user_id) as evaluated_users,
               count(*) filter (where item_id = target_item_id) as hits,
               coalesce(sum(1.0::double / log2(position + 1)) filter (where item_id = target_item_id), 0.0) as gain
        from pop_lists_{s} where position <= 10""",
    # content: train up to and including the cutoff, unknown types weigh 1
    "weighted": """
        select *, cast(case event_type when 'transaction' then 5.0 when 'addtocart' then 3.0 else 1.0 end as double) as content_weight
        from interactions_{s}""",
    "candidates_all": """
        select a.item_id, train_event_count, train_unique_users, train_view_events, train_addtocart_events,
               train_transaction_events, train_interaction_score, coalesce(f.category_id, -1) as category_id,
               coalesce(f.parent_category_id, -1) as parent_category_id, coalesce(f.is_available, 0) as is_available,
               coalesce(f.has_category_metadata, 0) as has_category_metadata,
               coalesce(f.has_availability_metadata, 0) as has_availability_metadata, addtocart_rate, transaction_rate,
               round(ln(1 + train_interaction_score) + 0.50::double * addtocart_rate + 1.00::double * transaction_rate
                     + 0.10::double * coalesce(f.is_available, 0), 9) as global_content_prior_score
        from (select *, train_addtocart_events::double / train_event_count as addtocart_rate,
                     train_transaction_events::double / train_event_count as transaction_rate
              from (select item_id, count(*) as train_event_count, count(distinct user_id) as train_unique_users,
                           count(*) filter (where event_type = 'view') as train_view_events,
                           count(*) filter (where event_type = 'addtocart') as train_addtocart_events,
                           count(*) filter (where event_type = 'transaction') as train_transaction_events,
                           sum(content_weight) as train_interaction_score
                    from weighted_{s}, bounds_{s} where event_timestamp_ms <= cutoff_timestamp_ms group by item_id)) a
        left join mart_items_{s} f on a.item_id = f.item_id""",
    "candidates": "select * from candidates_all_{s}",
    "head_candidates": """
        select item_id from candidates_all_{s}
        order by global_content_prior_score desc, train_event_count desc, item_id limit 100""",
    # user samples: in scattered order for popularity, in id order for content
    "pop_sample": """
        select * from pop_targets_{s}
        order by (user_id % 1000003 + 1000003) % 1000003 * 2654435761 % 4294967296, user_id limit 25""",
    "content_sample": "select * from content_targets_{s} order by user_id limit 25",
    "content_targets": """
        select user_id, item_id as target_item_id, target_weight, first_target_ms from (
          select *, row_number() over (partition by user_id order by target_weight desc, first_target_ms, item_id) as rn
          from (select user_id, item_id, max(content_weight) as target_weight, min(event_timestamp_ms) as first_target_ms
                from weighted_{s}, bounds_{s}
                where event_timestamp_ms > cutoff_timestamp_ms and event_type in ('addtocart', 'transaction')
                group by user_id, item_id)) where rn = 1""",
    "train_history": """
        select user_id, item_id, content_weight from weighted_{s}, bounds_{s} where event_timestamp_ms <= cutoff_timestamp_ms""",
    "full_history": "select user_id, item_id, content_weight from weighted_{s}",
    "scored_candidates": """
        select *, 0.10::double * is_available + 0.05::double * has_category_metadata + 0.05::double * has_availability_metadata as metadata_score,
               0.50::double * addtocart_rate + 1.00::double * transaction_rate as conversion_score,
               0.05::double * ln(1 + train_interaction_score) as popularity_prior
        from candidates_{s}""",
}

# A profile and the scored pairs over either history.
_PER_HISTORY = {
    "{h}_profile": """
        select user_id, coalesce(f.category_id, -1) as category_id, coalesce(f.parent_category_id, -1) as parent_category_id,
               sum(content_weight) as weight
        from {h}_history_{s} i left join mart_items_{s} f on i.item_id = f.item_id
        group by user_id, coalesce(f.category_id, -1), coalesce(f.parent_category_id, -1)""",
    "{h}_categories": """
        select user_id, category_id, sum(weight) as weight,
               sum(weight) / sum(sum(weight)) over (partition by user_id) as share from {h}_profile_{s} group by user_id, category_id""",
    "{h}_parents": """
        select user_id, parent_category_id, sum(weight) as weight,
               sum(weight) / sum(sum(weight)) over (partition by user_id) as share from {h}_profile_{s} group by user_id, parent_category_id""",
    "{h}_scored": """
        select u.user_id, c.*, coalesce(p.share, 0.0) as category_score, coalesce(q.share, 0.0) as parent_category_score,
               round(2.00::double * coalesce(p.share, 0.0) + 1.00::double * coalesce(q.share, 0.0)
                     + round(metadata_score + conversion_score + popularity_prior, 9), 9) as content_score
        from {h}_users_{s} u cross join scored_candidates_{s} c
        left join {h}_categories_{s} p on p.user_id = u.user_id and p.category_id = c.category_id
        left join {h}_parents_{s} q on q.user_id = u.user_id and q.parent_category_id = c.parent_category_id
        where not exists (select 1 from {h}_history_{s} x where x.user_id = u.user_id and x.item_id = c.item_id)""",
}


def _fill() -> None:
    for source, days in (("clicks", 7), ("orders", 180)):
        values = {"s": source, "days": str(days)}

        def put(name: str, body: str, **extra: str) -> None:
            for key, value in {**values, **extra}.items():
                name, body = name.replace("{" + key + "}", value), body.replace("{" + key + "}", value)
            VIEWS[f"{name}_{source}"] = body

        for name, body in _PER_SOURCE.items():
            put(name, body)
        put("train_users", "select user_id from content_targets_{s}")
        put("full_users", "select distinct user_id from interactions_{s}")
        for history in ("train", "full"):
            for name, body in _PER_HISTORY.items():
                put(name, body, h=history)
        put(
            "train_lists",
            """
            select *, row_number() over (partition by user_id order by content_score desc, train_interaction_score desc,
                   train_event_count desc, global_content_prior_score desc, item_id) as recommendation_rank from train_scored_{s}""",
        )
        put(
            "full_lists",
            """
            select *, row_number() over (partition by user_id order by content_score desc, train_event_count desc,
                   item_id desc) as recommendation_rank from full_scored_{s}""",
        )
        put(
            "content_metrics",
            """
            select count(distinct l.user_id) as evaluated_users, count(*) filter (where item_id = target_item_id) as hits,
                   coalesce(sum(1.0::double / log2(recommendation_rank + 1)) filter (where item_id = target_item_id), 0.0) as gain
            from train_lists_{s} l join content_targets_{s} t on l.user_id = t.user_id where recommendation_rank <= 10""",
        )


_fill()

_WORD = re.compile(r"[a-z_]+")


def _needed(sql: str, found: list[str]) -> None:
    for word in dict.fromkeys(_WORD.findall(sql)):
        if word in VIEWS and word not in found:
            _needed(VIEWS[word], found)
            found.append(word)


def statement(body: str) -> str:
    """``body`` with the views it uses, directly or not, as CTEs before it."""
    found: list[str] = []
    _needed(body, found)
    if not found:
        return body
    return "with " + ",\n".join(f"{name} as ({VIEWS[name]})" for name in found) + "\n" + body
