"""Explicit schemas of the inputs and column contracts of the datasets."""

from pyspark.sql import types as T

# --- fixed values: columns of the source files and of API records --------
EVENTS_CSV = T.StructType([
    T.StructField("timestamp", T.LongType()),
    T.StructField("visitorid", T.LongType()),
    T.StructField("event", T.StringType()),
    T.StructField("itemid", T.LongType()),
    T.StructField("transactionid", T.StringType()),
])

ITEM_PROPERTIES_CSV = T.StructType([
    T.StructField("timestamp", T.LongType()),
    T.StructField("itemid", T.LongType()),
    T.StructField("property", T.StringType()),
    T.StructField("value", T.StringType()),
])

CATEGORY_TREE_CSV = T.StructType([
    T.StructField("categoryid", T.LongType()),
    T.StructField("parentid", T.StringType()),
])

# A landed delta record; the directory adds nothing, both stamps are columns.
DELTA_RECORD = T.StructType([
    *ITEM_PROPERTIES_CSV.fields,
    T.StructField("source_system", T.StringType()),
    T.StructField("ingestion_timestamp", T.StringType()),
])

# One raw API response. Two contracts share the schema: {data, success, count,
# total_rows, unread_rows} and {records, next_cursor, has_more}. Record fields
# are read as text and cast later, so a badly typed record stays visible.
PAYLOAD_RECORD = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("itemid", T.StringType()),
    T.StructField("property", T.StringType()),
    T.StructField("value", T.StringType()),
])
PAYLOAD = T.StructType([
    T.StructField("data", T.ArrayType(PAYLOAD_RECORD)),
    T.StructField("records", T.ArrayType(PAYLOAD_RECORD)),
    T.StructField("success", T.BooleanType()),
    T.StructField("count", T.LongType()),
    T.StructField("total_rows", T.LongType()),
    T.StructField("unread_rows", T.LongType()),
    T.StructField("next_cursor", T.StringType()),
    T.StructField("has_more", T.BooleanType()),
])

# One row per landed partition; the JSON sidecar has the same fields.
MANIFEST = T.StructType([
    T.StructField("source_system", T.StringType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("ingestion_timestamp", T.StringType()),
    T.StructField("format", T.StringType()),
    T.StructField("landing_path", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("fingerprint", T.StringType()),
    T.StructField("checksum_sha256", T.StringType()),
    T.StructField("file_count", T.LongType()),
    T.StructField("file_bytes", T.LongType()),
    T.StructField("api_contract", T.StringType()),
    T.StructField("api_count", T.LongType()),
    T.StructField("total_rows", T.LongType()),
    T.StructField("unread_rows", T.LongType()),
    T.StructField("api_success", T.BooleanType()),
    T.StructField("cursor", T.StringType()),
    T.StructField("ingested_at", T.TimestampType()),
])

QUALITY_ROW = T.StructType([
    T.StructField("dataset_name", T.StringType()),
    T.StructField("check_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("details", T.StringType()),
])

# --- fixed values: columns each dataset must have -------------------------
REQUIRED_COLUMNS = {
    "events": (
        "event_timestamp_ms", "event_datetime", "visitor_id", "event_type",
        "item_id", "transaction_id", "_source_system", "_source_file",
    ),
    "category_tree": (
        "category_id", "parent_category_id", "is_root_category",
        "_source_system", "_source_file",
    ),
    "item_properties_batch": (
        "property_timestamp_ms", "property_datetime", "item_id", "property_name",
        "property_value", "source_feed", "source_system", "source_file",
    ),
    "item_properties_api_delta": (
        "property_timestamp_ms", "property_datetime", "item_id", "property_name",
        "property_value", "source_feed", "source_system", "source_file",
        "ingestion_timestamp",
    ),
    "item_properties_combined": (
        "property_timestamp_ms", "property_datetime", "item_id", "property_name",
        "property_value", "source_feed", "source_system", "source_file",
        "ingestion_timestamp",
    ),
    "item_category_latest": (
        "item_id", "category_id", "category_timestamp_ms", "category_datetime",
        "_source_system", "_source_file",
    ),
    "item_availability_latest": (
        "item_id", "available_raw_value", "is_available",
        "availability_timestamp_ms", "availability_datetime",
        "_source_system", "_source_file",
    ),
    "curated_interactions": (
        "user_id", "item_id", "event_type", "event_timestamp_ms",
        "interaction_weight", "category_id", "is_available",
    ),
    "curated_items": (
        "item_id", "total_events", "unique_users", "category_id", "is_available",
        "has_category_metadata", "has_availability_metadata",
    ),
    "curated_user_item_interactions": (
        "user_id", "item_id", "total_events", "view_count", "addtocart_count",
        "transaction_count", "interaction_score", "has_transaction",
        "has_addtocart",
    ),
}

# --- fixed values: columns of the recommendation output of both models ---
RECOMMENDATION_COLUMNS = (
    ("model_key", "string"), ("model_name", "string"), ("model_type", "string"),
    ("user_id", "bigint"), ("recommendation_rank", "int"), ("item_id", "bigint"),
    ("recommendation_score", "double"), ("popularity_score", "double"),
    ("content_score", "double"), ("category_score", "double"),
    ("parent_category_score", "double"), ("metadata_score", "double"),
    ("conversion_score", "double"), ("popularity_prior", "double"),
    ("train_event_count", "bigint"), ("train_unique_users", "bigint"),
    ("train_view_events", "bigint"), ("train_addtocart_events", "bigint"),
    ("train_transaction_events", "bigint"), ("category_id", "bigint"),
    ("parent_category_id", "bigint"), ("is_available", "int"),
    ("has_category_metadata", "int"), ("has_availability_metadata", "int"),
    ("was_seen_before", "boolean"),
)
