"""Incremental ingestion of the delta feed and continuously kept latest state."""
