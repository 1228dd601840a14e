"""Incremental ingest: new CSV files in a folder are checked, routed and
appended as they land (Structured Streaming file source + foreachBatch)."""
