"""Incremental raw-file ingestion with Structured Streaming."""
