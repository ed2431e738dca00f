"""Incremental file-drop ingest with Structured Streaming."""
