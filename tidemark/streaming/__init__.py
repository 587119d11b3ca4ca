"""Incremental ingest, rollup and scoring with Structured Streaming."""
