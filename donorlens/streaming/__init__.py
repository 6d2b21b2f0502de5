"""Structured Streaming incremental ingest."""
