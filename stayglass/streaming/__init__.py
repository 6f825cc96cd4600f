"""Structured Streaming: incremental ingest and daily volumes."""
