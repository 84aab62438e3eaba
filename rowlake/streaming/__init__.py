"""Continuous ingestion with Structured Streaming."""
