"""Batch plans: fan-out to tables, bulk ingestion, backlog."""
