"""Structured Streaming ingest and rollups."""
