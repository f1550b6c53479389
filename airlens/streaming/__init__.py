"""Structured Streaming: sinks, deduplication, and the ingest and live query sets."""
