"""Batch writers."""

from airlens.sinks.tables import known_links, read_graph, read_target, upsert_by_key, write_graph, write_validated

__all__ = ["known_links", "read_graph", "read_target", "upsert_by_key", "write_graph", "write_validated"]
