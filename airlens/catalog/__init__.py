"""Named queries over the star-schema tables, each with the SQL that checks it where SQL can."""

from airlens.catalog import cleaning, dashboard, documents, graph, ingest, live, rows  # noqa: F401
from airlens.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
