"""Incremental ingestion of the raw layer with Structured Streaming."""

from tidylake.streaming.ingest import ingest_to_silver, read_layouts_stream
from tidylake.streaming.keyed import first_of_key, ingest_keyed

__all__ = ["first_of_key", "ingest_keyed", "ingest_to_silver", "read_layouts_stream"]
