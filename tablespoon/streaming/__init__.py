"""Streaming ingest of landed documents."""

from tablespoon.streaming.ingest import stream_ingest

__all__ = ["stream_ingest"]
