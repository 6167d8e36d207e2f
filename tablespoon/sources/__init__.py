"""Readers: landed JSON documents and stored tables."""

from tablespoon.sources.bronze import read_table, register_views, source
from tablespoon.sources.landing import existing, read_days, read_document, read_master, read_transactions

__all__ = [
    "existing",
    "read_days",
    "read_document",
    "read_master",
    "read_table",
    "read_transactions",
    "register_views",
    "source",
]
