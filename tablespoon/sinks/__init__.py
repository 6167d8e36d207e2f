"""Writers for bronze tables and marts."""

from tablespoon.sinks.bucketed import read_bucketed, save_bucketed
from tablespoon.sinks.loads import discard_load, load_id, open_loads, save_load, whole
from tablespoon.sinks.tables import (
    full_refresh,
    land,
    land_lines,
    merge_table,
    replace_partitions,
    save_all,
    save_flat,
    save_partitions,
    save_table,
)
from tablespoon.sinks.versions import Conflict, read_version

__all__ = [
    "Conflict",
    "discard_load",
    "full_refresh",
    "land",
    "land_lines",
    "load_id",
    "merge_table",
    "open_loads",
    "read_bucketed",
    "read_version",
    "replace_partitions",
    "save_all",
    "save_bucketed",
    "save_flat",
    "save_load",
    "save_partitions",
    "save_table",
    "whole",
]
