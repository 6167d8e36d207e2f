"""Business day and hour of a sale."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablespoon.functions.casts import LOCAL_ZONE, to_local_ts


def business_date(column: str, source: T.DataType = T.StringType(), zone: str = LOCAL_ZONE) -> Column:
    """Local calendar day as ``yyyy-MM-dd`` text; unreadable becomes null."""
    return F.to_date(to_local_ts(column, source, zone)).cast("string")


def hour_bucket(col: Column) -> Column:
    """Two-digit 24 h hour as text."""
    return F.lpad(F.hour(col).cast("string"), 2, "0")
