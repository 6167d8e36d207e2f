"""Which landed documents belong to a batch."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablespoon.functions import utc_ts

# Date fields that decide on orders and on invoices, in order of
# preference, and the branch id that stands for all branches.
ORDER_DATE_FIELDS = ("Date",)
INVOICE_DATE_FIELDS = ("RefDate", "CreatedDate")
ALL_BRANCHES = "00000000-0000-0000-0000-000000000000"


def cutoff_filter(df: DataFrame, date_fields: tuple[str, ...], end: dt.datetime | None) -> DataFrame:
    """Keeps documents dated strictly before ``end`` (naive means UTC). The first
    field that is neither null nor empty counts. There is no lower bound, and a
    document without a readable date is kept."""
    if end is None:
        return df
    bound = end.astimezone(dt.timezone.utc).replace(tzinfo=None) if end.tzinfo else end
    filled = ", ".join(f"nullif(`{f}`, '')" for f in date_fields)
    when = utc_ts(f"coalesce({filled})")
    return df.filter(when.isNull() | (when < F.lit(bound.isoformat(sep=" ")).cast("timestamp_ntz")))


def branch_scope(df: DataFrame, branch_id: str | None) -> DataFrame:
    """Documents of one branch; no id, or the all-branches id, keeps everything."""
    if not branch_id or branch_id == ALL_BRANCHES:
        return df
    return df.filter(F.col("BranchId") == branch_id)


def accepted_pages(pages: DataFrame) -> DataFrame:
    """Rows out of landed result pages ``{Success, Data: [...]}``; pages that did
    not succeed, or hold nothing, add nothing."""
    return pages.filter("Success").select(F.inline("Data"))
