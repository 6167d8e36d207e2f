"""Result headers and detail payloads to documents ready to land.

Headers come as rows out of result pages, payloads as one JSON text per header.
Fetching them is left to whoever calls the service.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablespoon.operators.extract import INVOICE_DATE_FIELDS, ORDER_DATE_FIELDS, branch_scope, cutoff_filter
from tablespoon.operators.nested import normalize_payload, parse_invoice_payload
from tablespoon.schemas import ORDERS, SPECS


def first_branch(branch_map: Mapping[str, str] | None) -> str:
    """The branch orders are asked for: the first of the map, if any."""
    return next(iter(branch_map or {}), "")


def extract_orders(
    headers: DataFrame,
    payloads: DataFrame,
    end: dt.datetime | None = None,
    branch_id: str | None = None,
    branch_map: Mapping[str, str] | None = None,
) -> DataFrame:
    """Orders of one branch dated before ``end``, with their lines. Without a
    ``branch_id`` the first branch of the map is meant, and without a map all.
    ``payloads`` has ``Id`` and the payload text ``Data``, one row per order; an
    order without one has no lines. Lines carry the fields they take over from
    the order."""
    branch_id = first_branch(branch_map) if branch_id is None else branch_id
    kept = cutoff_filter(branch_scope(headers, branch_id), ORDER_DATE_FIELDS, end)
    joined = kept.join(payloads.select("Id", "Data"), "Id", "left")
    taken = {c: (F.col(h) if h in headers.columns else F.lit(None)).cast("string") for c, h in ORDERS.parents.items()}
    names = SPECS["order_detail"].landing.names
    line = lambda item: F.struct(*[taken.get(n, item.getField(n)).alias(n) for n in names])
    lines = F.transform(normalize_payload(F.col("Data")), line)
    return joined.withColumn("line_items", lines).drop("Data")


def extract_invoices(headers: DataFrame, payloads: DataFrame, end: dt.datetime | None = None) -> DataFrame:
    """Invoices of all branches dated before ``end``, with their lines and payments.
    ``payloads`` has ``RefId`` and the payload text ``Data``, one row per invoice."""
    kept = cutoff_filter(headers, INVOICE_DATE_FIELDS, end)
    joined = kept.join(payloads.select("RefId", "Data"), "RefId", "left")
    return joined.withColumns(parse_invoice_payload(F.col("Data"))).drop("Data")
