"""Staging models over bronze tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablespoon.functions import hash_pii
from tablespoon.operators.dedup import copy_rank, latest_by
from tablespoon.sources.bronze import register_views


def stg_order_header(df: DataFrame) -> DataFrame:
    """Latest copy of each order; the rank column stays, always 1."""
    return latest_by(df, ["order_id"], ["order_date"], keep_rank=True)


def stg_order_detail(df: DataFrame) -> DataFrame:
    """Latest copy of each order line; the rank column stays, always 1."""
    return latest_by(df, ["order_detail_id"], ["order_date"], keep_rank=True)


def stg_passthrough(df: DataFrame) -> DataFrame:
    """Invoice tables are staged as they are, copies included."""
    return df


def latest_invoice(df: DataFrame) -> DataFrame:
    """Latest copy of each invoice: the one that landed last, whatever its date, so
    that a correction may date an invoice back. Copies that do not say when they
    landed go by their date."""
    return latest_by(df, ["ref_id"], ["ref_date"], by_copy=True)


def invoice_rank(df: DataFrame) -> Column:
    """The copies of an invoice as values of which the largest is its :func:`latest_invoice`."""
    return copy_rank(df, ["ref_id"], ["ref_date"], by_copy=True)


def latest_invoice_detail(df: DataFrame, bucketed: bool = False) -> DataFrame:
    """Latest copy of each invoice line. A line belongs to its invoice, so
    conditions on the invoice still reach the scan.

    Lines are dealt out before they are ranked, unless they are stored ``bucketed``.
    Else each task sorts all it has read first, and that spills where a small file
    has very many lines. All copies of one line meet in a task.
    """
    keys = ["ref_id", "ref_detail_id"]
    return latest_by(df if bucketed else df.repartition(*keys), keys, ["ref_date"], by_copy=True)


def latest_master(df: DataFrame, key: str) -> DataFrame:
    """Newest snapshot row of each customer or product."""
    return latest_by(df, [key], ["report_date"])


def stg_customer(df: DataFrame) -> DataFrame:
    """Customers with name and phone hashed."""
    return df.select(
        "customer_id",
        "customer_code",
        hash_pii(F.col("customer_name")).alias("customer_name_hashed"),
        hash_pii(F.col("customer_tel")).alias("customer_tel_hashed"),
        "address",
        "report_date",
    )


def stg_product(df: DataFrame, fix_active: bool = False) -> DataFrame:
    """Products. ``is_active`` carries ``inactive`` unchanged, as consumers of the
    model expect; ``fix_active`` negates it."""
    active = ~F.col("inactive") if fix_active else F.col("inactive")
    return df.select(
        "product_id",
        "product_code",
        "product_name",
        "unit_name",
        "price",
        "category_name",
        active.alias("is_active"),
        "report_date",
    )


MODELS = {
    "order_header": stg_order_header,
    "order_detail": stg_order_detail,
    "invoice_header": stg_passthrough,
    "invoice_detail": stg_passthrough,
    "invoice_payment": stg_passthrough,
    "customer": stg_customer,
    "product": stg_product,
}


def staging(bronze: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All staging models, also published as views named ``stg_<table>``."""
    models = {f"stg_{name}": MODELS[name](df) for name, df in bronze.items()}
    register_views(models)
    return models
