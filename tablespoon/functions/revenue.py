"""Line revenue."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def net_revenue(amount: Column, allocation: Column, delivery_promotion: Column) -> Column:
    """Amount less allocated discounts. A null amount stays null."""
    return amount - F.coalesce(allocation, F.lit(0.0)) - F.coalesce(delivery_promotion, F.lit(0.0))


def revenue_inclusive(net: Column, tax: Column) -> Column:
    """Net revenue with tax."""
    return net + F.coalesce(tax, F.lit(0.0))
