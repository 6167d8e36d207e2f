"""One row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablespoon.schemas import INGEST_COLUMN


def copy_order() -> list[Column]:
    """What says which of two landed copies is the newer one: the day they landed
    under, then the load. A day's file that is loaded again later is no news."""
    parts = F.split(INGEST_COLUMN, "-")
    day = F.when(F.size(parts) == 3, parts[1]).otherwise(F.lit(""))
    return [day, parts[0]]


def _ranks(df: DataFrame, keys: list[str], order: list[str], by_copy: bool) -> list[Column]:
    """What copies of a key are compared by, one after another; nulls are the least."""
    ties = [c for c in (INGEST_COLUMN,) if c in df.columns and c not in order]
    rest = ties + [c for c in df.columns if c not in (*keys, *order, *ties)]
    newest = copy_order() if by_copy and ties else []
    return [*newest, *[F.col(c) for c in [*order, *rest]]]


def copy_rank(df: DataFrame, keys: list[str], order: list[str], by_copy: bool = False) -> Column:
    """All columns but the keys as one value, whose largest is the row that :func:`latest_by`
    picks. Its maximum is taken in each input partition before the shuffle, too."""
    return F.struct(*_ranks(df, keys, order, by_copy))


def latest_by(df: DataFrame, keys: list[str], order: list[str], keep_rank: bool = False, by_copy: bool = False) -> DataFrame:
    """The latest row per key, by ``order`` descending with nulls last.

    With ``by_copy`` the landed copy, where rows are marked with it, goes before
    ``order``. Copies that tie are told apart by their mark and then by the
    remaining columns, so the survivor is the same on every run. The rank filter is
    pushed in front of the shuffle as well (a group limit), so a key with very many
    copies leaves at most one row per input partition to be shuffled.
    """
    ranked = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in _ranks(df, keys, order, by_copy)])
    latest = df.withColumn("row_num", F.row_number().over(ranked)).filter("row_num = 1")
    return latest if keep_rank else latest.drop("row_num")
