"""Incremental builds: lookback, high-water mark, upsert, and missing days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _part_number(columns: tuple[str, ...]) -> Column:
    year, month, day = columns
    return F.col(year) * 10000 + F.col(month) * 100 + F.col(day)


def lookback(
    df: DataFrame, as_of: dt.date, days: int = 3, column: str = "ref_date", partitions: tuple[str, ...] = ()
) -> DataFrame:
    """Rows dated at or after ``days`` days before ``as_of``, a local day.

    Callers who know that ``partitions`` (year, month, day) hold the local day of
    ``column`` name them; the condition is then put on them too, and files of
    older folders are not read.
    """
    first = as_of - dt.timedelta(days=days)
    recent = df.filter(F.col(column) >= F.lit(first).cast("timestamp_ntz"))
    if partitions:
        recent = recent.filter(_part_number(partitions) >= first.year * 10000 + first.month * 100 + first.day)
    return recent


def high_water(target: DataFrame, column: str = "report_date") -> Column:
    """Largest value in the target as a scalar subquery; null when it is empty."""
    return target.agg(F.max(column)).scalar()


def since_high_water(df: DataFrame, target: DataFrame, column: str = "report_date") -> DataFrame:
    """Rows at or after the target's high-water mark; none when the target is empty."""
    return df.filter(F.col(column) >= high_water(target, column))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def upsert(target: DataFrame, source: DataFrame, keys: list[str], mode: str = "unique") -> DataFrame:
    """The target with source rows put in by key: matched rows replaced, new ones
    added, others kept. A null key matches nothing.

    ``mode="unique"`` fails when it runs if the source holds a key twice; the merge
    would be ambiguous. ``mode="replace"`` lets the source bring several rows per
    key, which together replace all target rows of that key.
    """
    if mode == "unique":
        times = F.count(F.lit(1)).over(Window.partitionBy(*keys))
        refusal = F.raise_error(F.lit(f"source rows are not unique on {keys}")).cast("boolean")
        source = source.withColumn("_times", times).filter(F.when(F.col("_times") > 1, refusal).otherwise(True)).drop("_times")
    elif mode != "replace":
        raise ValueError(f"unknown mode {mode!r}")
    matched = source.select(*keys) if mode == "unique" else source.select(*keys).distinct()
    return target.join(matched, keys, "left_anti").unionByName(source.select(target.columns))


def gap_days(df: DataFrame, column: str, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Calendar days without any row, between ``start`` and ``end`` or the first
    and last day present. Rows are reduced to distinct days before anything else."""
    present = df.select(F.to_date(column).alias("gap_day")).filter("gap_day is not null").distinct()
    first = F.lit(start) if start else F.min("gap_day")
    last = F.lit(end) if end else F.max("gap_day")
    days = df.sparkSession.range(1).select if start and end else present.agg
    bounds = days(first.alias("first"), last.alias("last")).filter("first <= last")
    calendar = bounds.select(F.explode(F.sequence("first", "last")).alias("gap_day"))
    return calendar.join(present, "gap_day", "left_anti")


def gap_stretches(df: DataFrame, column: str, by: list[str], bounds: DataFrame) -> DataFrame:
    """Stretches of days without a row, per group: ``by, first_day, last_day, n_days``.

    ``bounds(by, opened, closed)`` says from which day to which a group should have
    rows; groups that it lacks are not looked at, a group without any row is one
    stretch, and rows outside of the bounds don't count. Days present are reduced
    to distinct ones first, and neighbours compared: no calendar is built.
    """
    day = F.to_date(column).alias("_day")
    present = df.select(*by, day).filter("_day IS NOT NULL").distinct()
    inside = present.join(bounds.select(*by, "opened", "closed"), by).filter("_day BETWEEN opened AND closed").select(*by, "_day")
    # the days before the first and after the last stand for present ones
    edge = lambda c: bounds.filter("opened <= closed").select(*by, c.alias("_day"))
    edges = edge(F.date_sub("opened", 1)).unionByName(edge(F.date_add("closed", 1)))
    earlier = F.lag("_day").over(Window.partitionBy(*by).orderBy("_day"))
    gaps = inside.unionByName(edges).withColumn("_earlier", earlier).filter(F.datediff("_day", "_earlier") > 1)
    return gaps.select(
        *by,
        F.date_add("_earlier", 1).alias("first_day"),
        F.date_sub("_day", 1).alias("last_day"),
        (F.datediff("_day", "_earlier") - 1).cast("long").alias("n_days"),
    )
