"""Masters over time: daily snapshots as validity intervals, and lookups as of a day.

A version of a key holds from its first snapshot day, ``valid_from``, until, and
without, the first later snapshot day that has other values or lacks the key,
``valid_until``; that is null for what the last snapshot has. Days without a
snapshot belong to the snapshot before. Both columns are dates.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablespoon.operators.dedup import latest_by

VALID = ("valid_from", "valid_until")


def _calendar(rows: DataFrame) -> DataFrame:
    """``day, number, next``: the snapshot days in order, a row per day of the table."""
    by_day = Window.orderBy("day")
    days = rows.select("day").distinct()
    return days.select("day", F.row_number().over(by_day).alias("number"), F.lead("day").over(by_day).alias("next"))


def _folded(rows: DataFrame, days: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Islands of rows ``keys, values, day, since``, one per key and day: neighbours
    among the snapshot days, those of ``days``, whose values are the same."""
    numbered = rows.join(F.broadcast(_calendar(days)), "day")  # a row per day; dealing the rows by day would put few tasks to work
    by_key = Window.partitionBy(*keys).orderBy("number")
    state = F.struct(*values)
    goes_on = (F.lag("number").over(by_key) == F.col("number") - 1) & F.lag(state).over(by_key).eqNullSafe(state)
    starts = F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)
    islands = numbered.withColumn("_starts", starts).withColumn("_island", F.sum("_starts").over(by_key))
    last = F.max(F.struct("number", "next")).getField("next")
    return islands.groupBy(*keys, "_island", *values).agg(F.min("since").alias("valid_from"), last.alias("valid_until")).drop("_island")


def _dated(df: DataFrame, day: str) -> DataFrame:
    """Rows with their snapshot ``day``. Rows without a day are of no snapshot."""
    return df.withColumn("day", F.to_date(day)).filter("day IS NOT NULL")


def _snapshots(dated: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """One row per key and day: the one that was loaded last.

    Rows are dealt by key before they are ranked. Else each task ranks what it has
    read first, and one that reads a small file may have very many rows of it.
    """
    latest = latest_by(dated.repartition(*keys), [*keys, "day"], [], by_copy=True)
    return latest.select(*keys, *values, "day", F.col("day").alias("since"))


def master_history(df: DataFrame, keys: list[str], values: list[str], day: str = "report_date") -> DataFrame:
    """Snapshots of a master, appended day by day, as ``keys, values, valid_from, valid_until``.

    Values are the same if they are equal or both null. A key that is missing on a
    snapshot day and comes back has a version for either time. One shuffle deals
    the rows by key; a key has no more rows than there are days.
    """
    dated = _dated(df, day)
    return _folded(_snapshots(dated, keys, values), dated, keys, values)


def extend_history(history: DataFrame, df: DataFrame, keys: list[str], values: list[str], last: dt.date, day: str = "report_date") -> DataFrame:
    """The history up to the snapshot day ``last``, with the later snapshots of ``df``.

    Only versions that are valid still, and the new snapshots, are folded; closed
    ones are passed on. Snapshots up to ``last`` are left out, so a repeated run
    changes nothing.
    """
    dated = _dated(df.filter(F.to_date(day) > F.lit(last)), day)
    later = _snapshots(dated, keys, values)
    current = history.filter("valid_until IS NULL")
    carried = current.select(*keys, *values, F.lit(last).alias("day"), F.col("valid_from").alias("since"))
    closed = history.filter("valid_until IS NOT NULL")
    # the calendar needs the last day also where nothing was valid on it
    days = carried.select("day").unionByName(dated.select("day"))
    folded = _folded(carried.unionByName(later), days, keys, values)
    return closed.select(*folded.columns).unionByName(folded)


def expand_history(history: DataFrame, days: DataFrame) -> DataFrame:
    """The snapshots that a history stands for, on ``days(day)``: the way back. For few days."""
    inside = (F.col("day") >= F.col("valid_from")) & F.coalesce(F.col("day") < F.col("valid_until"), F.lit(True))
    listed = [r["day"] for r in days.select("day").distinct().collect()]
    each = F.explode(F.array(*[F.lit(d) for d in listed]) if listed else F.array().cast("array<date>"))
    return history.withColumn("day", each).filter(inside).drop(*VALID)


def asof_join(facts: DataFrame, history: DataFrame, on: dict[str, str], at: str, bucket_days: int = 64) -> DataFrame:
    """Facts with the version that held on the day of ``at``; nulls where none did.

    ``on`` maps columns of the facts to the history's keys, which are not repeated in
    the result, nor are the validity columns. An interval join needs equal keys to be
    hashed by; for keys with many versions these are the key and a bucket of
    days: a fact is in one bucket, a version in all that it reaches into, up to the
    last day of the facts. So a fact meets the versions of its bucket, not all of its key.

    The join is by sorting, which is asked for: the planner takes a history for as small as
    the table it was made of, since it doesn't know how many rows come out of an array, and
    would send all of it through the driver.
    """
    number = lambda day: F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / bucket_days)
    keyed = facts.withColumn("_day", F.to_date(at)).withColumn("_bucket", number(F.col("_day")))
    last_day = keyed.agg(F.max("_day")).scalar()
    end = F.least(F.date_sub("valid_until", 1), last_day)  # least passes over nulls
    reach = F.when(F.col("valid_from") <= end, F.sequence(number(F.col("valid_from")), number(end)))
    renamed = {key: f"_key_{i}" for i, key in enumerate(on.values())}
    versions = history.withColumnsRenamed(renamed).withColumn("_reach", F.explode(reach)).hint("merge")
    matches = (
        (F.col("_bucket") == F.col("_reach"))
        & (F.col("_day") >= F.col("valid_from"))
        & F.coalesce(F.col("_day") < F.col("valid_until"), F.lit(True))
    )
    for fact, key in on.items():
        matches = matches & (keyed[fact] == F.col(renamed[key]))
    return keyed.join(versions, matches, "left").drop("_day", "_bucket", "_reach", *VALID, *renamed.values())
