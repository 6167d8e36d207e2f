"""Parquet tables, written by path.

Before a partitioned write rows are rebalanced by the partition columns: each
folder gets few files, a folder with very many rows is split over several tasks
and small ones share a task.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from tablespoon.operators.incremental import upsert
from tablespoon.schemas import PARTITION_COLUMNS
from tablespoon.sinks import keyindex
from tablespoon.sinks.keyindex import has_index
from tablespoon.sinks.versions import Conflict, all_folders, discard, partition_name, publish, read_folders, write_folders

logger = logging.getLogger(__name__)

# How often a merge is tried against versions of other writers.
ATTEMPTS = 10

# Rows per compressed landed file: one task reads it.
PACKED_ROWS = 100_000


def _usable(df: DataFrame, partitions: list[str] | tuple[str, ...] | None) -> list[str]:
    usable = [p for p in partitions or () if p in df.columns]
    missing = [p for p in partitions or () if p not in df.columns]
    if missing:
        logger.warning("partition columns %s are missing, partitioned by %s", missing, usable)
    return usable


def _balanced(df: DataFrame, partitions: list[str]) -> DataFrame:
    return df.hint("rebalance", *[F.col(p) for p in partitions])


def balanced(df: DataFrame, partitions=PARTITION_COLUMNS) -> DataFrame:
    """Rows dealt out by those of the partition columns that the frame has."""
    usable = [p for p in partitions or () if p in df.columns]
    return _balanced(df, usable) if usable else df


def save_table(df: DataFrame, path: str, partitions=PARTITION_COLUMNS) -> int:
    """Appends; existing rows are never touched and new columns are allowed.
    Returns the number of rows, counted while writing. An empty batch adds no data file."""
    return append(balanced(df, partitions), path, partitions)[0]


def append(df: DataFrame, path: str, partitions=PARTITION_COLUMNS) -> tuple[int, list[str]]:
    """As :func:`save_table`, of rows that are dealt out by their partitions already, and
    also returns the names of the partitions appended to."""
    written = Observation()
    usable = _usable(df, partitions)
    seen = F.collect_set(F.struct(*usable)) if usable else F.array()
    observed = df.observe(written, F.count(F.lit(1)).alias("n"), seen.alias("parts"))
    observed.write.mode("append").partitionBy(*usable).parquet(path)
    n, parts = written.get["n"], written.get["parts"]
    logger.info("%s rows appended to %s", n, path)
    return n, sorted(partition_name(zip(usable, part)) for part in parts)


def save_partitions(df: DataFrame, path: str, partitions=PARTITION_COLUMNS) -> None:
    """Replaces the partitions present in the batch and leaves the others. Partition
    columns that the frame lacks are left out; with none left the write is flat."""
    usable = _usable(df, partitions)
    if not usable:
        save_flat(df, path)
        return
    writer = _balanced(df, usable).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("compression", "snappy").partitionBy(*usable).parquet(path)


def save_flat(df: DataFrame, path: str) -> None:
    """Replaces the whole dataset; an empty batch is skipped."""
    if df.isEmpty():
        logger.warning("nothing to save to %s", path)
        return
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "snappy").parquet(path)


def _packed(writer: DataFrameWriter, packed: bool) -> DataFrameWriter:
    """Compressed files don't split across tasks, so none holds more than ``PACKED_ROWS``."""
    return writer.option("compression", "gzip").option("maxRecordsPerFile", PACKED_ROWS) if packed else writer


def land(df: DataFrame, path: str, day_column: str | None = None, packed: bool = False, dealt: bool = False) -> None:
    """Writes documents as JSON Lines, which split across tasks when read; with a
    day column, one folder ``landing_day=...`` per day. Files of a repeated run
    replace those of the same days. ``packed`` files are compressed, many of bounded
    size in place of few that split. ``dealt`` says that rows are dealt out by day
    already, as they may be while they are smaller than the documents made of them."""
    if day_column is None:
        _packed(df.write.mode("overwrite"), packed).json(path)
        return
    dated = df.withColumnRenamed(day_column, "landing_day")
    writer = (dated if dealt else _balanced(dated, ["landing_day"])).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    _packed(writer, packed).partitionBy("landing_day").json(path)


def land_lines(spark: SparkSession, paths: list[str], path: str, multi_line: bool = False, packed: bool = False) -> None:
    """Writes landed JSON anew as JSON Lines, whatever fields it has: a line that is an
    array becomes a line per element, other lines stay as they are, and blank lines and
    null elements go. So an array is read as a whole once, and in many tasks from then
    on. ``multi_line`` is for files of one indented document, which must fit into a
    row. Malformed arrays fail the write. ``packed`` is as in :func:`land`."""
    rows = spark.read.text(paths, wholetext=multi_line).filter(F.trim(F.col("value")) != "")
    elements = F.from_json("value", "array<string>", {"mode": "FAILFAST"})
    one = F.regexp_replace("value", r"[\r\n]+", " ") if multi_line else F.col("value")
    lines = F.when(F.ltrim(F.translate("value", "\t\r\n", "   ")).startswith("["), elements).otherwise(F.array(one))
    lines = rows.select(F.explode(lines).alias("value")).filter(F.col("value").isNotNull())
    _packed(lines.write.mode("overwrite"), packed).text(path)


def save_all(
    frames: Mapping[str, DataFrame],
    root: str,
    partitions: Mapping[str, tuple[str, ...]] | None = None,
    at_a_time: int | None = None,
) -> dict[str, int]:
    """Appends each frame to its table under ``root``, all at once or ``at_a_time``,
    so that the last tasks of one leave no core idle. The first failure fails the
    run. Returns rows written per table."""
    parts = lambda name: (partitions or {}).get(name, PARTITION_COLUMNS)
    with ThreadPoolExecutor(at_a_time or max(1, len(frames))) as pool:
        writes = {
            name: pool.submit(inheritable_thread_target(df.sparkSession)(save_table), df, f"{root}/{name}", parts(name))
            for name, df in frames.items()
        }
    return {name: write.result() for name, write in writes.items()}


def full_refresh(
    df: DataFrame,
    path: str,
    partitions: tuple[str, ...] = ("year", "month"),
    check: Callable[[DataFrame], object] | None = None,
) -> None:
    """Replaces the whole table. Readers see the old rows until all new ones are
    written and ``check``, which is given them as stored, has not raised."""
    replace_partitions(df, path, partitions, check=check, keep=lambda part: False)


def replace_partitions(
    df: DataFrame,
    path: str,
    partitions: tuple[str, ...] = ("year", "month"),
    keep: Callable[[str], bool] = lambda part: True,
    check: Callable[[DataFrame], object] | None = None,
    base: Mapping[str, str] | None = None,
    read: Callable[[str], bool] | None = None,
    also: Mapping[str, str] | None = None,
) -> None:
    """Publishes a version made of the rows of ``df`` and of those partitions of
    the current one that ``df`` has no rows for and ``keep`` wants. With ``base``,
    the folders that the rows were computed from, it raises
    :class:`~tablespoon.sinks.versions.Conflict` where another writer has changed
    those that ``read`` accepts, by default the ones replaced. ``also`` are folders
    written beside the table, which become part of the version."""
    spark = df.sparkSession
    written = write_folders(df, path, partitions)
    try:
        if check:
            check(read_folders(spark, path, written, df.schema))
        publish(spark, path, written | dict(also or {}), keep, base, read)
    except Exception:
        discard(spark, path, written)
        raise


def merge_table(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: list[str],
    partitions: tuple[str, ...] = ("year", "month"),
    mode: str = "unique",
    search: Callable[[str], bool] = lambda part: True,
    buckets: int | None = None,
) -> None:
    """Upserts into a published table, rewriting only the partitions concerned.

    Those are the partitions of the source rows and of the target rows they
    match; the list is bounded by the number of folders. With ``buckets``, the
    table has an index of its keys in that many buckets, from its first such merge
    on: matches are then found in any partition, by the buckets of the source's
    keys alone. Without, they are looked for in the keys of the partitions that
    ``search`` accepts, by default in all. ``source`` is read several times, so it
    should be a stored table. Where another writer has published in the
    meantime, the merge is done again on its version.
    """
    for left in reversed(range(ATTEMPTS)):
        try:
            return _merge(spark, path, source, keys, partitions, mode, search, buckets)
        except Conflict:
            if not left:
                raise
            logger.warning("%s was published by another writer, merging again", path)


def _merge(spark, path, source, keys, partitions, mode, search, buckets) -> None:
    current = all_folders(spark, path) or {}
    main = {part: folder for part, folder in current.items() if not part.startswith("@")}
    columns = source.select(*keys, *partitions).schema
    also, changed = {}, []
    if buckets is None:
        rows = read_folders(spark, path, {part: folder for part, folder in main.items() if search(part)}, source.schema)
        matched = rows.select(*keys, *partitions).join(source.select(*keys).distinct(), keys, "left_semi")
    else:
        if has_index(current):
            changed = keyindex.touched_buckets(source, keys, buckets)
            index = keyindex.read_index(spark, path, current, changed, columns)
        else:  # made from all keys, once
            index = keyindex.index_of(read_folders(spark, path, main, source.schema), keys, partitions, buckets)
        matched = keyindex.found_for(index, source, keys)
    parts = matched.select(*partitions).union(source.select(*partitions)).distinct().collect()
    touched = {partition_name((p, row[p]) for p in partitions) for row in parts}
    if not touched:
        return
    target = read_folders(spark, path, {part: folder for part, folder in main.items() if part in touched}, source.schema)
    merged = upsert(target, source, keys, mode)
    if buckets is not None:
        also = keyindex.write_index(keyindex.renewed(index, source, keys, partitions, buckets), path)
        changed = changed or [part for part in current if part.startswith("@")]
        depends = lambda part: part in touched or part in also or part in changed
    else:  # keys may have come to any partition searched
        depends = lambda part: part in touched or (not part.startswith("@") and search(part))
        changed = [part for part in current if part.startswith("@")]  # an index that is not kept up must not stay
    replaced = touched.union(changed)
    try:
        replace_partitions(merged, path, partitions, lambda part: part not in replaced, None, current, depends, also)
    except Exception:
        discard(spark, path, also)
        raise
