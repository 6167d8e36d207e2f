"""Loads of several tables that count as a whole.

A load marks itself as open in the log beside the bronze tables, appends to its
tables and then commits: its record, one small file, is written once under the
load's name, and the mark goes. Readers leave out the rows of loads that are
open, so one that dies between two tables, or is still running, is in none of
them; without open loads, the usual case, nothing is filtered. A name that has
committed is not loaded again, so a scheduler that repeats a run under its name
adds nothing. Rows say which load they are of in the first part of their mark.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import quote, unquote

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablespoon.schemas import INGEST_COLUMN, PARTITION_COLUMNS
from tablespoon.session import remove
from tablespoon.sinks.files import at, names, read_text, write_once
from tablespoon.sinks.tables import append, balanced

_LOG = "_loads"


def load_id(run_ts: dt.datetime) -> str:
    """A new load's id, which sorts by time."""
    aware = run_ts if run_ts.tzinfo else run_ts.replace(tzinfo=dt.timezone.utc)
    return f"{aware.astimezone(dt.timezone.utc):%Y%m%dT%H%M%S%f}.{uuid.uuid4().hex[:8]}"


def load_of(mark: Column | str = INGEST_COLUMN) -> Column:
    """The load that a row is of; null without a mark."""
    return F.substring_index(mark, "-", 1)


def committed_loads(spark: SparkSession, bronze: str) -> list[str]:
    """Names under which loads have committed."""
    return [unquote(n.removesuffix(".json")) for n in names(spark, f"{bronze}/{_LOG}/done") if n.endswith(".json") and not n.startswith(".")]


def committed(spark: SparkSession, bronze: str, name: str) -> dict | None:
    """The record of the load that committed under a name: its id, rows and day folders per table."""
    path = f"{bronze}/{_LOG}/done/{quote(name, safe='')}.json"
    system, hadoop_path = at(spark, path)
    return json.loads(read_text(spark, path)) if system.exists(hadoop_path) else None


def open_loads(spark: SparkSession, bronze: str) -> list[str]:
    """Ids of loads that have begun and not committed: running, or dead."""
    found = []
    for load in names(spark, f"{bronze}/{_LOG}/open"):
        if not load.startswith("."):
            record = committed(spark, bronze, read_text(spark, f"{bronze}/{_LOG}/open/{load}"))
            if record is None or record["load"] != load:  # else it died after its commit
                found.append(load)
    return found


def whole(df: DataFrame, open_: Iterable[str]) -> DataFrame:
    """Rows less those of open loads. Rows without a mark are of no load and stay."""
    open_ = list(open_)
    if not open_ or INGEST_COLUMN not in df.columns:
        return df
    return df.filter(F.coalesce(~load_of().isin(open_), F.lit(True)))


def records(spark: SparkSession, bronze: str, schema: str) -> DataFrame:
    """The records of all committed loads, the fields of ``schema``; there may be very many."""
    path = f"{bronze}/{_LOG}/done"
    system, hadoop_path = at(spark, path)
    return spark.read.schema(schema).json(path) if system.exists(hadoop_path) else spark.createDataFrame([], schema)


def begin_load(spark: SparkSession, bronze: str, load: str, name: str) -> str:
    """Marks a load as open; its rows are hidden from now on. Returns the mark's path."""
    mark = f"{bronze}/{_LOG}/open/{load}"
    write_once(spark, mark, name)
    return mark


def save_load(
    frames: Mapping[str, DataFrame],
    bronze: str,
    load: str,
    name: str | None = None,
    partitions: Mapping[str, tuple[str, ...]] | None = None,
    at_a_time: int | None = None,
    about: Mapping[str, object] | None = None,
    dealt: Iterable[str] = (),
) -> dict[str, int]:
    """Appends frames, whose rows are marked as of ``load``, to their tables, all or
    none of them for readers. Returns rows per table. A name that has committed
    is left as it is and its rows are told. A load without rows leaves no record,
    so that its name can be used once there are some. ``about`` goes into the record.
    Frames of the tables ``dealt`` are dealt out by their partitions already."""
    spark, name = next(iter(frames.values())).sparkSession, name or load
    done = committed(spark, bronze, name)
    if done:
        return done["rows"]
    mark = begin_load(spark, bronze, load, name)
    parts = lambda table: (partitions or {}).get(table, PARTITION_COLUMNS)
    dealt = set(dealt)
    rows = lambda table: frames[table] if table in dealt else balanced(frames[table], parts(table))
    with ThreadPoolExecutor(at_a_time or max(1, len(frames))) as pool:
        writes = {
            table: pool.submit(inheritable_thread_target(spark)(append), rows(table), f"{bronze}/{table}", parts(table))
            for table in frames
        }
    results = {table: write.result() for table, write in writes.items()}
    record = {**(about or {}), "load": load, "rows": {t: n for t, (n, _) in results.items()}, "parts": {t: p for t, (_, p) in results.items()}}
    if not any(record["rows"].values()):
        remove(spark, mark)
    elif write_once(spark, f"{bronze}/{_LOG}/done/{quote(name, safe='')}.json", json.dumps(record)):
        remove(spark, mark)
    else:  # another run of that name was faster; these rows stay hidden
        record = committed(spark, bronze, name)
    return record["rows"]


def discard_load(spark: SparkSession, bronze: str, load: str, frames: Mapping[str, DataFrame]) -> int:
    """Removes the files of a dead load from tables ``frames``, read unfiltered, and
    then its mark. Returns the number of files. An append's files hold one load's
    rows, so nothing else goes; a load that may still be running is not for this."""
    gone = 0
    for df in frames.values():
        files = df.filter(load_of() == load).select(F.input_file_name().alias("file")).distinct()
        for r in files.collect():  # files of one load
            remove(spark, r["file"])
            gone += 1
    remove(spark, f"{bronze}/{_LOG}/open/{load}")
    return gone
