"""Tables that are published in versions.

A table's folder holds a data folder per write and ``_versions``, one small file
per version that lists the partition folders it is made of. A write first fills
a data folder that no version names; readers see it only once its version file
is there. A run that dies before that leaves the table as it was. Partition
columns are stored in the files, too, so that a version may take its folders
from several data folders.

Version files are numbered and each number is written once. A writer who finds
its number taken looks at what the other has published: if its own rows depend
on none of that, it goes on from there, else it is told to start again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablespoon.session import remove
from tablespoon.sinks.files import names, read_text, write_once

_VERSIONS = "_versions"

# Versions whose folders are kept: the current one and the one that readers may still be at.
KEPT = 2


class Conflict(RuntimeError):
    """Another writer has changed partitions that rows were computed from."""


def _versions(spark: SparkSession, path: str) -> list[str]:
    return [n for n in names(spark, f"{path}/{_VERSIONS}") if n.endswith(".json") and not n.startswith(".")]


def _read(spark: SparkSession, path: str, version: str) -> dict[str, str]:
    return json.loads(read_text(spark, f"{path}/{_VERSIONS}/{version}"))


def all_folders(spark: SparkSession, path: str) -> dict[str, str] | None:
    """Folders of the current version, relative to the table, by partition such as
    ``year=2024/month=1``, and those of the tables beside it, such as
    ``@keys/bucket=3``; None if nothing was published yet."""
    versions = _versions(spark, path)
    return _read(spark, path, versions[-1]) if versions else None


def folders(spark: SparkSession, path: str) -> dict[str, str] | None:
    """Partition folders of the current version without those beside it."""
    current = all_folders(spark, path)
    return None if current is None else {part: folder for part, folder in current.items() if not part.startswith("@")}


def beside(name: str, found: Mapping[str, str]) -> dict[str, str]:
    """Folders as those of a table that is kept beside another one and published with it."""
    return {f"@{name}/{part}": folder for part, folder in found.items()}


def read_version(
    spark: SparkSession, path: str, schema: T.StructType | None = None, only: Iterable[str] | None = None
) -> DataFrame:
    """The table's current version, or of that the partitions ``only``. With a
    schema, a table without rows, or one that was never published, is empty."""
    current, only = folders(spark, path) or {}, None if only is None else set(only)
    return read_folders(spark, path, {p: f for p, f in current.items() if only is None or p in only}, schema)


def read_folders(spark: SparkSession, path: str, chosen: Mapping[str, str], schema: T.StructType | None) -> DataFrame:
    """The rows of some partition folders of a table, published or not."""
    if chosen:
        paths = [f"{path}/{folder}" for folder in chosen.values()]
        return (spark.read if schema is None else spark.read.schema(schema)).parquet(*paths)
    if schema is None:
        raise ValueError(f"{path} has no rows; its schema is needed to read it")
    return spark.createDataFrame([], schema)


def partition_name(values: Iterable[tuple[str, object]]) -> str:
    """A partition as it is named in versions."""
    return "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in values)


def in_parts(parts: Iterable[str]) -> Column:
    """Rows of the partitions so named; on partition columns it keeps other folders from being read."""
    parts = list(parts)
    if not parts:
        return F.lit(False)
    columns = [p.split("=")[0] for p in parts[0].split("/")]
    values = [F.coalesce(F.col(c).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")) for c in columns]
    return F.concat_ws("/", *[F.concat(F.lit(f"{c}="), v) for c, v in zip(columns, values)]).isin(parts)


def write_folders(df: DataFrame, path: str, partitions: tuple[str, ...]) -> dict[str, str]:
    """Writes a data folder that no version names yet. Gives its partition folders."""
    spark, data = df.sparkSession, f"data-{uuid.uuid4().hex}"
    copies = {f"in_{p}": F.col(p) for p in partitions}
    balanced = df.hint("rebalance", *[F.col(p) for p in partitions]) if partitions else df
    balanced.withColumns(copies).write.partitionBy(*copies).parquet(f"{path}/{data}")
    found = {"": data}
    for p in partitions:
        found = {
            f"{part}/{name}".lstrip("/"): f"{folder}/in_{name}"
            for part, folder in found.items()
            for name in [n[3:] for n in names(spark, f"{path}/{folder}") if n.startswith(f"in_{p}=")]
        }
    return found


def discard(spark: SparkSession, path: str, written: Mapping[str, str]) -> None:
    """Removes what :func:`write_folders` wrote, if it is not to be published."""
    for data in {folder.split("/")[0] for folder in written.values()}:
        remove(spark, f"{path}/{data}")


def publish(
    spark: SparkSession,
    path: str,
    written: Mapping[str, str],
    keep: Callable[[str], bool] = lambda part: False,
    base: Mapping[str, str] | None = None,
    read: Callable[[str], bool] | None = None,
) -> None:
    """Makes ``written``, and the partitions of the current version that ``keep``
    wants, the next version, in one step for readers.

    ``base`` is the version that the rows were computed from, and ``read`` says
    which of its partitions they depend on: by default those that they replace. If
    another writer has changed one of these since, :class:`Conflict` is raised and
    nothing published. Without a base the last writer wins. Folders that only
    versions before the last ``KEPT`` name are removed.
    """
    read = read or (lambda part: part in written or not keep(part))
    while True:
        versions = _versions(spark, path)
        now = _read(spark, path, versions[-1]) if versions else {}
        if base is not None:
            changed = [p for p in {*base, *now} if base.get(p) != now.get(p) and read(p)]
            if changed:
                raise Conflict(f"{path}: {sorted(changed)} changed since they were read")
        number = int(versions[-1].split(".")[0].split("-")[0]) + 1 if versions else 1
        made_of = {part: folder for part, folder in now.items() if keep(part)} | dict(written)
        if write_once(spark, f"{path}/{_VERSIONS}/{number:010d}.json", json.dumps(made_of)):
            break
    old, kept = versions[: -KEPT + 1], versions[-KEPT + 1 :]
    used = set(made_of.values()).union(*(_read(spark, path, v).values() for v in kept)) if old else set()
    for version in old:
        for folder in set(_read(spark, path, version).values()) - used:
            remove(spark, f"{path}/{folder}")
        remove(spark, f"{path}/{_VERSIONS}/{version}")
