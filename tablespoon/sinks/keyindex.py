"""Which partitions a key's rows are in, as a table beside a published one.

The index has a row per key and partition, in hash buckets. It is published with
the table, in one version, so the two never disagree. A merge reads the buckets of
its own keys in place of the keys of all partitions, however far back a key lies.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablespoon.sinks.versions import beside, partition_name, read_folders, write_folders

KEYS = "keys"

# Buckets of an index; fixed for the life of a table.
BUCKETS = 64


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _name(bucket: int) -> str:
    return f"@{KEYS}/{partition_name([('bucket', bucket)])}"


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    """Keys are equal, or both null."""
    same = F.lit(True)
    for key in keys:
        same = same & a[key].eqNullSafe(b[key])
    return same


def index_rows(df: DataFrame, keys: list[str], partitions: tuple[str, ...], buckets: int = BUCKETS) -> DataFrame:
    """An index row per row of the frame."""
    return df.select(*keys, *partitions).withColumn("bucket", bucket_of(keys, buckets))


def index_of(df: DataFrame, keys: list[str], partitions: tuple[str, ...], buckets: int = BUCKETS) -> DataFrame:
    """An index row per key and partition of the frame."""
    return index_rows(df.select(*keys, *partitions).distinct(), keys, partitions, buckets)


def write_index(index: DataFrame, path: str) -> dict[str, str]:
    """Writes index rows. Gives folders to be published with the table."""
    return beside(KEYS, write_folders(index, path, ("bucket",)))


def has_index(current: Mapping[str, str]) -> bool:
    return any(part.startswith(f"@{KEYS}/") for part in current)


def touched_buckets(df: DataFrame, keys: list[str], buckets: int = BUCKETS) -> list[str]:
    """The names, as published, of the buckets that the frame's keys are in."""
    return [_name(r[0]) for r in df.select(bucket_of(keys, buckets)).distinct().collect()]  # no more than there are buckets


def read_index(
    spark: SparkSession, path: str, current: Mapping[str, str], touched: list[str], schema: T.StructType
) -> DataFrame:
    """The index rows of some buckets; ``schema`` is that of the keys and partition columns."""
    stored = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    return read_folders(spark, path, {part: current[part] for part in touched if part in current}, stored)


def found_for(index: DataFrame, df: DataFrame, keys: list[str]) -> DataFrame:
    """The index rows of the frame's keys."""
    ids = df.select(*keys).distinct()
    return index.join(ids, _same(index, ids, keys), "left_semi")


def renewed(index: DataFrame, df: DataFrame, keys: list[str], partitions: tuple[str, ...], buckets: int = BUCKETS) -> DataFrame:
    """The index rows after all rows of the frame's keys were replaced by the frame."""
    ids = df.select(*keys).distinct()
    others = index.join(ids, _same(index, ids, keys), "left_anti")
    return others.unionByName(index_of(df, keys, partitions, buckets))
