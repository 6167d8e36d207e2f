"""Stored tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablespoon.schemas import SPECS, TableSpec
from tablespoon.sinks.loads import open_loads, whole


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A stored table. With a schema, columns that older files lack are null and
    no file footer is read; without, the schemas of all files are merged."""
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", True).parquet(path)


def source(
    spark: SparkSession, bronze: str, name: str, merge_schema: bool = False, specs: Mapping[str, TableSpec] = SPECS,
    open_: list[str] | None = None,
) -> DataFrame:
    """A bronze table by its registered name, without the rows of loads that have not
    committed. Who reads several tables looks once which these are, and says so."""
    rows = read_table(spark, f"{bronze}/{name}", None if merge_schema else specs[name].stored)
    return whole(rows, open_loads(spark, bronze) if open_ is None else open_)


def register_views(frames: Mapping[str, DataFrame]) -> None:
    """Publishes frames as temporary views."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
