"""Landed JSON documents.

A landing folder holds ``{day}/orders.json``, ``{day}/invoices.json``,
``master/products.json`` and ``master/customers.json``; each name is a file or a
folder of files. JSON Lines is what :func:`tablespoon.sinks.land` writes, because
such files split across tasks. A file that is one top-level array on one line
reads as well, one task per file; :func:`tablespoon.sinks.land_lines` writes such
files anew as JSON Lines. The schema is always given: it is never inferred,
so a field that is absent on some days is null, not a different schema.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tablespoon.schemas import CUSTOMERS, INVOICES, ORDERS, PRODUCTS, SPECS, Document, TableSpec

logger = logging.getLogger(__name__)

# Where a day's documents are: one folder per day, or one per document with the
# day as a partition, which is how a single job lands many days.
BY_DAY = "{day}/{file}"
BY_DOCUMENT = "{file}/landing_day={day}"


def _path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def existing(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """The paths that exist, in order."""
    return [p for p in paths if _path_exists(spark, p)]


def read_document(
    spark: SparkSession,
    document: Document,
    paths: list[str],
    multi_line: bool = False,
    specs: Mapping[str, TableSpec] = SPECS,
) -> DataFrame:
    """Landed documents as nested rows. Malformed JSON fails the read. No path
    gives no rows but the full schema."""
    schema = document.landing(specs)
    if not paths:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", multi_line)
    return reader.json(paths)


def read_days(
    spark: SparkSession,
    landing: str,
    days: list[str],
    layout: str = BY_DAY,
    multi_line: bool = False,
    specs: Mapping[str, TableSpec] = SPECS,
) -> dict[str, DataFrame]:
    """Orders and invoices of all the given days as one frame each. A day is
    skipped, with a warning, when its orders are missing; one that has orders
    and no invoices has just orders."""
    path = lambda day, document: f"{landing}/{layout.format(day=day, file=document.file)}"
    landed = []
    for day in days:
        if existing(spark, [path(day, ORDERS)]):
            landed.append(day)
        else:
            logger.warning("nothing landed for %s, skipped", day)
    paths = lambda document: existing(spark, [path(day, document) for day in landed])
    return {
        document.header: read_document(spark, document, paths(document), multi_line, specs)
        for document in (ORDERS, INVOICES)
    }


def read_transactions(spark: SparkSession, landing: str, day: str, multi_line: bool = False) -> dict[str, DataFrame]:
    """Orders and invoices of one day."""
    return read_days(spark, landing, [day], multi_line=multi_line)


def read_master(
    spark: SparkSession, landing: str, multi_line: bool = False, specs: Mapping[str, TableSpec] = SPECS
) -> dict[str, DataFrame]:
    """The full product and customer snapshots."""
    return {
        document.header: read_document(spark, document, [f"{landing}/master/{document.file}"], multi_line, specs)
        for document in (PRODUCTS, CUSTOMERS)
    }
