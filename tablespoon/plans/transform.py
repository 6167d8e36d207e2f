"""Landed fields to a bronze table: enrich, rename, cast, partition."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablespoon.functions import business_date
from tablespoon.operators.nested import split_document
from tablespoon.operators.standardize import (
    add_business_date,
    branch_enrich,
    cast_table,
    partition_master,
    partition_trans,
    pick_date_column,
    rename_project,
)
from tablespoon.schemas import INGEST_COLUMN, INVOICES, MASTER_TABLES, ORDERS, SPECS, TableSpec


def transform(
    df: DataFrame,
    table: str,
    run_ts: dt.datetime | None = None,
    branch_map: Mapping[str, str] | None = None,
    specs: Mapping[str, TableSpec] = SPECS,
) -> DataFrame:
    """One landed table to its bronze form. Narrow but for the branch lookup,
    which is broadcast."""
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc)
    spec = specs.get(table)
    date_field = pick_date_column(df.columns)
    enriched = add_business_date(branch_enrich(df, branch_map))
    typed = cast_table(rename_project(enriched, spec), spec)
    if table in MASTER_TABLES:
        return partition_master(typed, run_ts)
    renamed = spec.columns.get(date_field) if spec else date_field
    return partition_trans(typed, run_ts, same_field=renamed)


def landed_copy(documents: DataFrame, by_day: bool = False) -> DataFrame:
    """Nested documents, as read from files, with the load-free part of their mark:
    the day in the file's path, and the content, which tells copies within a day
    apart. The path is known only until rows are shuffled. ``by_day`` deals them out
    by their business date, once their path is read and before they are marked."""
    day = F.regexp_extract(F.input_file_name(), r"(\d{4})-(\d{2})-(\d{2})(?!.*\d{4}-\d{2}-\d{2})", 0)
    content = F.hex(F.xxhash64(*[F.col(c) for c in documents.columns]))
    landed = documents.withColumn("_landed", F.translate(day, "-", ""))
    field = pick_date_column(documents.columns)
    if by_day and field is not None:
        date = business_date(f"`{field}`", documents.schema[field].dataType)
        landed = landed.withColumn("_date", date).hint("rebalance", F.col("_date")).drop("_date")
    return landed.withColumn(INGEST_COLUMN, F.concat_ws("-", "_landed", content)).drop("_landed")


def stamped(documents: DataFrame, load: str, by_day: bool = False) -> DataFrame:
    """Nested documents with the mark of the landed copy they are: the load, whose
    id sorts by time, and then as :func:`landed_copy` has it."""
    copies = documents if INGEST_COLUMN in documents.columns else landed_copy(documents, by_day)
    return copies.withColumn(INGEST_COLUMN, F.concat(F.lit(f"{load}-"), INGEST_COLUMN))


def transform_transactions(
    documents: Mapping[str, DataFrame],
    run_ts: dt.datetime | None = None,
    branch_map: Mapping[str, str] | None = None,
    specs: Mapping[str, TableSpec] = SPECS,
) -> dict[str, DataFrame]:
    """Nested orders and invoices to the five transaction tables."""
    frames = {}
    for document in (ORDERS, INVOICES):
        for table, df in split_document(documents[document.header], document).items():
            frames[table] = transform(df, table, run_ts, branch_map, specs)
    return frames


def dated_by_document(documents: Mapping[str, DataFrame]) -> set[str]:
    """The transaction tables whose rows take their business date from the field by which
    :func:`landed_copy` deals out the documents."""
    dated = set()
    for document in (ORDERS, INVOICES):
        field = pick_date_column(documents[document.header].columns)
        for table, df in split_document(documents[document.header], document).items():
            own = pick_date_column(df.columns)
            of_header = own if table == document.header else document.parents.get(own)
            if field is not None and of_header == field:
                dated.add(table)
    return dated


def transform_master(
    documents: Mapping[str, DataFrame],
    run_ts: dt.datetime | None = None,
    branch_map: Mapping[str, str] | None = None,
    specs: Mapping[str, TableSpec] = SPECS,
) -> dict[str, DataFrame]:
    """Product and customer snapshots to their tables."""
    return {name: transform(df, name, run_ts, branch_map, specs) for name, df in documents.items()}
