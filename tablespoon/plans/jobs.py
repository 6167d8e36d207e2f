"""Jobs: master load, transaction load, model build, daily run, backfill.

A job is a plain function; when and how often it runs is up to the scheduler
that calls it. Days are ``yyyy-MM-dd``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablespoon.operators.incremental import lookback
from tablespoon.operators.quality import (
    FAILED,
    REPORT_SCHEMA,
    WARN,
    check_future,
    check_negative,
    check_not_null,
    gate,
    run_checks,
    verify_table,
    with_failures,
)
from tablespoon.operators.standardize import local_day, pick_date_column
from tablespoon.plans.marts import (
    REVENUE_TABLE,
    SALES_KEY,
    SALES_TABLE,
    apply_deltas,
    mart_header,
    revenue_daily,
    revenue_deltas,
    revenue_of_months,
    sales_increment,
    sales_lines,
)
from tablespoon.plans.staging import latest_invoice, staging, stg_order_header
from tablespoon.plans.transform import dated_by_document, landed_copy, stamped, transform_master, transform_transactions
from tablespoon.schemas import INGEST_COLUMN, PARTITION_COLUMNS, SPECS, TableSpec
from tablespoon.session import scratch
from tablespoon.sinks import discard_load, full_refresh, load_id, merge_table, open_loads, read_version, replace_partitions, save_load
from tablespoon.sinks.keyindex import BUCKETS, found_for, index_of, index_rows, read_index, touched_buckets, write_index
from tablespoon.sinks.loads import committed, committed_loads, load_of, records
from tablespoon.sinks.versions import all_folders, beside, discard, folders, in_parts, partition_name, publish, read_folders, write_folders
from tablespoon.sources import existing, read_days, read_master, read_table, source
from tablespoon.sources.landing import BY_DAY

_LOADS = "load string, dedupe boolean"
_SUMS = "load string, sums map<string, map<string, struct<n: bigint, sum: string>>>"

# Landed days per load that a filter lists at most.
_MOST_LANDED = 1000

# Columns of the sales table that must be filled.
REQUIRED_SALES = ["order_id", "item_id", "report_date", "net_revenue_inclusive"]


@dataclass(frozen=True)
class Lake:
    """Where the data lives, and what differs between deployments."""

    landing: str
    bronze: str
    marts: str
    branch_map: Mapping[str, str] = field(default_factory=dict)
    specs: Mapping[str, TableSpec] = field(default_factory=lambda: SPECS)
    layout: str = BY_DAY
    buckets: int = BUCKETS  # of the marts' key indexes; fixed once there are marts

    def partitions(self) -> dict[str, tuple[str, ...]]:
        return {name: spec.partitions for name, spec in self.specs.items()}


def run_master(
    spark: SparkSession, lake: Lake, run_ts: dt.datetime | None = None, name: str | None = None, verify: bool = False
) -> dict[str, int]:
    """Loads the product and customer snapshots, both or none. Returns rows per
    table. ``name`` and ``verify`` are as in :func:`run_transactions`."""
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc)
    load = load_id(run_ts)
    documents = {table: stamped(df, load) for table, df in read_master(spark, lake.landing, specs=lake.specs).items()}
    frames = transform_master(documents, run_ts, lake.branch_map, lake.specs)
    if verify:
        _verify(documents, frames)
    return save_load(frames, lake.bronze, load, name, lake.partitions())


def run_transactions(
    spark: SparkSession,
    lake: Lake,
    days: str | list[str],
    run_ts: dt.datetime | None = None,
    name: str | None = None,
    verify: bool = False,
) -> dict[str, int]:
    """Loads the orders and invoices of one or several days, as one job per table
    whatever the number of days. Returns rows per table.

    The documents are parsed once, into a staged table, dealt out by their business
    date there, and the five tables each read their own columns of it: what takes its
    date from the document is written as it lies. So nothing is loaded when a document is broken,
    and readers see the load's rows once all tables have them. A scheduler that may
    repeat a run gives it a ``name``: a name that has been loaded is not loaded
    again. With ``verify`` the load must pass the checks on row counts and keys.
    """
    days = [days] if isinstance(days, str) else days
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc)
    done = committed(spark, lake.bronze, name) if name else None
    if done:
        return done["rows"]
    load = load_id(run_ts)
    with scratch(spark, "documents") as staged:
        documents = read_days(spark, lake.landing, days, lake.layout, specs=lake.specs)
        documents = {table: stamped(df, load, by_day=True) for table, df in documents.items()}
        for table, df in documents.items():
            df.write.option("compression", "zstd").parquet(f"{staged}/{table}")
        parsed = {table: read_table(spark, f"{staged}/{table}", df.schema) for table, df in documents.items()}
        frames = transform_transactions(parsed, run_ts, lake.branch_map, lake.specs)
        if verify:
            _verify(parsed, frames)
        sums = {table: {r["day"]: {"n": r["n"], "sum": r["sum"]} for r in content_sums(df).collect()} for table, df in parsed.items()}
        by_date = [t for t in dated_by_document(parsed) if {*lake.specs[t].partitions} <= {*PARTITION_COLUMNS, "report_date"}]
        return save_load(frames, lake.bronze, load, name, lake.partitions(), about={"sums": sums}, dealt=by_date)


def content_sums(documents: DataFrame) -> DataFrame:
    """``day, n, sum``: per landed day of marked documents their number and the sum of
    their contents' hashes, in which order plays no part; a row per day."""
    parts = F.split(INGEST_COLUMN, "-")
    number = F.conv(F.element_at(parts, -1), 16, 10).cast("decimal(38,0)")
    by_day = documents.groupBy(F.element_at(parts, -2).alias("day"))
    return by_day.agg(F.count(F.lit(1)).alias("n"), F.sum(number).cast("string").alias("sum"))


def changed_days(spark: SparkSession, lake: Lake, days: list[str]) -> list[str]:
    """Those of the days whose landed documents are not what the last load of that day
    took in. Landing is read; of bronze only the records of its loads are."""
    landed = None
    for table, df in read_days(spark, lake.landing, days, lake.layout, specs=lake.specs).items():
        sums = content_sums(landed_copy(df)).select(F.lit(table).alias("table"), "day", "n", "sum")
        landed = sums if landed is None else landed.unionByName(sums)
    loaded = records(spark, lake.bronze, _SUMS).select("load", F.explode("sums").alias("table", "of_day"))
    loaded = loaded.select("load", "table", F.explode("of_day").alias("day", "of")).groupBy("table", "day")
    last = loaded.agg(F.max_by("of", "load").alias("of"))
    same = landed.join(last, ["table", "day"], "full").filter(
        ~(F.col("n").eqNullSafe(F.col("of.n")) & F.col("sum").eqNullSafe(F.col("of.sum")))
    )
    changed = {r["day"] for r in same.select("day").distinct().collect()}  # days
    return [day for day in days if day.replace("-", "") in changed]


def _verify(raw: Mapping[str, DataFrame], frames: Mapping[str, DataFrame]) -> None:
    """Row counts of headers, and keys and amounts of all tables, before anything is loaded."""
    reports = [verify_table(raw.get(table, df), df, table) for table, df in frames.items()]
    gate(reduce(DataFrame.unionByName, reports))


def clear_dead_loads(spark: SparkSession, lake: Lake, before: dt.datetime) -> int:
    """Removes what loads begun before a time, and dead since, have left in the
    bronze tables. Returns the number of files. Readers never saw their rows."""
    tables = {t: source(spark, lake.bronze, t, specs=lake.specs, open_=[]) for t in lake.specs if existing(spark, [f"{lake.bronze}/{t}"])}
    dead = [load for load in open_loads(spark, lake.bronze) if load < load_id(before)]
    return sum(discard_load(spark, lake.bronze, load, tables) for load in dead)


def bronze_tables(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """The bronze tables written so far, by name, all as of the same loads."""
    open_ = open_loads(spark, lake.bronze)
    written = [table for table in lake.specs if existing(spark, [f"{lake.bronze}/{table}"])]
    return {table: source(spark, lake.bronze, table, specs=lake.specs, open_=open_) for table in written}


def build(
    spark: SparkSession,
    lake: Lake,
    as_of: dt.date,
    backfill_days: int = 3,
    high_water_only: bool = True,
    dedupe: bool = True,
    mode: str = "replace",
    moved_within_months: int | None = None,
    quarantine: bool = False,
) -> DataFrame:
    """Builds staging views and marts and returns the quality report.

    An invoice that changed its day is found in any month of the sales table, by
    an index of invoices to months; with ``moved_within_months`` there is no index,
    and months from that many before ``as_of`` on are searched.

    A failed check raises: those on the sales table before it is published, the
    one on orders, which no mart depends on, at the end. By default the lines of
    an invoice are replaced together, since an item may be on several of them.
    With ``quarantine`` lines that fail a check don't stop the build: they go, with
    the names of the checks, to a table of their own in place of the mart, where
    they stay until their invoice is built again.
    """
    bronze = bronze_tables(spark, lake)
    models = staging(bronze)
    reports = []
    if "order_header" in bronze:
        future = check_future("order_date", as_of)
        # The latest copy of an order is in the future if any copy is, so copies
        # that are not need no ranking and the condition reaches the scan.
        suspects = stg_order_header(bronze["order_header"].filter(future[0].violates))
        reports.append(run_checks(suspects, future))
    if "stg_invoice_header" in models:
        header, detail = mart_header(models["stg_invoice_header"]), models["stg_invoice_detail"]
        _build_revenue(spark, lake, header, dedupe)
        reports.append(
            _build_sales(spark, lake, header, detail, as_of, backfill_days, high_water_only, dedupe, mode, moved_within_months, quarantine)
        )
    if not reports:
        return spark.createDataFrame([], REPORT_SCHEMA)
    return gate(reduce(DataFrame.unionByName, reports))


def _build_revenue(spark: SparkSession, lake: Lake, header: DataFrame, dedupe: bool) -> None:
    """Brings daily revenue up to date with the loads that have committed.

    The first build reads all invoices. Later ones read those of new loads and, by
    an index of invoices to months, the earlier copies of the same invoices, and add
    signed differences to the days concerned. Mart, index and the list of loads
    that it holds are one version, so a run that dies has changed nothing. Rows that
    were appended without a load are taken in by a first build only.
    """
    path, key, month = f"{lake.marts}/{REVENUE_TABLE}", ["ref_id"], ("year", "month")
    current = all_folders(spark, path) or {}
    built = read_folders(spark, path, {p: f for p, f in current.items() if p.startswith("@loads/")}, _LOADS)
    applied = {r["load"] for r in built.filter(F.col("dedupe") == dedupe).collect()}  # a row per load
    loads = committed_loads(spark, lake.bronze)
    new = [committed(spark, lake.bronze, load) for load in loads if load not in applied] if applied else []
    if applied and not new:
        return
    counted = spark.createDataFrame([(load, dedupe) for load in loads], _LOADS).coalesce(1)
    with scratch(spark, "revenue") as work:
        if not applied:
            written = write_folders(revenue_daily(header, dedupe), path, month)
            written |= write_index(index_of(header, key, month, lake.buckets), path)
            replaced = set(current)
        else:
            rows_of_loads(header, new).write.parquet(f"{work}/batch")
            batch = read_table(spark, f"{work}/batch", header.schema)
            buckets = touched_buckets(batch, key, lake.buckets)
            index = read_index(spark, path, current, buckets, header.select(*key, *month).schema)
            if dedupe:
                changes = revenue_deltas(batch, earlier_copies(header, batch, index, new))
            else:  # copies add up where they are
                changes = batch.select(*month).distinct()
            changes.write.parquet(f"{work}/changes")
            changes = read_table(spark, f"{work}/changes", changes.schema)
            months = {partition_name(r.asDict().items()) for r in changes.select(*month).distinct().collect()}  # a row per folder
            old = read_folders(spark, path, {p: f for p, f in current.items() if p in months}, revenue_daily(header).schema)
            rows = apply_deltas(old, changes) if dedupe else revenue_of_months(header, changes)
            written = write_folders(rows, path, month)
            merged = index.unionByName(index_rows(batch, key, month, lake.buckets)).distinct()
            written |= write_index(merged, path)
            replaced = months.union(buckets, [p for p in current if p.startswith("@loads/")])
        written |= beside("loads", write_folders(counted, path, ()))
        try:
            publish(spark, path, written, lambda part: part not in replaced, current, lambda part: True)
        except Exception:
            discard(spark, path, written)
            raise


def rows_of_loads(header: DataFrame, loads: list[dict]) -> DataFrame:
    """The invoices of some loads, by their records, out of the folders that these wrote to."""
    parts = sorted({part for record in loads for part in record["parts"].get("invoice_header", [])})
    return header.filter(in_parts(parts) & load_of().isin([record["load"] for record in loads]))


def earlier_copies(header: DataFrame, batch: DataFrame, index: DataFrame, loads: list[dict]) -> DataFrame:
    """What other loads than its own brought in the months that the index has for a
    batch's invoices. :func:`revenue_deltas` takes the copies of these invoices out of it."""
    found = found_for(index, batch, ["ref_id"])
    months = found.select("year", "month").distinct().collect()  # a row per folder
    rows = header.filter(in_parts([partition_name(r.asDict().items()) for r in months]))
    return rows.filter(F.coalesce(~load_of().isin([record["load"] for record in loads]), F.lit(True)))


def _build_sales(
    spark, lake, header, detail, as_of, backfill_days, high_water_only, dedupe, mode, moved_within_months, quarantine
) -> DataFrame:
    """The first build, of a mart without a row, holds everything; later ones merge
    the increment. Either is checked before readers see it."""
    path = f"{lake.marts}/{SALES_TABLE}"
    schema = sales_lines(header, detail).schema
    checks = check_not_null(REQUIRED_SALES) + check_negative(sales_lines(header, detail), "net_revenue_inclusive")
    current = folders(spark, path)
    with scratch(spark, "recent") as recent_path, scratch(spark, "sales") as sales_path:
        if current:
            target = read_version(spark, path, schema, [max(current, key=_month_of)])  # holds the last day
            recent = lookback(header, as_of, backfill_days, partitions=_same_day(lake))
            # Stored tables have a known size, by which the joins pick their strategy.
            (latest_invoice(recent) if dedupe else recent).write.parquet(recent_path)
            recent = read_table(spark, recent_path, header.schema)
            detail = lines_landed_with(detail, recent) if dedupe else detail
            fresh = sales_increment(recent, detail, target, as_of, backfill_days, high_water_only, dedupe)
        else:
            fresh = sales_increment(header, detail, None, as_of, dedupe=dedupe)
        if quarantine:
            # one pass: a folder of rows that pass and one of those that are held back
            failing = with_failures(fresh, checks)
            failing.withColumn("held", F.size(FAILED) > 0).write.partitionBy("held").parquet(sales_path)
            both = spark.read.schema(failing.withColumn("held", F.lit(True)).schema).parquet(sales_path)
            fresh = both.filter("NOT held").select(*schema.names)
            _hold_back(spark, lake, both, schema)
            report = run_checks(both.select(*schema.names), [replace(c, level=WARN) for c in checks])
        elif not current:
            reports = []
            full_refresh(fresh, path, check=lambda rows: reports.extend(gate(run_checks(rows, checks)).collect()))
            return spark.createDataFrame(reports, REPORT_SCHEMA)
        else:
            fresh.write.parquet(sales_path)
            fresh = read_table(spark, sales_path, schema)
            report = gate(run_checks(fresh, checks))
        report = spark.createDataFrame(report.collect(), REPORT_SCHEMA)  # a row per check
        keys = SALES_KEY if mode == "unique" else SALES_KEY[:1]
        if not current:
            full_refresh(fresh, path)
        elif moved_within_months is None:
            merge_table(spark, path, fresh, keys, mode=mode, buckets=lake.buckets)
        else:
            first = as_of.year * 12 + as_of.month - 1 - moved_within_months
            merge_table(spark, path, fresh, keys, mode=mode, search=lambda part: _month_of(part) >= first)
        return report


def lines_landed_with(detail: DataFrame, header: DataFrame) -> DataFrame:
    """The lines of those loads and landed days that the invoices are of: only lines of the same landed
    copy join an invoice, and others need not be dealt out for that. Where there are very many, all lines."""
    if not (INGEST_COLUMN in header.columns and INGEST_COLUMN in detail.columns):
        return detail
    landed = F.substring_index(F.coalesce(INGEST_COLUMN, F.lit("")), "-", 2)
    found = [r[0] for r in header.select(landed).distinct().limit(_MOST_LANDED + 1).collect()]
    return detail.filter(landed.isin(found)) if len(found) <= _MOST_LANDED else detail


def _hold_back(spark: SparkSession, lake: Lake, both: DataFrame, schema: T.StructType) -> None:
    """Puts the rows held back into the quarantine table, in place of all earlier ones of the invoices built."""
    path = f"{lake.marts}/{SALES_TABLE}_quarantine"
    held = both.filter("held").drop("held")
    earlier = read_version(spark, path, held.schema)
    built = both.select("order_id").distinct()
    kept = earlier.join(built, earlier["order_id"].eqNullSafe(built["order_id"]), "left_anti")
    current = all_folders(spark, path) or {}
    replace_partitions(kept.unionByName(held), path, keep=lambda part: False, base=current, read=lambda part: True)


def _month_of(part: str) -> int:
    """Months since year 0 of a partition ``year=2024/month=1``; undated rows come first."""
    year, month = (p.split("=")[1] for p in part.split("/"))
    return int(year) * 12 + int(month) - 1 if year.isdigit() and month.isdigit() else -1


def _same_day(lake: Lake) -> tuple[str, ...]:
    """The partition columns of invoices if they are known to hold the local day of
    ``ref_date``: they do where invoices have no date field that goes before it."""
    spec = lake.specs["invoice_header"]
    own = next((landed for landed, name in spec.columns.items() if name == "ref_date"), None)
    return PARTITION_COLUMNS if own is not None and own == pick_date_column(spec.landing.names) else ()


def run_daily(
    spark: SparkSession, lake: Lake, day: str | list[str], run_ts: dt.datetime | None = None, backfill_days: int = 3, **options
) -> DataFrame:
    """Both loads, then the build. Returns the quality report. A repeated run
    appends to bronze again and leaves the marts as they were."""
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc)
    run_master(spark, lake, run_ts)
    run_transactions(spark, lake, day, run_ts)
    return build(spark, lake, local_day(run_ts), backfill_days, **options)


def backfill_days_list(as_of: dt.date, days: int = 7) -> list[str]:
    """The ``days`` days before ``as_of``, oldest first."""
    return [(as_of - dt.timedelta(days=n)).isoformat() for n in range(days, 0, -1)]


def backfill_range(
    spark: SparkSession,
    lake: Lake,
    as_of: dt.date,
    days: int = 7,
    run_ts: dt.datetime | None = None,
    only_changed: bool = False,
    **options,
) -> DataFrame:
    """Reloads the transactions of the last days and rebuilds the marts over them.
    With ``only_changed`` days that are in bronze as they have landed are not loaded
    again."""
    wanted = backfill_days_list(as_of, days)
    if only_changed:
        wanted = changed_days(spark, lake, wanted)
    if wanted:
        run_transactions(spark, lake, wanted, run_ts)
    return build(spark, lake, as_of, days, **{"high_water_only": False, **options})
