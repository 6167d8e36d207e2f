"""Marts: daily revenue and the line-level sales table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablespoon.functions import hour_bucket, net_revenue, revenue_inclusive
from tablespoon.operators.dedup import latest_by
from tablespoon.operators.incremental import lookback, since_high_water, upsert
from tablespoon.plans.staging import invoice_rank, latest_invoice, latest_invoice_detail
from tablespoon.schemas import INGEST_COLUMN

# The status that keeps an invoice out of the sales table, the
# merge key, and the name the table is published under.
EXCLUDED_STATUS = 4
SALES_KEY = ["order_id", "item_id"]
SALES_TABLE = "view_master_sales_analytics"
REVENUE_TABLE = "revenue_daily"

_REVENUE_KEY = ["report_date", "branch_name", "year", "month"]
_HEADER_COLUMNS = ["ref_id", "branch_name", "ref_no", "customer_id", "ref_date", "day", "month", "year"]


_READ = {*_REVENUE_KEY, *_HEADER_COLUMNS, "payment_status", "total_amount", INGEST_COLUMN}


def mart_header(header: DataFrame) -> DataFrame:
    """What the marts read of invoices. Ranking copies sorts rows with all columns that tell
    ties apart, so both marts leave the others out before they rank, and pick the same copy."""
    return header.select(*[c for c in header.columns if c in _READ])


def revenue_daily(header: DataFrame, dedupe: bool = False) -> DataFrame:
    """Orders, revenue and average order value per day and branch.

    Copies of an invoice add to the revenue but not to the order count; with
    ``dedupe`` only the latest copy counts. The distinct count is aggregated by
    (day, branch, invoice) first, so one very large day spreads over all tasks.
    """
    if dedupe:
        header = latest_invoice(mart_header(header))
    orders, revenue = F.count_distinct("ref_id"), F.sum("total_amount")
    sums = header.filter(F.col("total_amount") > 0).groupBy(*_REVENUE_KEY)
    return _with_average(sums.agg(orders.alias("total_orders"), revenue.alias("total_revenue")))


def _with_average(sums: DataFrame) -> DataFrame:
    average = F.when(F.col("total_orders") > 0, F.col("total_revenue") / F.col("total_orders")).otherwise(0.0)
    return sums.withColumn("aov", average)


def revenue_deltas(batch: DataFrame, earlier: DataFrame) -> DataFrame:
    """What a batch of invoices changes in the deduplicated daily revenue: signed
    orders and revenue per day and branch.

    ``earlier`` are the copies, counted before, of the batch's invoices; copies of
    other invoices do no harm. An invoice whose latest copy is now another one
    takes back what the old one added; one that stays as it was changes nothing,
    so a batch that lands again gives no row.

    Either side is dealt out once, by a key that is never null: what selects the
    earlier copies, what reduces each side to its latest and what compares the two
    all find the rows where they are.
    """
    group = lambda copy: F.when(F.col(copy).isNotNull(), F.struct(*[F.col(copy)[c].alias(c) for c in (*_REVENUE_KEY, "total_amount")]))
    key = F.coalesce(F.concat(F.lit("="), "ref_id"), F.lit(""))
    copies = lambda df: df.select(key.alias("_key"), invoice_rank(df).alias("_copy"))
    latest = lambda rows, name: rows.groupBy("_key").agg(F.max("_copy").alias(name))
    landed = copies(batch.select(earlier.columns))
    known = copies(earlier).join(landed.select("_key").distinct(), "_key", "left_semi")
    both = latest(landed, "_landed").join(latest(known, "_before"), "_key", "left").withColumn("_after", F.greatest("_landed", "_before"))
    changed = both.select("_key", group("_before").alias("_old"), group("_after").alias("_new")).filter(~F.col("_new").eqNullSafe(F.col("_old")))
    signed = F.array(F.struct(F.lit(1).alias("sign"), F.col("_new").alias("of")), F.struct(F.lit(-1).alias("sign"), F.col("_old").alias("of")))
    rows = changed.select("_key", F.explode(signed).alias("_row")).select("_key", "_row.sign", "_row.of.*")
    counted = F.sum(F.when(F.col("_key") != "", F.col("sign")).otherwise(0))
    return (
        rows.filter(F.col("total_amount") > 0)
        .groupBy(*_REVENUE_KEY)
        .agg(counted.alias("total_orders"), F.sum(F.col("sign") * F.col("total_amount")).alias("total_revenue"))
    )


def apply_deltas(revenue: DataFrame, deltas: DataFrame) -> DataFrame:
    """Daily revenue after signed changes; days and branches that nothing is left of are gone."""
    columns = [*_REVENUE_KEY, "total_orders", "total_revenue"]
    both = revenue.select(*columns).unionByName(deltas.select(*columns))
    sums = both.groupBy(*_REVENUE_KEY).agg(F.sum("total_orders").alias("total_orders"), F.sum("total_revenue").alias("total_revenue"))
    # what is taken back differs from what was added by the rounding of sums at most
    left = sums.filter((F.col("total_orders") != 0) | (F.round("total_revenue", 6) != 0))
    return _with_average(left)


def revenue_of_months(header: DataFrame, months: DataFrame) -> DataFrame:
    """Daily revenue, copies included, of the given (year, month) rows alone."""
    return revenue_daily(header.join(months.select("year", "month"), ["year", "month"], "left_semi"))


def sales_lines(
    header: DataFrame, detail: DataFrame, dedupe: bool = False, bucketed: bool = False, few_copies: bool = False
) -> DataFrame:
    """Invoice lines with their invoice, except excluded ones, one row per line.

    Copies on either side multiply; with ``dedupe`` only the latest copies join:
    the latest header of an invoice and, where rows say which landed copy they are
    of, the lines of that same copy, so that a line withdrawn by a correction is
    gone. Without that mark each line's own latest copy joins.

    The join has a second key. After deduplication a side is dealt out by another
    key or by a rank, which the adaptive planner can't split; the second key makes
    it deal both out anew for the join, and then it splits hot invoices. Marked
    lines are dealt out once: repeats within a copy are told apart where the join
    has put them. So are unmarked ones where the caller knows of ``few_copies`` of a
    line: each goes through the join, which moves less than dealing them out for
    their rank and the latest again.

    ``bucketed`` says that both tables are stored in as many buckets by ``ref_id``:
    then nothing is dealt out, neither for ranks nor for the join, and a bucket with
    a hot invoice isn't split.
    """
    marked = dedupe and INGEST_COLUMN in header.columns and INGEST_COLUMN in detail.columns
    if dedupe:
        header = latest_invoice(mart_header(header))
    late = marked or (dedupe and few_copies and not bucketed and INGEST_COLUMN not in detail.columns)
    if dedupe and not late:
        detail = latest_invoice_detail(detail, bucketed)
    # without a mark any value that goes with the invoice will do; lengths compress where hashes don't
    copy = F.coalesce(INGEST_COLUMN, F.lit("")) if marked else F.length("ref_id")
    second = [copy.alias("_copy")] if marked or (dedupe and not bucketed) else []
    kept = header.filter(F.col("payment_status") != EXCLUDED_STATUS).select(*_HEADER_COLUMNS, *second)
    parts = ["amount", "allocation_amount", "allocation_delivery_promotion_amount"]
    net = net_revenue(*[F.col(c) for c in parts])
    lines = detail.select(
        "ref_id",
        "item_id",
        "item_name",
        "quantity",
        *(parts if late else [net.alias("_net")]),  # lines still to be ranked are told apart by the parts
        F.col("tax_amount").alias("line_tax"),
        *second,
        *([F.col("ref_detail_id").alias("_line"), F.col("ref_date").alias("_line_date")] if late else []),
    )
    if marked and bucketed:  # the copies are compared by a range: equal ones would be a second key
        kept = kept.withColumnsRenamed({"ref_id": "_ref_id", "_copy": "_latest"})
        same = (F.col("ref_id") == F.col("_ref_id")) & F.col("_copy").between(F.col("_latest"), F.col("_latest"))
        joined = lines.join(kept, same).drop("_ref_id", "_latest")
    else:
        joined = lines.join(kept, ["ref_id", "_copy"] if second else "ref_id", "inner")
    if late:
        joined = latest_by(joined, ["ref_id", "_copy", "_line"], ["_line_date"]).withColumn("_net", net)
    return joined.select(
        "branch_name",
        F.col("ref_id").alias("order_id"),
        F.col("ref_no").alias("invoice_code"),
        "customer_id",
        "item_name",
        "item_id",
        "ref_date",
        F.to_date("ref_date").alias("report_date"),
        hour_bucket(F.col("ref_date")).alias("report_hour"),
        "day",
        "month",
        "year",
        "quantity",
        F.col("_net").alias("net_revenue_pre_tax"),
        F.coalesce("line_tax", F.lit(0.0)).alias("tax_amount"),
        revenue_inclusive(F.col("_net"), F.col("line_tax")).alias("net_revenue_inclusive"),
    )


def sales_increment(
    header: DataFrame,
    detail: DataFrame,
    target: DataFrame | None,
    as_of: dt.date,
    backfill_days: int = 3,
    high_water_only: bool = True,
    dedupe: bool = False,
) -> DataFrame:
    """Sales lines that a run adds. Without a target that is everything; with one,
    invoices of the lookback window, and of these the days from the target's
    last day on. ``high_water_only=False`` keeps the whole window, which is what
    a repair of older days needs."""
    if target is None:
        return sales_lines(header, detail, dedupe)
    recent = lookback(header, as_of, backfill_days)
    if dedupe:  # only lines of these invoices need to be ranked
        detail = detail.join(recent.select("ref_id"), "ref_id", "left_semi")
    fresh = sales_lines(recent, detail, dedupe)
    return since_high_water(fresh, target) if high_water_only else fresh


def build_incremental(
    header: DataFrame,
    detail: DataFrame,
    target: DataFrame | None,
    as_of: dt.date,
    backfill_days: int = 3,
    high_water_only: bool = True,
    dedupe: bool = False,
    keys: list[str] = SALES_KEY,
    mode: str = "unique",
) -> DataFrame:
    """The sales table after a run: the increment upserted into the target."""
    fresh = sales_increment(header, detail, target, as_of, backfill_days, high_water_only, dedupe)
    return fresh if target is None else upsert(target, fresh, keys, mode)
