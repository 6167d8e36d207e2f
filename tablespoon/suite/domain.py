"""The test tables seen as restaurant data.

Orders and line items stand for invoices and their lines. Events, which have a
time of day, stand for landed orders whose fields come in every shape the
loaders must cope with; the event type says which shape a row gets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

# Ids differ from the data in case and blanks, and one name is empty on purpose.
BRANCH_MAP = {"signup": "Online", " Purchase": "Counter", "view": ""}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(col: str) -> Column:
    return F.col(col).cast("string")


def by_type(**values: Column | None) -> Column:
    """A value per event type; null for types not named."""
    chosen = F.lit(None).cast("string")
    for event_type, value in values.items():
        chosen = F.when(F.col("event_type") == event_type, value).otherwise(chosen)
    return chosen


def with_parts(df: DataFrame, column: str) -> DataFrame:
    """Stored-table partition columns for a time column."""
    return df.withColumns(
        {
            "report_date": F.date_format(column, "yyyy-MM-dd"),
            "year": F.year(column),
            "month": F.month(column),
            "day": F.dayofmonth(column),
        }
    )


def invoice_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze invoices: orders with their customer's nation as the branch."""
    status = F.when(F.col("o_orderstatus") == "P", 4).when(F.col("o_orderstatus") == "F", 3).otherwise(1)
    invoices = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            text("o_orderkey").alias("ref_id"),
            F.col("n_name").alias("branch_name"),
            F.concat(F.lit("INV-"), text("o_orderkey")).alias("ref_no"),
            text("o_custkey").alias("customer_id"),
            status.cast("bigint").alias("payment_status"),
            F.col("o_totalprice").alias("total_amount"),
            F.col("o_orderdate").alias("ref_date"),
        )
    )
    return with_parts(invoices, "ref_date")


def invoice_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze invoice lines, with nulls in the columns that marts must default."""
    price = F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        text("l_orderkey").alias("ref_id"),
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("ref_detail_id"),
        text("l_partkey").alias("item_id"),
        F.concat(F.lit("item "), text("l_partkey")).alias("item_name"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        price.alias("amount"),
        (price * F.col("l_discount")).alias("allocation_amount"),
        F.when(F.col("l_linestatus") == "F", 0.5).alias("allocation_delivery_promotion_amount"),
        F.when(F.col("l_returnflag") != "R", price * F.col("l_tax")).alias("tax_amount"),
        F.col("l_shipdate").alias("ref_date"),
    )


def order_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze orders."""
    return table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("order_id"),
        text("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderstatus").alias("order_status"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed order headers."""
    return table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("Id"),
        text("o_custkey").alias("CustomerId"),
        F.date_format("o_orderdate", ISO).alias("Date"),
        F.col("o_totalprice").alias("TotalAmount"),
        F.col("o_orderstatus").alias("Status"),
        F.col("o_orderpriority").alias("BranchId"),
    )


def raw_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed order lines, with a branch of their own that the order's must replace."""
    return table(spark, sf_dir, "lineitem").select(
        text("l_orderkey").alias("OrderId"),
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("Id"),
        text("l_partkey").alias("ItemId"),
        F.col("l_quantity").alias("Quantity"),
        F.col("l_extendedprice").alias("Amount"),
        F.col("l_returnflag").alias("BranchId"),
    )


def raw_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed invoice headers."""
    return table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("RefId"),
        text("o_custkey").alias("CustomerId"),
        F.date_format("o_orderdate", ISO).alias("RefDate"),
        F.date_format("o_orderdate", ISO).alias("CreatedDate"),
        text("o_totalprice").alias("TotalAmount"),
        F.when(F.col("o_orderstatus") == "P", "4").otherwise("1").alias("PaymentStatus"),
        F.col("o_orderpriority").alias("BranchId"),
        F.concat(F.lit("Store "), F.col("o_orderpriority")).alias("BranchName"),
    )


def raw_invoice_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed invoice lines."""
    return table(spark, sf_dir, "lineitem").select(
        text("l_orderkey").alias("RefID"),
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("RefDetailId"),
        text("l_partkey").alias("ItemID"),
        F.col("l_quantity").alias("Quantity"),
        F.col("l_extendedprice").alias("Amount"),
        F.lit("line").alias("BranchId"),
    )


def raw_invoice_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed payments, one per invoice."""
    return table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("RefID"),
        F.concat(F.lit("PAY-"), text("o_orderkey")).alias("SAInvoicePaymentID"),
        F.col("o_totalprice").alias("Amount"),
        F.col("o_orderpriority").alias("PaymentName"),
        F.lit(1).alias("PaymentType"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed products."""
    return table(spark, sf_dir, "part").select(
        text("p_partkey").alias("Id"),
        F.col("p_size").alias("Code"),
        F.col("p_name").alias("Name"),
        F.col("p_brand").alias("UnitName"),
        F.col("p_type").alias("CategoryName"),
        F.col("p_retailprice").alias("Price"),
        (F.col("p_size") > 25).alias("Inactive"),
    )


def product_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze products as of nine days, two of them after days without a load, all appended twice; prices
    go up every fourth day by the key, and some products are missing on some days."""
    days = F.explode(F.array(*[F.lit(n) for n in (1, 2, 3, 5, 6, 7, 8, 10, 11)]))
    rows = table(spark, sf_dir, "part").withColumn("day", days).filter((F.col("p_partkey") + F.col("day")) % 7 != 0)
    snapshots = rows.select(
        text("p_partkey").alias("product_id"),
        F.when(F.col("p_partkey") % 5 != 0, F.col("p_name")).alias("product_name"),
        (F.col("p_retailprice") + F.floor(F.col("day") / 4) * (F.col("p_partkey") % 3)).alias("price"),
        F.format_string("2024-01-%02d", "day").alias("report_date"),
    )
    return snapshots.unionByName(snapshots)


def quarterly_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze products as of the first day of 24 quarters from 1995 on; prices change at a pace of their own."""
    quarter = F.explode(F.sequence(F.lit(0), F.lit(23)))
    rows = table(spark, sf_dir, "part").withColumn("q", quarter).filter((F.col("p_partkey") + F.col("q")) % 9 != 0)
    return rows.select(
        text("p_partkey").alias("product_id"),
        (F.col("p_retailprice") + F.floor(F.col("q") / (1 + F.col("p_partkey") % 4))).alias("price"),
        F.add_months(F.lit("1995-01-01").cast("date"), F.col("q") * 3).cast("string").alias("report_date"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed customers; some have no phone."""
    return table(spark, sf_dir, "customer").select(
        text("c_custkey").alias("Id"),
        F.col("c_mktsegment").alias("Code"),
        F.col("c_name").alias("Name"),
        F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("+84"), text("c_custkey"))).alias("NormalizedTel"),
        F.concat(F.lit("Đường "), text("c_nationkey")).alias("Address"),
    )


def event_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed orders out of events, one spelling of date, number and branch per type."""
    utc, value, user = F.date_format("ts", ISO), text("value"), text("user_id")
    local = F.date_format(F.col("ts") + F.expr("interval 7 hours"), ISO)
    date = by_type(
        signup=F.concat(utc, F.lit("Z")),
        purchase=F.concat(local, F.lit("+07:00")),
        view=utc,
        click=F.date_format("ts", "yyyy-MM-dd"),
        error=F.date_format("ts", "dd/MM/yyyy"),
    )
    amount = by_type(signup=value, purchase=F.concat(F.lit(" "), value, F.lit(" ")), view=F.lit("abc"), error=F.lit("nan"))
    kind = by_type(
        signup=user,
        purchase=F.concat(user, F.lit(".7")),
        view=F.concat(F.lit("-"), user, F.lit(".7")),
        click=F.lit("1e3"),
        error=F.lit("inf"),
    )
    branch = by_type(signup=F.lit("SIGNUP"), purchase=F.lit("  purchase "), view=F.lit("view"), click=F.lit("click"))
    return table(spark, sf_dir, "events").select(
        text("event_id").alias("Id"),
        user.alias("CustomerId"),
        date.alias("Date"),
        amount.alias("TotalAmount"),
        kind.alias("Type"),
        branch.alias("BranchId"),
        F.when(F.col("value") >= 5, F.concat(F.lit("Store "), F.col("event_type"))).alias("BranchName"),
        F.lit(1.0).alias("No"),
    )


def event_invoices(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """Landed invoices out of events, well formed, each with its event's day; ``dealt`` out by that day,
    before times and ids become text."""
    day = F.date_format("ts", "yyyy-MM-dd").alias("utc_day")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", day)
    events = events.hint("rebalance", F.col("utc_day")).sortWithinPartitions("utc_day") if dealt else events
    return events.select(
        text("event_id").alias("RefId"),
        text("user_id").alias("CustomerId"),
        F.concat(F.date_format("ts", ISO), F.lit("Z")).alias("RefDate"),
        F.col("value").alias("TotalAmount"),
        F.when(F.col("event_type") == "error", 4).otherwise(1).alias("PaymentStatus"),
        F.col("event_type").alias("BranchId"),
        "utc_day",
    )


def event_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stored table, partitioned by day."""
    rows = table(spark, sf_dir, "events").select(
        text("event_id").alias("ref_id"), F.col("event_type").alias("branch_name"), F.col("value").alias("total_amount"), "ts"
    )
    return with_parts(rows, "ts").drop("report_date", "ts")
