import datetime as dt
import hashlib

from pyspark.sql import functions as F

from tablespoon.operators.dedup import latest_by
from tablespoon.plans import marts, staging

D = dt.datetime


def test_latest_copy_with_ties_and_nulls(spark):
    rows = [
        ("o1", D(2024, 1, 1), 1), ("o1", D(2024, 1, 2), 2), ("o1", D(2024, 1, 2), 3), ("o1", None, 9),
        ("o2", None, 1), (None, D(2024, 1, 1), 5), (None, D(2024, 1, 3), 4),
    ]
    df = spark.createDataFrame(rows, "order_id string, order_date timestamp_ntz, n int")
    for copy in (df, df.repartition(7), df.orderBy("n"), df.orderBy(F.desc("n"))):
        out = {r["order_id"]: (r["n"], r["row_num"]) for r in staging.stg_order_header(copy).collect()}
        assert out == {"o1": (3, 1), "o2": (1, 1), None: (4, 1)}
    assert latest_by(df, ["order_id"], ["order_date"]).columns == df.columns


def test_largest_rank_is_the_latest_copy(spark):
    """Whatever tells copies apart: the day they landed, the load, the date, the mark, the other columns; nulls are the least."""
    marks = ["1-20240102-a", "2-20240101-b", "1-20240102-b", "3", None]
    rows = [
        (key, mark, date, amount)
        for key, n_marks in (("1", 5), ("2", 2), ("3", 0), (None, 4), ("", 1))
        for mark in [*marks[:n_marks], None]
        for date in (None, D(2024, 1, 1), D(2024, 1, 2))
        for amount in (None, 1.0, float("nan"), -2.0)
    ]
    df = spark.createDataFrame(rows, "ref_id string, ingest_id string, ref_date timestamp_ntz, total_amount double").repartition(5)
    ranked = df.groupBy("ref_id").agg(F.max(staging.invoice_rank(df)).alias("c")).select("ref_id", *[f"c.{c}" for c in df.columns[1:]])
    assert sorted(map(str, ranked.collect())) == sorted(map(str, staging.latest_invoice(df).collect())) != []
    plain = df.drop("ingest_id")
    ranked = plain.groupBy("ref_id").agg(F.max(staging.invoice_rank(plain)).alias("c")).select("ref_id", "c.ref_date", "c.total_amount")
    assert sorted(map(str, ranked.collect())) == sorted(map(str, staging.latest_invoice(plain).collect()))


def test_order_lines_and_masters(spark):
    lines = spark.createDataFrame([("d", D(2024, 1, 1)), ("d", D(2024, 1, 2))], "order_detail_id string, order_date timestamp_ntz")
    assert staging.stg_order_detail(lines).first()["order_date"] == D(2024, 1, 2)
    products = spark.createDataFrame([("p", "2024-01-01"), ("p", "2024-01-02")], "product_id string, report_date string")
    assert [r["report_date"] for r in staging.latest_master(products, "product_id").collect()] == ["2024-01-02"]


def test_customer_hashes(spark):
    schema = "customer_id string, customer_code string, customer_name string, customer_tel string, address string, report_date string"
    df = spark.createDataFrame([("1", "c", "Nguyễn", None, "street", "d")], schema)
    row = staging.stg_customer(df).first()
    assert row["customer_name_hashed"] == hashlib.md5("Nguyễn".encode()).hexdigest().upper()
    assert row["customer_tel_hashed"] is None and row["address"] == "street"


HEADER = """ref_id string, branch_name string, ref_no string, customer_id string, payment_status bigint,
    total_amount double, ref_date timestamp_ntz, report_date string, year int, month int, day int"""
DETAIL = """ref_id string, ref_detail_id string, item_id string, item_name string, quantity bigint, amount double,
    allocation_amount double, allocation_delivery_promotion_amount double, tax_amount double, ref_date timestamp_ntz"""


def header(spark, *rows):
    """rows: (ref_id, status, total, day)"""
    full = [(r, "b", f"no-{r}", "c", s, t, D(2024, 1, d, 7), f"2024-01-{d:02}", 2024, 1, d) for r, s, t, d in rows]
    return spark.createDataFrame(full, HEADER)


def detail(spark, *rows):
    """rows: (ref_id, line, item, amount, allocation, delivery, tax)"""
    full = [(r, l, i, i, 1, a, al, de, tx, D(2024, 1, 1)) for r, l, i, a, al, de, tx in rows]
    return spark.createDataFrame(full, DETAIL)


def test_revenue(spark):
    df = header(
        spark, ("1", 1, 10.0, 1), ("1", 1, 10.0, 1), ("2", 4, 20.0, 1), ("3", 1, 0.0, 1), ("4", 1, -5.0, 1), ("5", 1, None, 1),
        (None, 1, 7.0, 2),
    )
    out = {r["report_date"]: (r["total_orders"], r["total_revenue"], r["aov"]) for r in marts.revenue_daily(df).collect()}
    # Copies add revenue but no order; a day without any id has no average.
    assert out == {"2024-01-01": (2, 40.0, 20.0), "2024-01-02": (0, 7.0, 0.0)}
    once = {r["report_date"]: r["total_revenue"] for r in marts.revenue_daily(df, dedupe=True).collect()}
    assert once["2024-01-01"] == 30.0


def test_sales(spark):
    headers = header(spark, ("1", 1, 1.0, 1), ("2", 4, 1.0, 1), ("3", 0, 1.0, 1), ("4", None, 1.0, 1))
    lines = detail(
        spark, ("1", "a", "x", 100.0, 10.0, 5.0, 8.5), ("1", "b", "x", 50.0, None, None, None), ("2", "c", "x", 1.0, 0.0, 0.0, 0.0),
        ("3", "d", "y", None, 1.0, 1.0, 1.0), ("4", "e", "y", 1.0, 0.0, 0.0, 0.0), ("9", "f", "y", 1.0, 0.0, 0.0, 0.0),
    )
    rows = marts.sales_lines(headers, lines).collect()
    got = {(r["order_id"], r["item_name"], r["net_revenue_pre_tax"], r["tax_amount"], r["net_revenue_inclusive"]) for r in rows}
    assert got == {("1", "x", 85.0, 8.5, 93.5), ("1", "x", 50.0, 0.0, 50.0), ("3", "y", None, 1.0, None)}
    assert rows[0]["report_date"] == dt.date(2024, 1, 1) and rows[0]["report_hour"] == "07"
    assert len(rows[0]) == 16


def test_copies_multiply_unless_deduplicated(spark):
    headers = header(spark, ("1", 1, 1.0, 1), ("1", 1, 1.0, 2))
    lines = detail(spark, ("1", "a", "x", 1.0, 0.0, 0.0, 0.0), ("1", "a", "x", 1.0, 0.0, 0.0, 0.0), ("1", "b", "x", 2.0, 0.0, 0.0, 0.0))
    assert marts.sales_lines(headers, lines).count() == 6
    latest = marts.sales_lines(headers, lines, dedupe=True).collect()
    assert sorted(r["net_revenue_pre_tax"] for r in latest) == [1.0, 2.0] and {r["day"] for r in latest} == {2}


def test_lines_with_few_copies_are_those_ranked_first(spark):
    """Ties go by the columns in their order, also where an earlier one says otherwise than the worth."""
    headers = header(spark, ("1", 1, 1.0, 1), ("1", 1, 1.0, 2), ("2", 1, 1.0, 2), ("2", 4, 1.0, 3), ("3", 1, 1.0, 1), (None, 1, 1.0, 1))
    lines = detail(
        spark, ("1", "a", "x", 9.0, 8.0, 0.0, 0.0), ("1", "a", "x", 8.0, None, None, None), ("1", "a", "w", 99.0, 0.0, 0.0, 0.0),
        ("1", "b", "x", None, 1.0, 1.0, 2.0), ("1", "b", "x", 3.0, None, 0.5, None), ("1", None, "y", 1.0, 0.0, 0.0, 1.0),
        ("1", None, "y", 1.0, 0.0, 0.0, 2.0), ("2", "c", "x", 1.0, 0.0, 0.0, 0.0), ("3", "a", "x", 7.0, 0.0, 0.0, 0.0),
        (None, "a", "x", 5.0, 0.0, 0.0, 0.0),
    )
    later = lines.filter("ref_id = '3'").withColumns({"ref_date": F.lit(D(2024, 1, 2)), "amount": F.lit(6.0)})
    undated = lines.filter("ref_id = '3'").withColumns({"ref_date": F.lit(None).cast("timestamp_ntz"), "amount": F.lit(70.0)})
    lines = lines.unionByName(later).unionByName(undated)
    first, few = (marts.sales_lines(headers, lines, dedupe=True, few_copies=f) for f in (False, True))
    got = sorted((r["order_id"], r["item_id"], r["day"], r["net_revenue_pre_tax"], r["net_revenue_inclusive"]) for r in few.collect())
    assert got == [("1", "x", 2, 1.0, 1.0), ("1", "x", 2, 2.5, 2.5), ("1", "y", 2, 1.0, 3.0), ("3", "x", 1, 6.0, 6.0)]
    assert first.columns == few.columns and first.exceptAll(few).isEmpty() and few.exceptAll(first).isEmpty()
    marked = lines.withColumn("ingest_id", F.lit("1-20240101-a"))  # of the lines alone: their marks go first
    marked = marked.unionByName(later.withColumns({"amount": F.lit(4.0), "ingest_id": F.lit("2-20240102-b")}))
    assert marts.sales_lines(headers, marked, dedupe=True, few_copies=True).filter("order_id = '3'").first()["net_revenue_pre_tax"] == 4.0
