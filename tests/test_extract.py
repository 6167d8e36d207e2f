import datetime as dt

from pyspark.sql import functions as F

from tablespoon.operators.extract import (
    ALL_BRANCHES,
    INVOICE_DATE_FIELDS,
    ORDER_DATE_FIELDS,
    accepted_pages,
    branch_scope,
    cutoff_filter,
)
from tablespoon.plans.extract import extract_orders, first_branch

END = dt.datetime(2024, 1, 21)


def kept(spark, rows, fields, end):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ", ".join(f"{f} string" for f in fields))
    return sorted(r["i"] for r in cutoff_filter(df, fields, end).collect())


def test_orders_before_the_cutoff(spark):
    rows = [("2024-01-20T23:59:59Z",), ("2024-01-21T00:00:00Z",), ("2024-01-21T06:00:00+07:00",), (None,), ("bad",), ("",)]
    assert kept(spark, rows, ORDER_DATE_FIELDS, END) == [0, 2, 3, 4, 5]
    zoned = dt.datetime(2024, 1, 21, 7, tzinfo=dt.timezone(dt.timedelta(hours=7)))
    assert kept(spark, rows, ORDER_DATE_FIELDS, zoned) == [0, 2, 3, 4, 5]
    assert len(kept(spark, rows, ORDER_DATE_FIELDS, None)) == 6


def test_invoices_use_the_creation_date_when_there_is_no_other(spark):
    late, early = "2024-02-01", "2024-01-01"
    rows = [(early, late), (late, early), (None, late), ("", late), (None, early), ("bad", late), (None, None)]
    assert kept(spark, rows, INVOICE_DATE_FIELDS, END) == [0, 4, 5, 6]


def test_branch_scope(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "BranchId string")
    assert branch_scope(df, "a").count() == 1
    assert branch_scope(df, "").count() == branch_scope(df, None).count() == branch_scope(df, ALL_BRANCHES).count() == 3
    assert first_branch({"x": "X", "y": "Y"}) == "x" and first_branch({}) == "" and first_branch(None) == ""


def test_failed_pages_add_nothing(spark):
    pages = spark.sql(
        """SELECT * FROM VALUES (true, array(named_struct('Id', 1))), (false, array(named_struct('Id', 2))),
           (null, array(named_struct('Id', 3))), (true, array()), (true, null) AS t(Success, Data)"""
    )
    assert [r["Id"] for r in accepted_pages(pages).collect()] == [1]


def test_order_without_payload_has_no_lines(spark):
    headers = spark.createDataFrame([("1", "2024-01-20", "b"), ("2", "2024-01-20", "b")], "Id string, Date string, BranchId string")
    payloads = spark.createDataFrame([("1", '[{"Id": "l", "BranchId": "own"}]')], "Id string, Data string")
    rows = {r["Id"]: r["line_items"] for r in extract_orders(headers, payloads).collect()}
    assert rows["2"] == [] and (rows["1"][0]["OrderId"], rows["1"][0]["BranchId"]) == ("1", "b")
    assert extract_orders(headers, payloads).select(F.size("line_items")).count() == 2
