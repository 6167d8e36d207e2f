import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablespoon.operators import quality as q


def report(df):
    return {r["check_name"]: (r["level"], r["violations"], r["passed"]) for r in df.collect()}


def orders(spark, *rows):
    return spark.createDataFrame(list(rows), "order_id string, total_amount double")


def test_key_is_the_first_candidate_present(spark):
    df = spark.createDataFrame([("r", None), ("", "d"), (None, "d")], "ref_id string, ref_detail_id string")
    assert report(q.run_checks(df, q.check_key(df))) == {"key_present:ref_id": ("error", 2, False)}
    assert q.check_key(df.select(F.lit(1).alias("other"))) == []
    numbers = spark.createDataFrame([(1,), (None,)], "id int")
    assert report(q.run_checks(numbers, q.check_key(numbers))) == {"key_present:id": ("error", 1, False)}


def test_counts_matter_for_headers_only(spark):
    three, two = spark.range(3), spark.range(2)
    assert report(q.check_counts(three, two, "order_header")) == {"row_count:order_header": ("error", 1, False)}
    assert report(q.check_counts(two, three, "invoice_header")) == {"row_count:invoice_header": ("error", 1, False)}
    assert report(q.check_counts(two, two, "order_header"))["row_count:order_header"][2]
    assert report(q.check_counts(three, two, "order_detail")) == {}
    assert report(q.check_counts(three.limit(0), three.limit(0), "order_header"))["row_count:order_header"][1] == 0


def test_verdict(spark):
    good = orders(spark, ("1", 1.0), ("2", -1.0))  # a negative total is only worth a warning
    bad = orders(spark, ("1", 1.0), (None, 2.0))
    verdict = lambda raw, out, table: q.summarize(q.verify_table(raw, out, table)).first()["verdict"]
    assert verdict(good, good, "order_header") is True
    assert verdict(bad, bad, "order_header") is False
    assert verdict(good, bad.limit(1), "order_header") is False
    assert verdict(good, bad.limit(1), "order_detail") is True
    unkeyed = good.select(F.lit(1).alias("x"))
    assert verdict(unkeyed, unkeyed, "other") is True


def test_mart_checks(spark):
    schema = "order_id string, net_revenue_inclusive double, order_date timestamp_ntz"
    rows = [("1", 0.0, dt.datetime(2024, 1, 20)), (None, -0.5, dt.datetime(2024, 1, 20, 0, 0, 1)), ("3", None, None)]
    df = spark.createDataFrame(rows, schema)
    checks = (
        q.check_not_null(["order_id", "net_revenue_inclusive"])
        + q.check_negative(df, "net_revenue_inclusive")
        + q.check_future("order_date", dt.date(2024, 1, 20))
        + q.check_negative(df, "absent")
    )
    expected = {
        "not_null:order_id": ("error", 1, False), "not_null:net_revenue_inclusive": ("error", 1, False),
        "not_negative:net_revenue_inclusive": ("error", 1, False), "not_future:order_date": ("error", 1, False),
    }
    assert report(q.run_checks(df, checks)) == expected
    assert all(passed for _, _, passed in report(q.run_checks(df.limit(0), checks)).values())


def test_gate(spark):
    df = orders(spark, ("1", -1.0))
    warned = q.verify_table(df, df, "order_header")
    assert q.gate(warned) is warned
    assert [r["check_name"] for r in q.violations(warned).collect()] == ["not_negative:total_amount"]
    with pytest.raises(q.QualityError, match="key_present:order_id: 1 rows"):
        q.gate(q.verify_table(df, orders(spark, ("", 1.0)), "order_header"))


def test_profile(spark):
    row = q.nonnull_profile(orders(spark, ("1", 1.0), (None, 2.0)), ["order_id", "total_amount"]).first()
    assert row.asDict() == {"n_rows": 2, "order_id_nonnull": 1, "total_amount_nonnull": 2}
