import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablespoon.operators.incremental import gap_days, lookback, since_high_water, upsert
from tablespoon.plans.marts import build_incremental, sales_increment
from tablespoon.sinks import full_refresh, merge_table, read_version
from tests.test_marts import detail, header

D = dt.date


def test_lookback_bounds(spark):
    rows = [(1, dt.datetime(2024, 1, 16, 23, 59)), (2, dt.datetime(2024, 1, 17)), (3, dt.datetime(2024, 1, 20)), (4, None)]
    df = spark.createDataFrame(rows, "i int, ref_date timestamp_ntz")
    assert sorted(r["i"] for r in lookback(df, D(2024, 1, 20)).collect()) == [2, 3]
    assert sorted(r["i"] for r in lookback(df, D(2024, 1, 20), 4).collect()) == [1, 2, 3]


def test_high_water(spark):
    df = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02"), ("c", "2024-01-03"), ("d", None)], "i string, report_date string")
    target = df.filter("i <= 'b'")
    assert sorted(r["i"] for r in since_high_water(df, target).collect()) == ["b", "c"]
    assert since_high_water(df, df.limit(0)).count() == 0


def test_upsert(spark):
    target = spark.createDataFrame([("1", "x", 1), ("1", "y", 1), ("2", "x", 1), (None, "x", 1)], "o string, i string, v int")
    source = spark.createDataFrame([(2, "x", "1"), (2, "z", "3"), (2, "x", None)], "v int, i string, o string")
    out = upsert(target, source, ["o", "i"])
    expected = [("1", "x", 2), ("1", "y", 1), ("2", "x", 1), ("3", "z", 2), (None, "x", 1), (None, "x", 2)]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(expected, key=str)
    again = upsert(out.filter("o IS NOT NULL"), source.filter("o IS NOT NULL"), ["o", "i"])
    assert sorted(map(tuple, again.collect())) == sorted(e for e in expected if e[0])


def test_ambiguous_source_is_refused(spark):
    target = spark.createDataFrame([("1", 1), ("2", 1)], "o string, v int")
    source = spark.createDataFrame([("1", 2), ("1", 3)], "o string, v int")
    with pytest.raises(Exception, match="not unique"):
        upsert(target, source, ["o"]).collect()
    assert sorted(map(tuple, upsert(target, source, ["o"], mode="replace").collect())) == [("1", 2), ("1", 3), ("2", 1)]
    with pytest.raises(ValueError):
        upsert(target, source, ["o"], mode="other")


def test_gaps(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, d, 5),) for d in (1, 1, 3, 6)] + [(None,)], "t timestamp_ntz")
    days = lambda **kw: sorted(r["gap_day"].day for r in gap_days(df, "t", **kw).collect())
    assert days() == [2, 4, 5]
    assert days(start=D(2024, 1, 3), end=D(2024, 1, 8)) == [4, 5, 7, 8]
    assert gap_days(df.limit(0), "t").count() == 0
    assert gap_days(df.limit(0), "t", D(2024, 1, 1), D(2024, 1, 2)).count() == 2


def build(spark, target, high_water_only=True, days=3):
    headers = header(spark, *[(str(d), 1, 1.0, d) for d in range(1, 11)])
    lines = detail(spark, *[(str(d), f"l{d}", "x", 100.0 + d, 0.0, 0.0, 0.0) for d in range(1, 11)])
    return sales_increment(headers, lines, target, D(2024, 1, 10), days, high_water_only)


def test_increment(spark):
    whole = build(spark, None)
    assert whole.count() == 10  # first run: neither lookback nor high-water mark
    target = whole.filter("day <= 8")
    assert sorted(r["day"] for r in build(spark, target).collect()) == [8, 9, 10]
    assert sorted(r["day"] for r in build(spark, target, days=1).collect()) == [9, 10]
    # The mark cancels a longer lookback unless it is switched off.
    assert sorted(r["day"] for r in build(spark, target, days=7).collect()) == [8, 9, 10]
    assert sorted(r["day"] for r in build(spark, target, False, 7).collect()) == list(range(3, 11))
    assert build(spark, whole.limit(0)).count() == 0


def test_incremental_build_keeps_older_rows(spark):
    headers = header(spark, ("1", 1, 1.0, 1), ("2", 1, 1.0, 9))
    lines = detail(spark, ("1", "a", "x", 1.0, 0.0, 0.0, 0.0), ("2", "b", "x", 2.0, 0.0, 0.0, 0.0))
    target = build_incremental(headers.filter("day = 1"), lines, None, D(2024, 1, 2))
    out = build_incremental(headers, lines, target, D(2024, 1, 10))
    assert sorted(r["order_id"] for r in out.collect()) == ["1", "2"]


def table(spark, *rows):
    return spark.createDataFrame(list(rows), "o string, v int, year int, month int")


def stored(spark, path):
    return sorted(map(tuple, read_version(spark, path).select("o", "v", "year", "month").collect()))


def test_merge_rewrites_only_what_it_must(spark, tmp_path):
    path, staged = f"{tmp_path}/t", f"{tmp_path}/s"
    full_refresh(table(spark, ("a", 1, 2024, 1), ("b", 1, 2024, 1), ("c", 1, 2024, 2), ("d", 1, 2024, 3), ("e", 1, 2024, 4)), path)
    untouched = {str(p) for p in tmp_path.glob("t/*/in_year=2024/in_month=4/*.parquet")}
    # a changes in place, c is the only row of its month and moves, f is new.
    table(spark, ("a", 2, 2024, 1), ("c", 2, 2024, 3), ("f", 2, 2025, 1)).write.parquet(staged)
    for _ in range(2):  # merged twice is merged once
        merge_table(spark, path, spark.read.parquet(staged), ["o"])
        assert stored(spark, path) == [
            ("a", 2, 2024, 1), ("b", 1, 2024, 1), ("c", 2, 2024, 3), ("d", 1, 2024, 3), ("e", 1, 2024, 4), ("f", 2, 2025, 1),
        ]
    assert {str(p) for p in tmp_path.glob("t/*/in_year=2024/in_month=4/*.parquet")} == untouched != set()


def test_merge_of_nothing(spark, tmp_path):
    path = f"{tmp_path}/t"
    full_refresh(table(spark, ("a", 1, 2024, 1)), path)
    merge_table(spark, path, read_version(spark, path).limit(0), ["o"])
    assert stored(spark, path) == [("a", 1, 2024, 1)]


def test_merge_refuses_ambiguous_source_and_leaves_the_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    full_refresh(table(spark, ("a", 1, 2024, 1)), path)
    with pytest.raises(Exception, match="not unique"):
        merge_table(spark, path, table(spark, ("a", 2, 2024, 1), ("a", 3, 2024, 1)), ["o"])
    assert stored(spark, path) == [("a", 1, 2024, 1)]


def test_null_partition_is_merged_too(spark, tmp_path):
    path = f"{tmp_path}/t"
    full_refresh(table(spark, ("a", 1, None, None), ("b", 1, 2024, 1)), path)
    merge_table(spark, path, table(spark, ("a", 2, 2024, 1)), ["o"])
    assert sorted(r["o"] for r in read_version(spark, path).filter(F.col("v") == 2).collect()) == ["a"]
    assert read_version(spark, path).count() == 2


def test_merge_searches_the_months_it_is_told(spark, tmp_path):
    path = f"{tmp_path}/t"
    full_refresh(table(spark, ("a", 1, 2023, 1), ("b", 1, 2024, 1)), path)
    merge_table(spark, path, table(spark, ("b", 2, 2024, 2)), ["o"], search=lambda part: part >= "year=2024")
    assert stored(spark, path) == [("a", 1, 2023, 1), ("b", 2, 2024, 2)]


def test_merge_into_a_table_without_rows(spark, tmp_path):
    path = f"{tmp_path}/t"
    merge_table(spark, path, table(spark, ("a", 1, 2024, 1)), ["o"])
    assert stored(spark, path) == [("a", 1, 2024, 1)]
    with pytest.raises(Exception, match="not unique"):
        merge_table(spark, f"{tmp_path}/u", table(spark, ("a", 1, 2024, 1), ("a", 1, 2024, 1)), ["o"])
