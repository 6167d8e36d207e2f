import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tablespoon.operators import incremental
from tablespoon.operators.history import asof_join, expand_history, extend_history, master_history

DAY = dt.date(2024, 1, 1)
SCHEMA = "k string, v string, w int, report_date string, ingest_id string"


def on(n):
    return DAY + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def snapshots():
    """Keys that come, go, change, change back and hold nulls, on days with holes."""
    draw, rows = random.Random(4), []
    for key in ["a", "b", "c", None, "d"]:
        state = ("x", 1)
        for n in (0, 1, 2, 5, 6, 9, 10, 11):
            if draw.random() < 0.4:
                state = (draw.choice(["x", "y", None]), draw.choice([1, None]))
            if draw.random() < 0.75:
                rows.append((key, *state, on(n).isoformat(), None))
    return rows + [("late", "x", 1, on(11).isoformat(), None), ("a", "x", 1, None, None), ("once", "x", 1, on(5).isoformat(), None)]


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_expanding_the_history_gives_the_snapshots_back(spark, snapshots):
    df = spark.createDataFrame(snapshots, SCHEMA)
    history = master_history(df, ["k"], ["v", "w"])
    days = df.select(F.to_date("report_date").alias("day")).filter("day IS NOT NULL")
    back = expand_history(history, days).withColumn("report_date", F.col("day").cast("string"))
    assert rows_of(back.select("k", "v", "w", "report_date")) == rows_of(df.filter("report_date IS NOT NULL").select("k", "v", "w", "report_date"))
    # neighbouring versions differ, or the key was away in between
    versions = sorted(history.filter("k IS NOT NULL").collect(), key=lambda r: (r["k"], r["valid_from"]))
    for a, b in zip(versions, versions[1:]):
        if a["k"] == b["k"]:
            assert a["valid_until"] <= b["valid_from"]
            assert a["valid_until"] < b["valid_from"] or (a["v"], a["w"]) != (b["v"], b["w"])


@pytest.mark.parametrize("split", [0, 2, 5, 10, 11])
def test_extended_history_is_that_of_all_snapshots(spark, snapshots, split):
    df = spark.createDataFrame(snapshots, SCHEMA)
    last = on(split)
    first = master_history(df.filter(F.to_date("report_date") <= F.lit(last)), ["k"], ["v", "w"])
    whole = master_history(df, ["k"], ["v", "w"])
    extended = extend_history(first, df, ["k"], ["v", "w"], last)
    assert rows_of(extended.select(whole.columns)) == rows_of(whole)


def test_copies_of_a_snapshot_count_once_and_the_later_load_wins(spark):
    rows = [("a", "x", 1, "2024-01-01", "1-x"), ("a", "y", 1, "2024-01-01", "2-y"), ("a", "y", 1, "2024-01-02", "2-z")]
    got = master_history(spark.createDataFrame(rows * 2, SCHEMA), ["k"], ["v"]).collect()
    assert [(r["v"], r["valid_from"], r["valid_until"]) for r in got] == [("y", DAY, None)]
    assert master_history(spark.createDataFrame([], SCHEMA), ["k"], ["v"]).count() == 0


def test_rows_are_dealt_once_and_ranked_after_that(spark, snapshots):
    """No task ranks all it has read, and nothing is dealt by day."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        history = master_history(spark.createDataFrame(snapshots, SCHEMA), ["k"], ["v"])
        plan = history._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(k#") == 1
        assert [x for x in plan.split("hashpartitioning(day#")[1:] if "HashAggregate" not in x] == []
        assert "Window" not in plan.split("Exchange hashpartitioning(k#")[1].split("BroadcastExchange")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


@pytest.mark.parametrize("bucket_days", [1, 7, 4000])
def test_asof_as_brute_force(spark, snapshots, bucket_days):
    history = master_history(spark.createDataFrame(snapshots, SCHEMA), ["k"], ["v", "w"])
    facts = [(n, k, on(n)) for n in range(-3, 16) for k in ("a", "b", "late", "once", "none", None)] + [(99, "a", None)]
    df = spark.createDataFrame(facts, "n int, item string, at date")
    got = asof_join(df, history, {"item": "k"}, "at", bucket_days)
    assert got.columns == ["n", "item", "at", "v", "w"]
    versions, want = history.collect(), []
    for n, k, at in facts:
        own = [r for r in versions if at and k is not None and r["k"] == k and r["valid_from"] <= at and (r["valid_until"] is None or at < r["valid_until"])]
        assert len(own) <= 1
        want.append((n, k, at, *((own[0]["v"], own[0]["w"]) if own else (None, None))))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert asof_join(df.limit(0), history, {"item": "k"}, "at").count() == 0
    assert asof_join(df, history.limit(0), {"item": "k"}, "at").count() == len(facts)


def test_asof_is_joined_by_key_and_bucket(spark, snapshots):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        history = master_history(spark.createDataFrame(snapshots, SCHEMA), ["k"], ["v"])
        df = spark.createDataFrame([("a", DAY)], "item string, at date")
        plan = asof_join(df, history, {"item": "k"}, "at")._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "SortMergeJoin [_bucket" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_a_history_is_never_broadcast(spark):
    """However small it is thought to be: the planner can't tell how many rows come out of an array."""
    history = spark.sql("SELECT 'a' AS k, 1 AS v, date'2024-01-01' AS valid_from, date'2024-02-01' AS valid_until")
    facts = spark.sql("SELECT 'a' AS item, explode(sequence(date'2024-01-01', date'2024-03-01')) AS at")
    joined = asof_join(facts, history, {"item": "k"}, "at")
    assert joined.count() == 61 and joined.filter("v = 1").count() == 31
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_gap_stretches_as_brute_force(spark):
    draw = random.Random(8)
    bounds = [("a", on(0), on(30)), ("b", on(5), on(5)), ("c", on(3), on(20)), ("never", on(0), on(9)), ("shut", on(9), on(2))]
    present = [(b, on(n)) for b, low, high in bounds[:3] for n in range(-5, 40) if draw.random() < 0.6] + [("unknown", on(1)), ("a", None), (None, on(2))]
    df = spark.createDataFrame(present * 2, "branch string, at date")
    limits = spark.createDataFrame(bounds, "branch string, opened date, closed date")
    got = [tuple(r) for r in incremental.gap_stretches(df, "at", ["branch"], limits).collect()]
    want = []
    for branch, low, high in bounds:
        run = []
        for n in range((high - low).days + 2):
            day = low + dt.timedelta(days=n)
            if day <= high and (branch, day) not in present:
                run.append(day)
            elif run:
                want.append((branch, run[0], run[-1], len(run)))
                run = []
    assert sorted(got) == sorted(want)
