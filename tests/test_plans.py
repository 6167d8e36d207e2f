"""What the planner makes of the operators."""

import datetime as dt
from functools import partial

import pytest
from pyspark.sql import functions as F

from tablespoon.operators import incremental, nested
from tablespoon.plans import marts, staging
from tablespoon.plans.transform import landed_copy, transform
from tablespoon.schemas import PARTITION_COLUMNS, SPECS
from tablespoon.sinks import read_bucketed, save_bucketed
from tablespoon.sinks.tables import _balanced, save_table
from tablespoon.sources import read_days, read_table, source
from tablespoon.sources.landing import BY_DOCUMENT
from tablespoon.suite import domain as d
from tablespoon.suite import queries
from tablespoon.suite.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
LAZY = [n for n in QUERIES if not n.startswith(("sink_", "stream_", "daily_", "load_", "backfill_", "revenue_by_", "two_", "sales_lines_bucketed")) and n not in (
    "read_nested_json", "read_json_arrays", "nest_land_roundtrip", "merge_interrupted", "first_day_without_invoices", "interrupted_build",
    "revenue_incremental", "master_snapshot", "backfill_range", "missing_day_empty", "empty_input")]


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    """Invoices stored by day, and their lines."""
    root = str(tmp_path_factory.mktemp("bronze"))
    save_table(d.invoice_header(spark, SF_DIR).withColumn("tip_amount", F.lit(0.0)), f"{root}/invoice_header")
    save_table(d.invoice_detail(spark, SF_DIR), f"{root}/invoice_detail", [])
    return root


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    mode = df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert not any(word in text for word in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"))


def test_latest_copy_is_limited_before_the_shuffle(spark):
    text = plan(staging.stg_order_header(d.order_header(spark, SF_DIR)))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1


def test_revenue_needs_two_shuffles(spark, bronze):
    text = plan(marts.revenue_daily(source(spark, bronze, "invoice_header")))
    assert text.count("Exchange hashpartitioning") == 2
    assert "GreaterThan(total_amount,0.0)" in text
    assert "customer_id" not in text.split("ReadSchema")[1]


def test_status_filter_reaches_the_scan(spark, bronze):
    sales = marts.sales_lines(source(spark, bronze, "invoice_header"), source(spark, bronze, "invoice_detail"))
    text = formatted(sales)
    assert "Not(EqualTo(payment_status,4))" in text
    read = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    assert not any("employee_id" in line or "unit_price" in line for line in read)


def test_lookback_prunes_partitions(spark, bronze):
    header = source(spark, bronze, "invoice_header")
    recent = incremental.lookback(header, dt.date(1998, 8, 5), 3, partitions=PARTITION_COLUMNS)
    filters = next(line for line in formatted(recent).splitlines() if line.startswith("PartitionFilters"))
    assert ">= 19980802" in filters and "year" in filters
    assert recent.count() == d.invoice_header(spark, SF_DIR).filter("ref_date >= '1998-08-02'").count()


def test_transform_shuffles_nothing(spark):
    df = transform(d.event_orders(spark, SF_DIR), "order_header", None, d.BRANCH_MAP)
    text = plan(df)
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_branch_lookup_is_joined_by_its_size(spark):
    """The map is a local relation; no hint, so the planner goes by its bytes."""
    events = d.event_orders(spark, SF_DIR)
    df = transform(events, "order_header", None, d.BRANCH_MAP)
    assert "ResolvedHint" not in df._jdf.queryExecution().analyzed().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16")
    try:
        assert "SortMergeJoin" in plan(transform(events, "order_header", None, d.BRANCH_MAP))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_partitioned_writes_are_rebalanced(spark):
    df = _balanced(d.event_table(spark, SF_DIR), ["year", "month", "day"])
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(df)


def test_nest_reads_each_side_once(spark):
    text = plan(QUERIES["nest_children"](spark, SF_DIR))
    assert text.count("FileScan") == 3 and text.count("Exchange hashpartitioning") <= 4


def test_deduplication_costs_the_header_one_shuffle_more_and_unmarked_lines_one(spark, bronze):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        header, detail = source(spark, bronze, "invoice_header"), source(spark, bronze, "invoice_detail")
        assert plan(marts.sales_lines(header, detail)).count("Exchange hashpartitioning") == 2
        assert plan(marts.sales_lines(header, detail, dedupe=True)).count("Exchange hashpartitioning") == 3
        unmarked = marts.sales_lines(header, detail.drop("ingest_id"), dedupe=True)
        assert plan(unmarked).count("Exchange hashpartitioning") == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


@pytest.mark.parametrize("mark", [True, False])
def test_bucketed_invoices_are_ranked_and_joined_without_a_shuffle(spark, tmp_path, mark):
    header, detail = d.invoice_header(spark, SF_DIR), d.invoice_detail(spark, SF_DIR)
    later = header.withColumns({"ref_date": F.col("ref_date") + F.expr("interval 1 day"), "branch_name": F.lit("NEW")})
    fewer = detail.filter("ref_detail_id LIKE '%-1'").withColumn("ref_date", F.col("ref_date") + F.expr("interval 1 day"))
    loads = {"header": [header, later], "detail": [detail, fewer]}
    for name, copies in loads.items():
        for n, df in enumerate(copies, 1):
            df = df.withColumn("ingest_id", F.lit(f"{n}-2024010{n}-a"))
            save_bucketed(df if mark else df.drop("ingest_id"), f"{tmp_path}/{name}", ["ref_id"], 8)
    header, detail = (read_bucketed(spark, f"{tmp_path}/{name}") for name in loads)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = marts.sales_lines(header, detail, dedupe=True, bucketed=True)
        assert "Exchange" not in plan(df)
        plain = marts.sales_lines(*(spark.read.parquet(f"{tmp_path}/{name}") for name in loads), dedupe=True)
        assert plan(plain).count("Exchange hashpartitioning") == (3 if mark else 4)
        assert df.count() == plain.count() and df.exceptAll(plain).isEmpty() and df.filter("branch_name <> 'NEW'").isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_rows_to_rank_are_those_of_recent_invoices(spark):
    header, detail = d.invoice_header(spark, SF_DIR), d.invoice_detail(spark, SF_DIR)
    target = marts.sales_lines(header, detail)
    df = marts.sales_increment(header, detail, target, dt.date(1998, 8, 5), dedupe=True)
    text = plan(df)
    assert "LeftSemi" in text and text.index("LeftSemi") > text.index("WindowGroupLimit")


@pytest.mark.parametrize("dedupe", [False, True, "marked"])
def test_skewed_invoice_is_split_by_the_adaptive_planner(spark, tmp_path, dedupe):
    lines = d.invoice_detail(spark, SF_DIR)
    noise = {"amount": F.rand(1), "tax_amount": F.rand(2), "item_id": F.uuid(), "ref_detail_id": F.uuid(), "allocation_amount": F.rand(3)}
    hot = spark.range(0, 200_000, 1, 8).join(lines.limit(1)).drop("id").withColumns({"ref_id": F.lit("1"), **noise})
    save_table(hot.unionByName(lines), f"{tmp_path}/detail", [])
    save_table(d.invoice_header(spark, SF_DIR), f"{tmp_path}/header", [])
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB", "spark.sql.files.maxPartitionBytes": "500KB",
    }
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        header, detail = spark.read.parquet(f"{tmp_path}/header"), spark.read.parquet(f"{tmp_path}/detail")
        if dedupe == "marked":
            header, detail = (df.withColumn("ingest_id", F.concat(F.lit("1-20240101-"), "ref_id")) for df in (header, detail))
        df = marts.sales_lines(header, detail, bool(dedupe))
        df._jdf.queryExecution().toRdd().count()
        assert "SortMergeJoin(skew=true)" in plan(df)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_bronze_columns_match_the_registry(spark, tmp_path):
    save_table(transform(d.raw_invoices(spark, SF_DIR), "invoice_header"), f"{tmp_path}/invoice_header", ["year"])
    assert sorted(read_table(spark, f"{tmp_path}/invoice_header").columns) == sorted(SPECS["invoice_header"].bronze.names)
    assert source(spark, str(tmp_path), "invoice_header").count() == d.raw_invoices(spark, SF_DIR).count()


def test_invoice_copies_are_ranked_with_the_columns_of_the_marts(spark, bronze):
    header, detail = read_table(spark, f"{bronze}/invoice_header"), read_table(spark, f"{bronze}/invoice_detail")
    assert "tip_amount" in header.columns
    for mart in (marts.revenue_daily(header, dedupe=True), marts.sales_lines(header, detail, dedupe=True)):
        assert "tip_amount" not in mart._jdf.queryExecution().executedPlan().toString()


def test_event_documents_are_made_without_a_join(spark, monkeypatch):
    landed = {}
    monkeypatch.setattr(queries, "land", lambda df, path, day: landed.setdefault(path.rsplit("/", 1)[1], df))
    queries._land_event_days(spark, SF_DIR, path="nowhere")
    for df in landed.values():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan
    line = landed["orders.json"].filter("Id = '1'").select("CustomerId", "TotalAmount", F.explode("line_items").alias("l")).first()
    assert line["l"].asDict() == {"OrderId": "1", "Id": "L1", "ItemId": line["CustomerId"], "Quantity": "2", "Amount": line["TotalAmount"]}
    sizes = landed["invoices.json"].select(F.size("invoice_details").alias("d"), F.size("invoice_payments").alias("p"))
    assert sizes.distinct().collect() == [(1, 1)]


def test_packed_event_documents_are_the_plain_ones(spark, tmp_path):
    """Events are dealt out by day before their documents are made, and files are compressed."""
    for folder, packed in (("plain", False), ("packed", True)):
        queries._land_event_days(spark, SF_DIR, "BranchId <> 'click'", f"{tmp_path}/{folder}", packed=packed)
    names = [str(p.relative_to(tmp_path)) for p in tmp_path.rglob("part-*")]
    assert {n.split("/")[0] for n in names if n.endswith(".json.gz")} == {"packed"} and not any("packed" in n and not n.endswith(".gz") for n in names)
    plain, packed = (read_days(spark, f"{tmp_path}/{folder}", queries._JANUARY, BY_DOCUMENT) for folder in ("plain", "packed"))
    for table, df in plain.items():
        marked = [landed_copy(df).collect(), landed_copy(packed[table], by_day=True).collect()]
        assert sorted(map(str, marked[0])) == sorted(map(str, marked[1])) and len(marked[0]) > 0


def test_dealt_events_are_filtered_before_the_shuffle_and_sorted_once(spark):
    text = plan(d.event_invoices(spark, SF_DIR, dealt=True).filter("BranchId <> 'click'"))
    above, below = text.split("Exchange", 1)
    assert "REBALANCE_PARTITIONS_BY_COL" in below and "NOT (event_type" in below and "Filter" not in above
    assert text.count("Sort [") == 1


def test_revenue_by_deltas_lands_packed(spark, monkeypatch):
    landed = []
    monkeypatch.setattr(queries, "_land_event_days", lambda *args, **options: landed.append(options.get("packed")) or "landing")
    for job in ("run_transactions", "build"):
        monkeypatch.setattr(queries.jobs, job, lambda *args: None)
    monkeypatch.setattr(queries, "read_version", lambda *args: d.table(spark, SF_DIR, "events").selectExpr("value AS total_revenue", "value AS aov"))
    QUERIES["revenue_by_deltas"](spark, SF_DIR)
    assert landed == [True] * 3


def test_deltas_deal_out_either_side_once(spark, bronze):
    """The batch for its ids and for its latest copies, the earlier copies once, then the sums."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        header = source(spark, bronze, "invoice_header")
        text = plan(marts.revenue_deltas(header.filter("month = 1"), header))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert text.count("Exchange") == 4 and "Window" not in text


@pytest.mark.parametrize("name", ["backfill_range", "backfill_changed_days"])
def test_backfill_lands_what_is_loaded_and_no_more(spark, monkeypatch, name):
    landed, read = [], []
    monkeypatch.setattr(queries, "_land_event_days", lambda spark, sf_dir, *kept: landed.append(kept) or f"landing-{len(landed)}")
    for job in ("run_transactions", "backfill_range"):
        monkeypatch.setattr(queries.jobs, job, lambda spark, lake, *args, **options: read.append(lake.landing))
    monkeypatch.setattr(queries.jobs, "build", lambda *args: None)
    monkeypatch.setattr(queries, "_marts", lambda *args: None)
    QUERIES[name](spark, SF_DIR)
    assert read == ["landing-1", "landing-2"] and len(landed) == 2


def test_two_writers_join_sales_once(spark, monkeypatch):
    written = []
    monkeypatch.setattr(queries, "full_refresh", lambda df, path: written.append(df))
    monkeypatch.setattr(queries, "merge_table", lambda spark, path, source, *args, **options: written.append(source))
    queries.two_writers(spark, SF_DIR)
    assert len(written) == 3
    assert all("Join" not in df._jdf.queryExecution().executedPlan().toString() for df in written)


def test_staging_views_are_counted_without_a_row_per_line_and_count(spark):
    assert "Expand" not in plan(QUERIES["staging_views"](spark, SF_DIR))


def test_lines_are_dealt_out_before_they_are_ranked(spark, bronze):
    """No task sorts all the lines it has read, and conditions on the invoice still reach the scan."""
    latest = staging.latest_invoice_detail(read_table(spark, f"{bronze}/invoice_detail"))
    text = plan(latest)
    assert text.count("Exchange hashpartitioning") == 1
    assert "Sort" not in text.split("Exchange")[1] and "Window" not in text.split("Exchange")[1]
    assert "EqualTo(ref_id,1)" in formatted(latest.filter("ref_id = '1'"))


def test_the_worth_of_ranked_lines_is_dealt_out_for_the_join(spark, bronze):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        header, detail = (read_table(spark, f"{bronze}/invoice_{t}").drop("ingest_id") for t in ("header", "detail"))
        text = plan(marts.sales_lines(header, detail, dedupe=True))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert "xxhash64" not in text
    before_the_join = text.split("Join")[0]
    assert "_net" in before_the_join and "allocation_amount" not in before_the_join


def test_lines_with_few_copies_are_dealt_out_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        header, detail = d.invoice_header(spark, SF_DIR), d.invoice_detail(spark, SF_DIR)
        ranked_first = marts.sales_lines(header, detail, dedupe=True)
        once = marts.sales_lines(header, detail, dedupe=True, few_copies=True)
        assert plan(once).count("Exchange hashpartitioning") == plan(ranked_first).count("Exchange hashpartitioning") - 1
        lines = plan(QUERIES["sales_lines_dedupe"](spark, SF_DIR)).split("SortMergeJoin", 1)[1].split("l_orderkey")[0]
        assert lines.count("Exchange hashpartitioning") == 1 and "Window" not in lines
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_skewed_invoice_with_few_copies_is_split_as_well(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(marts, "sales_lines", partial(marts.sales_lines, few_copies=True))
    test_skewed_invoice_is_split_by_the_adaptive_planner(spark, tmp_path, True)
