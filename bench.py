"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query runs once to warm up and then ``$BENCH_RUNS`` times; its whole result
is computed and thrown away, and the fastest run counts.
"""

from __future__ import annotations

import json
import os
import time

from tablespoon.session import session
from tablespoon.suite.queries import QUERIES

HEADLINE = [
    "revenue_daily",
    "revenue_daily_dedupe",
    "sales_lines",
    "sales_lines_dedupe",
    "dedup_order_header",
    "dedup_order_detail",
    "dedup_invoice_header",
    "transform_order_header",
    "transform_invoice_header",
    "flatten_orders",
    "flatten_invoice_details",
    "nest_children",
    "normalize_payload",
    "merge_upsert",
    "merge_replace",
    "sales_incremental",
    "branch_enrich",
    "stg_customer",
    "gap_days",
    "dq_not_null",
    "read_nested_json",
    "sink_partition_overwrite",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        best = float("inf")
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf_dir}))


if __name__ == "__main__":
    main()
