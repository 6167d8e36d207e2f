"""Data-quality checks. A check counts violating rows; a report has one row per
check: ``check_name, level, violations, passed``."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ERROR, WARN = "error", "warn"

# Key columns in order of preference, and the tables whose row
# count must survive the transformation.
KEY_CANDIDATES = (
    "order_id",
    "ref_id",
    "customer_id",
    "product_id",
    "order_detail_id",
    "ref_detail_id",
    "invoice_payment_id",
    "Id",
    "id",
)
COUNTED_TABLES = ("order_header", "invoice_header")


class QualityError(RuntimeError):
    """A check of level error found violations."""


@dataclass(frozen=True)
class Check:
    name: str
    level: str
    violates: Column  # true for a violating row


def check_key(df: DataFrame, candidates: tuple[str, ...] = KEY_CANDIDATES) -> list[Check]:
    """The key, the first candidate present, is neither null nor empty. No check without one."""
    key = next((c for c in candidates if c in df.columns), None)
    if key is None:
        return []
    return [Check(f"key_present:{key}", ERROR, F.col(key).isNull() | (F.col(key).cast("string") == ""))]


def check_negative(df: DataFrame, column: str, level: str = ERROR) -> list[Check]:
    """No negative values in the column, where the table has it."""
    return [Check(f"not_negative:{column}", level, F.col(column) < 0)] if column in df.columns else []


def check_not_null(columns: list[str]) -> list[Check]:
    """None of the columns is null."""
    return [Check(f"not_null:{c}", ERROR, F.col(c).isNull()) for c in columns]


def check_future(column: str, as_of: dt.date) -> list[Check]:
    """No time after midnight at the start of ``as_of``."""
    return [Check(f"not_future:{column}", ERROR, F.col(column) > F.lit(as_of).cast("timestamp_ntz"))]


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Report on all checks from a single pass over the frame."""
    counted = df.agg(*[F.count_if(c.violates).alias(f"_{i}") for i, c in enumerate(checks)])
    rows = [
        F.struct(
            F.lit(c.name).alias("check_name"),
            F.lit(c.level).alias("level"),
            F.col(f"_{i}").alias("violations"),
            (F.col(f"_{i}") == 0).alias("passed"),
        )
        for i, c in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*rows)))


FAILED = "failed_checks"


def with_failures(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Rows with ``failed_checks``, the names of the checks of level error that each
    violates; none is an empty list. An unknown outcome is no violation."""
    marks = [F.when(c.violates, F.lit(c.name)) for c in checks if c.level == ERROR]
    return df.withColumn(FAILED, F.array_compact(F.array(*marks)) if marks else F.array().cast("array<string>"))


def violating_rows(df: DataFrame, checks: list[Check]) -> DataFrame:
    """The rows that violate a check of level error, with the names of those they violate."""
    return with_failures(df, checks).filter(F.size(FAILED) > 0)


REPORT_SCHEMA = "check_name string, level string, violations bigint, passed boolean"


def check_counts(raw: DataFrame, out: DataFrame, table: str) -> DataFrame:
    """Report on row counts before and after, for header tables only; the
    violations are the difference."""
    sides = raw.select(F.lit(1).alias("n"), F.lit(table).alias("table_name")).unionByName(
        out.select(F.lit(-1).alias("n"), F.lit(table).alias("table_name"))
    )
    difference = F.abs(F.coalesce(F.sum("n"), F.lit(0)))
    report = sides.agg(difference.alias("violations")).select(
        F.lit(f"row_count:{table}").alias("check_name"),
        F.lit(ERROR).alias("level"),
        "violations",
        (F.col("violations") == 0).alias("passed"),
    )
    return report if table in COUNTED_TABLES else report.filter(F.lit(False))


def verify_table(raw: DataFrame, out: DataFrame, table: str) -> DataFrame:
    """All checks on a transformed batch: row count, key, negative totals (warning only)."""
    checks = check_key(out) + check_negative(out, "total_amount", WARN)
    report = check_counts(raw, out, table)
    return report.unionByName(run_checks(out, checks)) if checks else report


def summarize(report: DataFrame) -> DataFrame:
    """One row ``verdict``: true when no check of level error failed."""
    ok = F.col("passed") | (F.col("level") != ERROR)
    return report.agg(F.coalesce(F.bool_and(ok), F.lit(True)).alias("verdict"))


def violations(report: DataFrame) -> DataFrame:
    """The failed checks."""
    return report.filter(~F.col("passed"))


def gate(report: DataFrame) -> DataFrame:
    """Raises when a check of level error failed, else returns the report. Only
    the report, one row per check, comes to the driver."""
    failed = [r for r in violations(report).collect() if r["level"] == ERROR]
    if failed:
        raise QualityError("; ".join(f"{r['check_name']}: {r['violations']} rows" for r in failed))
    return report


def nonnull_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Row count and the non-null count of each column, one row."""
    counts = [F.count(F.col(c)).alias(f"{c}_nonnull") for c in columns]
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *counts)
