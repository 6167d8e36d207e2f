"""Hashing of personal data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def hash_pii(col: Column) -> Column:
    """Upper-case hex MD5 of the UTF-8 text; null stays null."""
    return F.upper(F.md5(col.cast("string")))


def register_hash_pii(spark: SparkSession, name: str = "hash_pii") -> None:
    """The same as a SQL function, inlined by the optimizer."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(value STRING) RETURNS STRING RETURN upper(md5(value))"
    )


def mask_pii(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replaces the given columns by their hash, in place."""
    return df.withColumns({c: hash_pii(F.col(c)) for c in columns})
