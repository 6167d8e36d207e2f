"""Tables dealt into buckets by their key when they are written.

What then groups or joins by the key, or by more columns, reads a bucket per task
and shuffles nothing. Key, number of buckets and columns are fixed by the first
write, which puts them into a small file beside the rows; a session that reads or
appends makes them known to its catalog under a name of the path's own.

A bucket is read by one task. Where one key may have very many rows, read the
folder as a plain table (:func:`~tablespoon.sources.read_table`), and joins deal
out its rows and split that key.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablespoon.sinks.files import at, read_text, write_once

_ABOUT = "_buckets.json"


def save_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """Appends rows, by default a file per bucket; a very full bucket is written by
    several tasks. Raises ValueError where the table has other keys, another number
    of buckets or other columns. An empty first batch makes an empty table."""
    spark = df.sparkSession
    write_once(spark, f"{path}/{_ABOUT}", json.dumps({"keys": keys, "buckets": buckets, "schema": df.schema.jsonValue()}))
    about = _about(spark, path)
    types = {f.name: f.dataType for f in T.StructType.fromJson(about["schema"])}
    if (about["keys"], about["buckets"], types) != (keys, buckets, {f.name: f.dataType for f in df.schema}):
        raise ValueError(f"{path} has keys {about['keys']}, {about['buckets']} buckets and columns {sorted(types)}")
    name = "_bucket"
    while name in df.columns:
        name = f"_{name}"
    dealt = df.select(*types).withColumn(name, F.pmod(F.hash(*keys), F.lit(buckets)))
    dealt.hint("rebalance", F.col(name)).drop(name).write.insertInto(_registered(spark, path, about))


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The table, bucketed. Raises ValueError where none was written."""
    return spark.table(_registered(spark, path, _about(spark, path)))


def _about(spark: SparkSession, path: str) -> dict:
    system, file = at(spark, f"{path}/{_ABOUT}")
    if not system.exists(file):
        raise ValueError(f"no bucketed table at {path}")
    return json.loads(read_text(spark, f"{path}/{_ABOUT}"))


def _registered(spark: SparkSession, path: str, about: dict) -> str:
    """The catalog's name of the table, with the files that are there now."""
    system, folder = at(spark, path)
    uri = system.makeQualified(folder).toString()
    name = "bucketed_" + hashlib.sha256(f"{uri} {json.dumps(about, sort_keys=True)}".encode()).hexdigest()[:24]
    if spark.catalog.tableExists(name):
        spark.catalog.refreshTable(name)
    else:
        by = ", ".join(f"`{k}`" for k in about["keys"])
        columns = T.StructType.fromJson(about["schema"]).toDDL()
        location = uri.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet "
            f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {about['buckets']} BUCKETS LOCATION '{location}'"
        )
    return name
