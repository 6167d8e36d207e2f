"""Runs registered queries beside their SQL and compares whole results.

``python -m tests.compare [--sf DIR] [name ...]``
"""

from __future__ import annotations

import argparse
import glob
import math
import os
import time
from collections import Counter

import duckdb

DEFAULT_DIR = "/root/testdata/sf0.01"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return str(value) if hasattr(value, "isoformat") else value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(normal(row[i]) for i in order) for row in rows)


def difference(df, con, sql: str) -> str | None:
    """None when the results are equal, else what differs."""
    relation = con.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} against {sorted(relation.columns)}"
    mine, theirs = rows_of(df.columns, df.collect()), rows_of(relation.columns, relation.fetchall())
    if mine == theirs:
        kinds = {c: t for c, t in zip(relation.columns, map(str, relation.types))}
        names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
        odd = {c: (t, kinds[c]) for c, t in df.dtypes if names.get(t) != kinds[c]}
        return f"types {odd}" if odd else None
    missing, extra = theirs - mine, mine - theirs
    return (
        f"{sum(mine.values())} rows against {sum(theirs.values())}; "
        f"missing {list(missing.items())[:2]}; extra {list(extra.items())[:2]}"
    )


def main() -> None:
    from tablespoon.session import session
    from tablespoon.suite.oracle import ORACLE
    from tablespoon.suite.queries import QUERIES

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default=DEFAULT_DIR)
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                    spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    failed = 0
    for name in args.names or QUERIES:
        start = time.time()
        try:
            problem = difference(QUERIES[name](spark, args.sf), con, ORACLE[name])
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed, without SQL: {sorted(set(QUERIES) - set(ORACLE))}, without query: {sorted(set(ORACLE) - set(QUERIES))}")


if __name__ == "__main__":
    main()
