import uuid
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tablespoon.session import scratch, scratch_dir
from tablespoon.sinks import Conflict, full_refresh, merge_table, read_bucketed, read_version, save_all, save_bucketed, save_flat, save_partitions, save_table
from tablespoon.sinks import tables
from tablespoon.sinks.files import names, read_text, write_once
from tablespoon.sinks.versions import all_folders, folders, publish, write_folders
from tablespoon.sources import existing, read_table, source
from tablespoon.sources.bronze import register_views
from tablespoon.suite import queries


def rows(spark, *values):
    return spark.createDataFrame(list(values), "id string, year int, month int, day int")


def stored(df):
    return sorted(map(tuple, df.select("id", "year", "month", "day").collect()))


def test_append_never_replaces_and_takes_new_columns(spark, tmp_path):
    path = f"{tmp_path}/t"
    batch = rows(spark, ("a", 2024, 1, 1), ("b", 2024, 1, 2))
    assert save_table(batch, path) == 2
    assert save_table(batch.withColumn("extra", F.lit("x")), path) == 2
    merged = read_table(spark, path)
    assert merged.count() == 4 and merged.filter("extra IS NULL").count() == 2
    assert read_table(spark, path, batch.schema).columns == batch.columns


def test_empty_batch_writes_nothing(spark, tmp_path):
    path = f"{tmp_path}/t"
    empty = rows(spark, ("a", 2024, 1, 1)).filter("id = 'none'")
    assert save_table(empty, path) == 0
    assert not list(tmp_path.glob("t/**/*.parquet"))
    assert read_table(spark, path, empty.schema).count() == 0
    assert save_table(spark.createDataFrame([], empty.schema), path) == 0


def test_only_partitions_of_the_batch_are_replaced(spark, tmp_path):
    path, keys = f"{tmp_path}/t", ["year", "month", "day", "absent"]
    save_partitions(rows(spark, ("a", 2024, 1, 1), ("b", 2024, 1, 1), ("c", 2024, 1, 2)), path, keys)
    save_partitions(rows(spark, ("d", 2024, 1, 1)), path, keys)
    save_partitions(rows(spark, ("x", 2024, 1, 2)).limit(0), path, keys)
    assert stored(read_table(spark, path)) == [("c", 2024, 1, 2), ("d", 2024, 1, 1)]


def test_flat_write(spark, tmp_path):
    path = f"{tmp_path}/t"
    save_partitions(rows(spark, ("a", 2024, 1, 1)), path, ["absent"])
    save_flat(rows(spark, ("b", 2024, 1, 1)), path)
    save_flat(rows(spark, ("c", 2024, 1, 1)).limit(0), path)
    assert stored(read_table(spark, path)) == [("b", 2024, 1, 1)]


def test_full_refresh_drops_old_partitions(spark, tmp_path):
    path = f"{tmp_path}/t"
    full_refresh(rows(spark, ("a", 2023, 1, 1), ("b", 2024, 1, 1)), path)
    full_refresh(rows(spark, ("c", 2024, 1, 1)), path)
    assert stored(read_version(spark, path)) == [("c", 2024, 1, 1)]


def test_readers_see_whole_versions(spark, tmp_path):
    path, schema = f"{tmp_path}/t", rows(spark, ("a", 1, 1, 1)).schema
    assert folders(spark, path) is None and read_version(spark, path, schema).count() == 0
    write_folders(rows(spark, ("x", 2024, 1, 1)), path, ("year",))  # a run that died
    assert folders(spark, path) is None
    full_refresh(rows(spark, ("a", 2024, 1, 1), ("n", None, 1, 1)), path)
    reader = read_version(spark, path)
    full_refresh(rows(spark, ("b", 2024, 2, 1)), path)
    assert stored(reader)[-1] == ("n", None, 1, 1)  # a reader may finish at the version before
    assert stored(read_version(spark, path, schema)) == [("b", 2024, 2, 1)]
    assert stored(read_version(spark, path, schema, ["year=2024/month=3"])) == []
    full_refresh(rows(spark, ("c", 2024, 1, 1)).limit(0), path)
    assert folders(spark, path) == {} and read_version(spark, path, schema).count() == 0
    for i in range(4):
        publish(spark, path, write_folders(rows(spark, (str(i), 2024, 1, 1)), path, ("year", "month")))
    assert stored(read_version(spark, path)) == [("3", 2024, 1, 1)] and len(list(tmp_path.glob("t/_versions/*.json"))) == 2


def test_failed_check_publishes_nothing(spark, tmp_path):
    path = f"{tmp_path}/t"
    full_refresh(rows(spark, ("a", 2024, 1, 1)), path)

    def refuse(stored_rows):
        assert stored_rows.count() == 1
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        full_refresh(rows(spark, ("b", 2024, 1, 1)), path, check=refuse)
    assert stored(read_version(spark, path)) == [("a", 2024, 1, 1)] and len(list(tmp_path.glob("t/data-*"))) == 1


def test_fan_out(spark, tmp_path):
    batch = rows(spark, ("a", 2024, 1, 1))
    counts = save_all({"one": batch, "none": batch.limit(0)}, str(tmp_path), {"one": ("year",)})
    assert counts == {"one": 1, "none": 0}
    assert existing(spark, [f"{tmp_path}/one/year=2024", f"{tmp_path}/missing"]) == [f"{tmp_path}/one/year=2024"]


def test_registered_source_and_views(spark, tmp_path):
    batch = spark.createDataFrame([("c", 2024, 1, 1)], "customer_id string, year int, month int, day int")
    save_table(batch, f"{tmp_path}/customer")
    df = source(spark, str(tmp_path), "customer")
    assert df.first()["customer_name"] is None
    assert "customer_name" not in source(spark, str(tmp_path), "customer", merge_schema=True).columns
    register_views({"customers_view": df})
    assert spark.sql("SELECT customer_id FROM customers_view").first()[0] == "c"


def test_scratch_is_under_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(f"{shared}/x-")
    with scratch(spark, "job") as path:
        spark.range(1).write.parquet(path)
        assert existing(spark, [path])
    assert not existing(spark, [path])


def test_scratch_has_no_default():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(SimpleNamespace(conf={}), "x")


def test_two_writers_lose_nothing(spark, tmp_path, monkeypatch):
    """Both list the versions at the same time; the second finds its number taken."""
    path, schema = f"{tmp_path}/t", "id string, year int, month int, day int"

    def merge(*values):
        staged = f"{tmp_path}/{uuid.uuid4().hex}"
        rows(spark, *values).write.parquet(staged)
        merge_table(spark, path, spark.read.schema(schema).parquet(staged), ["id"], ("year", "month"))

    full_refresh(rows(spark, ("a", 2024, 1, 1), ("b", 2024, 2, 1)), path)
    real, other = tables.replace_partitions, [True]

    def interleaved(*args, **options):
        if other.pop() if other else False:
            merge(("c", 2024, 3, 1), ("b", 2024, 3, 9))  # another writer, between this one's reading and publishing
        return real(*args, **options)

    monkeypatch.setattr(tables, "replace_partitions", interleaved)
    merge(("d", 2024, 1, 1), ("b", 2024, 4, 7))
    assert stored(read_version(spark, path)) == [("a", 2024, 1, 1), ("b", 2024, 4, 7), ("c", 2024, 3, 1), ("d", 2024, 1, 1)]
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda n: merge((f"t{n}", 2024, n, 1), ("x", 2024, n, 1)), range(1, 4)))
    ids = [r[0] for r in stored(read_version(spark, path))]
    assert sorted(ids) == ["a", "b", "c", "d", "t1", "t2", "t3", "x"]


def test_conflict_is_refused_and_leaves_no_files(spark, tmp_path):
    path = f"{tmp_path}/t"
    full_refresh(rows(spark, ("a", 2024, 1, 1), ("b", 2024, 2, 1)), path)
    base = all_folders(spark, path)
    tables.replace_partitions(rows(spark, ("c", 2024, 2, 1)), path)
    tables.replace_partitions(rows(spark, ("d", 2024, 1, 1)), path, base=base)  # another partition
    folders_before = len(list(tmp_path.glob("t/data-*")))
    with pytest.raises(Conflict):
        tables.replace_partitions(rows(spark, ("e", 2024, 2, 1)), path, base=base)
    assert stored(read_version(spark, path)) == [("c", 2024, 2, 1), ("d", 2024, 1, 1)]
    assert len(list(tmp_path.glob("t/data-*"))) == folders_before


def test_files_are_written_once(spark, tmp_path):
    assert write_once(spark, f"{tmp_path}/log/a", "ü1") and not write_once(spark, f"{tmp_path}/log/a", "2")
    assert write_once(spark, f"file:{tmp_path}/log/b", "") and read_text(spark, f"{tmp_path}/log/a") == "ü1"
    assert names(spark, f"{tmp_path}/log") == ["a", "b"] and names(spark, f"{tmp_path}/none") == []


def test_bucketed_table(spark, tmp_path):
    """Appends meet in their buckets; null keys, a hot key, clashing names and an empty batch are fine."""
    path = f"{tmp_path}/it's a table"
    schema = "id string, _bucket int, n bigint"
    with pytest.raises(ValueError, match="no bucketed table"):
        read_bucketed(spark, path)
    save_bucketed(spark.createDataFrame([], schema), path, ["id"], 4)
    assert read_bucketed(spark, path).count() == 0
    batch = spark.createDataFrame([("a", 1, 1), (None, 2, 2), ("a", 1, 1), ("b", None, None)], schema)
    hot = spark.range(0, 5000).select(F.lit("a").alias("id"), F.lit(0).alias("_bucket"), F.col("id").alias("n"))
    save_bucketed(batch, path, ["id"], 4)
    save_bucketed(hot.select("n", "_bucket", "id"), path, ["id"], 4)  # columns go by name
    table = read_bucketed(spark, path)
    assert table.columns == batch.columns and table.exceptAll(batch.unionByName(hot)).isEmpty() and table.count() == 5004
    counts = table.groupBy("id").count()
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
    assert {r["id"]: r["count"] for r in counts.collect()} == {"a": 5002, "b": 1, None: 1}
    assert spark.read.parquet(path).count() == 5004


def test_bucketed_table_keeps_its_first_shape(spark, tmp_path):
    path = f"{tmp_path}/t"
    batch = rows(spark, ("a", 2024, 1, 1))
    save_bucketed(batch, path, ["id"], 4)
    for df, keys, n in ((batch, ["id"], 8), (batch, ["year"], 4), (batch.drop("day"), ["id"], 4), (batch.withColumn("day", F.lit("1")), ["id"], 4)):
        with pytest.raises(ValueError, match="has keys"):
            save_bucketed(df, path, keys, n)
    assert stored(read_bucketed(spark, path)) == [("a", 2024, 1, 1)]


def test_bucketed_copies_are_not_compared_and_buckets_grow(spark, monkeypatch):
    """Second copies are written as they are made, and a bucket stays as large however many rows there are."""
    seen = []
    monkeypatch.setattr(queries, "save_bucketed", lambda df, path, keys, buckets: seen.append((df, buckets)))
    monkeypatch.setattr(queries, "_bytes", lambda table: 100 * (8 << 20), raising=False)
    with pytest.raises(ValueError):  # nothing was written
        queries.QUERIES["sales_lines_bucketed"](spark, "/root/testdata/sf0.001")
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df, _ in seen]
    assert len(plans) == 4 and not any("Aggregate" in p or "Generate" in p for p in plans)
    assert {buckets for _, buckets in seen} == {100}
