"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# What the jobs rely on. AQE coalesces small shuffle partitions and splits
# skewed ones at run time. Parquet takes about a
# third of the space of its rows, which the planner must know before it picks a
# side to broadcast; where no side is small, a sort is saved once the partitions
# turn out to fit in memory. A skewed join is split even if what follows must then
# be dealt out again.
DEFAULTS = {
    "spark.sql.sources.fileCompressionFactor": "3.0",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
}


_SHUFFLE_BYTES, _SCAN_BYTES = 256 << 20, 128 << 20


def sizing(input_bytes: int, cores: int, max_tasks: int | None = None) -> dict[str, str]:
    """Settings for a job that reads ``input_bytes`` on ``cores``. The adaptive
    planner merges shuffle partitions but never adds any, so their number is set
    for partitions of about 256 MB, which sort in memory. Scans read 128 MB per
    task. A driver that can't handle so many tasks of a stage names ``max_tasks``;
    partitions and scans are then as much larger as that takes."""
    partitions = max(-(-input_bytes // _SHUFFLE_BYTES), cores)
    scan = _SCAN_BYTES
    if max_tasks:
        partitions = min(partitions, max_tasks)
        scan = max(scan, -(-input_bytes // max_tasks))
    return {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.files.maxPartitionBytes": str(scan)}


def session(
    app: str = "tablespoon", master: str | None = None, input_bytes: int = 0, cores: int = 0, **conf: str
) -> SparkSession:
    """A session with the defaults above, sized for the input where its size is
    given; ``conf`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sized = sizing(input_bytes, cores) if input_bytes else {}
    for key, value in {**DEFAULTS, **sized, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for intermediate tables, under the shared folder that the
    session names in ``spark.checkpoint.dir``. There is no default: a folder that
    only one machine sees would lose what the others write."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def workspace(spark: SparkSession, purpose: str) -> str:
    """A scratch folder for results that are read later than this call: it is
    removed when the session's process ends."""
    outer = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark, purpose))
    system = outer.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(outer)
    system.deleteOnExit(outer)
    return f"{outer.toString()}/tables"


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder, on whatever file system it is."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


@contextmanager
def scratch(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A scratch folder for the length of a job step."""
    path = scratch_dir(spark, purpose)
    try:
        yield path
    finally:
        remove(spark, path)
