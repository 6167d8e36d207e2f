"""What several of the operators share: words, row numbers, stored intermediate results."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, as a pattern of Spark SQL: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of ``text`` as long; null texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words_of(text: str | None) -> list[bytes]:
    """Words of ``text`` as UTF-8; ``bytes.split`` splits on just the six ASCII characters."""
    return text.encode("utf-8", "replace").split() if text else []


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores before it until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate results: ``spark.checkpoint.dir``, which all machines share.

    Only a local session without that setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        sc = spark.sparkContext
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if sc.applicationId not in _own_folders:
            _own_folders[sc.applicationId] = tempfile.mkdtemp(prefix="tablespoon-")
        folder = _own_folders[sc.applicationId]
    return folder.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet under the shared folder and read from there, without its lineage.

    Aggregates that are joined back are stored first: the planner then knows their size, and can
    split a hot key, which it can't where a join takes over an aggregate's partitions.
    """
    ship(df.sparkSession)
    path = f"{shared_folder(df.sparkSession)}/tablespoon/{uuid.uuid4().hex}"
    if _in_stage:
        _in_stage[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Tables that the pipeline stage being run has stored, and those of stages run before, by application.
_in_stage: list[list[str]] = []
_of_stages: dict[str, list[str]] = {}


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder, on whatever file system it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stage(fn: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A pipeline stage that first deletes the tables stored by the stages before it.

    A stage's result is written and read again before the next stage gets it, so nothing needs
    them any more; those that ``docs`` still reads stay.
    """

    @wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        app = spark.sparkContext.applicationId
        before = _of_stages.pop(app, [])
        read = docs.inputFiles() if before else []
        kept = [path for path in before if any(path in file for file in read)]
        for path in set(before) - set(kept):
            discard(spark, path)
        _in_stage.append([])
        try:
            return fn(spark, docs, sf_dir)
        finally:
            _of_stages[app] = kept + _in_stage.pop()

    return run


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored, with a distinct long ``name`` per row that later reads see unchanged."""
    return stored(df.withColumn(name, F.monotonically_increasing_id()))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application; they may not have it installed."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        package = Path(__file__).resolve().parent.parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='tablespoon-')}/tablespoon", "zip", package.parent, package.name)
        sc.addPyFile(archive)
        _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")
