"""Small files beside tables, on whatever file system they are: written whole, and once."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

from tablespoon.session import remove


def at(spark: SparkSession, path: str):
    """File system and path object."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds, in order; nothing if it does not exist."""
    system, hadoop_path = at(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(hadoop_path)) if system.exists(hadoop_path) else []


def read_text(spark: SparkSession, path: str) -> str:
    system, hadoop_path = at(spark, path)
    stream = system.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a file that nobody has written yet; false, and no change, if it is there.

    Readers see it with all its text or not at all. The text goes to a draft, whose
    rename is refused if the file exists; a local disk's rename would overwrite, so
    there the draft is linked. A store whose rename neither refuses nor is one step
    is not for several writers.
    """
    folder, name = path.rsplit("/", 1)
    system, draft = at(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    system.mkdirs(draft.getParent())
    if system.getUri().getScheme() == "file":
        local = draft.toUri().getPath()
        with open(local, "w", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(local, at(spark, path)[1].toUri().getPath())
        except FileExistsError:
            return False
        finally:
            os.unlink(local)
        return True
    out = system.create(draft)
    out.write(bytearray(text.encode()))
    out.close()
    if system.rename(draft, at(spark, path)[1]):
        return True
    remove(spark, draft.toString())
    if not system.exists(at(spark, path)[1]):
        raise OSError(f"could not write {path}")
    return False
