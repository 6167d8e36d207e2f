"""Landed JSON to bronze as a file stream, one per document.

A document is parsed once and written to all its tables as one load, which readers
see once it has committed; only then are its files archived. The checkpoint
remembers which files belong to which batch, and a load is named after stream and
batch, so a batch that is repeated after its load committed is not loaded again. A
batch that died halfway has an open load, of which readers see nothing. The
tables hold plain files, so batch loads beside the stream are read like the rest.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablespoon.functions import to_local_ts
from tablespoon.operators.nested import split_document
from tablespoon.operators.standardize import pick_date_column
from tablespoon.plans.transform import landed_copy, stamped, transform
from tablespoon.schemas import INGEST_COLUMN, SPECS, Document, TableSpec
from tablespoon.sinks.files import at, read_text, write_once
from tablespoon.sinks.loads import committed, load_id, save_load


def _stream_name(spark: SparkSession, checkpoint: str) -> str:
    """A name that lives as long as the checkpoint."""
    path = f"{checkpoint}/tablespoon/name"
    system, hadoop_path = at(spark, path)
    if not system.exists(hadoop_path):
        write_once(spark, path, uuid.uuid4().hex)
    return read_text(spark, path)


def _once(landed: DataFrame, document: Document, within: str) -> DataFrame:
    """One copy of each content, however often it lands within the watermark's delay."""
    parts = F.split(INGEST_COLUMN, "-")
    own = [to_local_ts(c, landed.schema[c].dataType) for c in landed.columns if c == pick_date_column(landed.columns)]
    filed = F.try_to_timestamp(parts[0], F.lit("yyyyMMdd"))
    at_time = F.coalesce(*[t.cast("timestamp") for t in own], filed, F.lit("1970-01-01").cast("timestamp"))
    timed = landed.withColumns({"_at": at_time, "_content": F.element_at(parts, -1)})
    return timed.withWatermark("_at", within).dropDuplicatesWithinWatermark(["_content"]).drop("_at", "_content")


def stream_ingest(
    spark: SparkSession,
    landing: str,
    document: Document,
    bronze: str,
    checkpoint: str,
    run_ts: dt.datetime | None = None,
    branch_map: Mapping[str, str] | None = None,
    archive: str | None = None,
    max_files: int | None = None,
    specs: Mapping[str, TableSpec] = SPECS,
    once_within: str | None = None,
) -> None:
    """Takes in all files under ``landing`` (a glob) that were not taken in before,
    into the document's header table and those of its children, then stops. With
    ``archive``, files are moved there after all tables have their rows. Each
    document needs its own checkpoint; a run bounded by ``max_files`` per batch
    uses several batches.

    With ``once_within``, such as ``"7 days"``, a document that lands again unchanged
    is not taken again for that long by its own time (of documents without one:
    by the day of its file). The contents seen are state of the stream, which
    forgets them once the watermark has passed; what changed is another content."""
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc)
    reader = spark.readStream.schema(document.landing(specs)).option("mode", "FAILFAST")
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    landed = landed_copy(reader.json(landing))
    if once_within:
        landed = _once(landed, document, once_within)

    def take(rows: DataFrame, number: int) -> None:
        own = rows.sparkSession
        name = f"{document.header}-{_stream_name(own, checkpoint)}-{number}"
        if committed(own, bronze, name):
            return
        load, parsed = load_id(run_ts), f"{checkpoint}/tablespoon/parsed"
        nested = stamped(rows, load)
        nested.write.mode("overwrite").parquet(parsed)  # parsed once, read by each table
        tables = split_document(own.read.schema(nested.schema).parquet(parsed), document)
        frames = {table: transform(df, table, run_ts, branch_map, specs) for table, df in tables.items()}
        save_load(frames, bronze, load, name, {table: specs[table].partitions for table in frames})

    query = landed.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
