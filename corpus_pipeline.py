"""A training corpus from ``documents``: filtered, deduplicated, mixed and packed, stage by stage.

Each stage's result is written as Parquet and read back as the next one's documents, so a lost
executor costs no more than the stage it was lost in.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from tablespoon.llm.common import discard, documents, stored
from tablespoon.llm.lines import dedup_lines
from tablespoon.llm.mixing import mix_sources
from tablespoon.llm.packing import pack_documents
from tablespoon.llm.quality import quality_filter
from tablespoon.llm.simhash import keep_first

STAGES = [
    ("quality_rules", quality_filter),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", keep_first),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_documents),
]

#: Fingerprints by XXH64 and random rounding have no equivalent in DuckDB's SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = documents(spark, sf_dir), None
    for _, stage in STAGES[:-1]:
        after = stored(stage(spark, docs, sf_dir))
        if before:  # read for the last time
            discard(spark, before)
        docs, before = after, os.path.dirname(next(iter(after.inputFiles()), "")) or None
    return STAGES[-1][1](spark, docs, sf_dir)
