"""Line dedup through a deletion neighbourhood: of equal or nearly equal lines the earliest stays.

The neighbourhood is searched in three passes, each over what the one before has left. Cut two lines
within one edit into parts: they agree but for the one part that holds the edit. So each line emits
itself without each of its parts, first without each half, then without each of ``PARTS`` parts, and
lines go on that share such a key with a different line; no pair is lost. What is left emits all
its variants within the bound as hashed keys: itself, itself without its i-th character, and the
latter with i, for the i in the parts that held an edit. Equal keys meet:

* a line and another's deletion (they differ by an insertion),
* two deletions at the same place (they differ by a substitution).

All lines under such a key lie within one edit of each other, or of the line that is the key, so the
earliest per key is all that has to be remembered, as an aggregate: no group is gathered and no
pairs within a group are formed. The pairs (line, earliest) are then verified by edit distance.

A line goes if an earlier line of the corpus lies within the bound, whether or not that one stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, fresh, stage, stored

#: Lines of fewer characters are compared for equality only: one edit is a large part of them.
SHORTEST = 20

#: Parts of the second pass.
PARTS = 16
#: Numbers that lines are reduced to before their texts are looked up.
SLOTS = 1 << 20

_BASE = 0x2545F4914F6CDD1D  # odd, so that it can be divided by
_BACK = pow(_BASE, -1, 1 << 64)
_PLACE = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def variants(line: str) -> tuple[int, np.ndarray]:
    """Hash of ``line``, and the hashes of ``line`` without each of its characters.

    The hash is a polynomial in the characters' mixed code points, so that leaving one out is a
    prefix plus a suffix moved by one place: linear time for the whole neighbourhood.
    """
    points = _mix(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1))
    terms = points * _powers(len(points))
    until = np.add.accumulate(terms)
    total = until[-1]
    return int(total), (until - terms) + (total - until) * np.uint64(_BACK)


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``ord, line, parts`` -> ``key, role, ord``; role 0: the line itself, 1: a deletion, 2: a deletion and its place.

    Variants are those of the parts that the line shares the rest of with another one: part p as a
    line of its length, part PARTS + p as the longer of two lines.
    """
    for batch in batches:
        ids, keys, roles, whose, held = batch.column(0).to_numpy(zero_copy_only=False), [], [], [], 0

        def out() -> pa.RecordBatch:
            columns = [np.concatenate(keys).view(np.int64), np.concatenate(roles), ids[np.concatenate(whose)]]
            return pa.record_batch([pa.array(c) for c in columns], ["key", "role", "ord"])

        for row, (line, parts) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
            own, without = variants(line)
            mixed, n = _mix(without), len(without)
            same = [np.arange(n * p // PARTS, n * (p + 1) // PARTS) for p in parts if p < PARTS]
            longer = [np.arange((n - 1) * p // PARTS, (n - 1) * (p + 1) // PARTS + 1) for p in (x - PARTS for x in parts if x >= PARTS)]
            at = np.unique(np.concatenate([*same, np.empty(0, np.int64)]).astype(np.int64))
            shorter = np.unique(mixed[np.concatenate([*longer, np.empty(0, np.int64)]).astype(np.int64)])
            placed = _mix(mixed[at] + (at.astype(np.uint64) + np.uint64(1)) * _PLACE)
            keys += [_mix(np.array([own], np.uint64)), shorter, placed]
            roles += [np.zeros(1, np.int8), np.ones(len(shorter), np.int8), np.full(len(placed), 2, np.int8)]
            whose.append(np.full(1 + len(shorter) + len(placed), row))
            held += len(whose[-1])
            if held > 500_000:
                yield out()
                keys, roles, whose, held = [], [], [], 0
        if held:
            yield out()


def _without_parts(line: Column, parts: int) -> Column:
    """Hashes of ``line`` without each of its ``parts``, as it is and as a line one character longer than another."""
    keys = []
    for longer in (0, 1):  # parts are those of the shorter line; the longer one has the extra character in the part
        n = F.length(line) - longer
        for part in range(parts):
            start, end = F.floor(n * part / parts).cast("int"), F.floor(n * (part + 1) / parts).cast("int")
            head, tail = F.substring(line, F.lit(1), start), F.substring(line, end + 1 + longer, n)
            keys.append(F.xxhash64(F.lit(part), n, head, tail))
    return F.array(*keys)


def _exploded(docs: DataFrame) -> DataFrame:
    """``doc_id, key, pos, line, h, h2`` of every line with a word; ``key`` tells texts with one doc_id apart."""
    return (
        docs.select("doc_id", F.xxhash64("text").alias("key"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
        .where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
        .select("*", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("h2"))
    )


def near_lines(lines: DataFrame, texts: DataFrame) -> DataFrame:
    """``h, h2`` of the lines that lie within one edit of an earlier one.

    ``lines(h, h2, first, halves)``: the distinct lines, ``first`` their order. ``texts(h, h2, line)``
    has each distinct line's text, perhaps repeatedly.
    """

    def sharing(keyed: DataFrame) -> DataFrame:
        """The lines that share a key with a different one, and the numbers of these keys."""
        each = keyed.select("h", "h2", F.posexplode("keys").alias("part", "k"))
        shared = each.groupBy("k").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a <> b").select("k")
        hits = each.join(stored(shared), "k", "left_semi")
        return stored(hits.groupBy("h", "h2").agg(F.collect_set("part").alias("parts")))

    some = sharing(lines.select("h", "h2", F.col("halves").alias("keys"))).drop("parts")
    # most texts end here: SLOTS numbers at most are broadcast, whatever the size of the table
    slot = F.pmod("h", F.lit(SLOTS)).cast("int")
    near_some = texts.withColumn("slot", slot).join(F.broadcast(some.select(slot.alias("slot")).distinct()), "slot", "left_semi")
    found = stored(near_some.drop("slot").join(some, ["h", "h2"], "left_semi").dropDuplicates(["h", "h2"]))
    some = sharing(found.select("h", "h2", _without_parts(F.col("line"), PARTS).alias("keys")))
    # the lines that go on, numbered in their order
    wanted = stored(found.join(some, ["h", "h2"]).join(lines.select("h", "h2", "first"), ["h", "h2"]))
    wanted = stored(wanted.orderBy("first").select("h", "h2", "line", "parts", F.monotonically_increasing_id().alias("ord")))
    emitted = stored(wanted.select("ord", "line", "parts").repartition("ord").mapInArrow(_emit, "key long, role byte, ord long"))
    wanted = wanted.drop("parts")
    # the least line per key and role; deletions meet the line itself and the other way round
    of = lambda role: F.min(F.when(F.col("role") == role, F.col("ord")))
    placed = (F.col("role") == 2).alias("placed")
    least = emitted.groupBy("key", placed).agg(of(0).alias("whole"), of(1).alias("shorter"), of(2).alias("same"), F.count("*").alias("n"))
    least = least.where("n > 1 and (placed or (whole is not null and shorter is not null))").drop("n")
    met = emitted.withColumn("placed", placed).join(least, ["key", "placed"])
    other = F.when(F.col("role") == 0, F.col("shorter")).when(F.col("role") == 1, F.col("whole")).otherwise(F.col("same"))
    pairs = met.select("ord", other.alias("first_ord")).where("first_ord < ord").distinct()
    earlier = wanted.select(F.col("ord").alias("first_ord"), F.col("line").alias("earlier"))
    near = pairs.join(wanted, "ord").join(earlier, "first_ord").where(F.levenshtein("line", "earlier", 1).between(0, 1))
    return near.select("h", "h2").distinct()


@F.pandas_udf(T.StringType())
def without_lines(rows: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """A text without the lines of the given numbers; null stays null."""
    for texts, drops in rows:
        out = []
        for text, drop in zip(texts, drops):
            if text is not None:
                gone = set(drop.tolist())
                text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
            out.append(text)
        yield pd.Series(out, dtype=object)


def deduplicated(docs: DataFrame, shortest: int = SHORTEST) -> tuple[DataFrame, str, str]:
    """``docs`` with fewer lines in ``text`` and two more columns, lines before and lines removed, and their names.

    Lines end at ``\\n``. Order is by doc_id (null last), then by text, then by place. Lines without
    a word always stay. Of equal lines the first stays; lines of ``shortest`` characters or more
    also go if an earlier such line is one edit away. A null text stays null and an empty one
    empty; a document whose lines all go has an empty text. Rows that repeat doc_id and text are
    one document and come out alike. All other columns stay as they are.
    """
    exploded = _exploded(docs)
    long_enough = F.length("line") >= shortest
    found = stored(
        exploded.select("doc_id", "key", "pos", "h", "h2", F.when(long_enough, _without_parts(F.col("line"), 2)).alias("halves"))
    )
    at = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key", "pos")
    firsts = stored(found.groupBy("h", "h2").agg(F.min(at).alias("first"), F.first("halves").alias("halves")))
    texts = exploded.where(long_enough).select("h", "h2", "line")
    near = near_lines(firsts.where("halves is not null"), texts).withColumn("near", F.lit(True))
    fate = stored(firsts.select("h", "h2", "first").join(near, ["h", "h2"], "left"))
    gone = found.select("doc_id", "key", "pos", "h", "h2").join(fate, ["h", "h2"]).where(F.col("near") | (at != F.col("first")))
    n_lines, n_removed, key, drop = fresh(docs, "n_lines", "n_removed_lines", "key", "drop")
    # a null doc_id must meet itself, so the key holds it
    dropped = gone.groupBy(F.xxhash64("doc_id", "key").alias(key), F.hash("doc_id", "key").alias(f"{key}2")).agg(F.collect_set("pos").alias(drop))
    # only texts that lose lines go through Python
    changed = F.when(F.col(drop).isNotNull(), F.col("text"))
    kept = F.when(F.col(drop).isNull(), F.col("text")).otherwise(without_lines(changed, F.col(drop)))
    keyed = docs.withColumns({key: F.xxhash64("doc_id", F.xxhash64("text")), f"{key}2": F.hash("doc_id", F.xxhash64("text"))})
    out = keyed.join(dropped, [key, f"{key}2"], "left").withColumns(
        {
            n_lines: F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long"),
            n_removed: F.when(F.col(drop).isNull(), 0).otherwise(F.size(drop)).cast("long"),
            "text": kept,
        }
    )
    return out.select(*docs.columns, n_lines, n_removed), n_lines, n_removed


@stage
def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents without their repeated lines; ``n_chars`` follows the text where there is one."""
    out = deduplicated(docs)[0].select(*docs.columns)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, n_lines, n_removed = deduplicated(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "text", F.col(n_lines).alias("n_lines"), F.col(n_removed).alias("n_removed_lines"))
