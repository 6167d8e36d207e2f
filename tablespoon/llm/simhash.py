"""SimHash near-duplicates through anchor points of a covering code.

Distinct fingerprints are compared, so a group of copies counts once however large it is. Two
fingerprints that differ in at most 4 bits differ in at most 2 bits of one of their 32-bit halves.
Each half is covered by a code: two Hamming(15,11) blocks, each within 1 of every block value, and
two raw bits. For two halves at distance 2 take the point midway, at distance 1 from both: the code
word covering it lies within covering radius + 1 of both, in the one block where they leave it.
So every fingerprint goes to the (at most 17) anchors of each half that cover a point within 1 of
it, and fingerprints that share an anchor are compared. This is the method's "radius plus
threshold" with the threshold split evenly between the two sides, which sends fewer copies.

Within an anchor, links form a spanning forest rather than all pairs. An anchor with more than
BUCKET fingerprints is dealt again by the anchors of the other half (threshold 4, so 2 each side).

The pipeline's stage, :func:`keep_first`, compares the texts of each component of linked fingerprints,
and beside them those that share a MinHash band, since a Jaccard coefficient of 0.8 is often beyond 4
bits. An exact check of that coefficient follows for both.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import paragraphs
from .common import documents, fresh, numbered, stage, stored
from .components import components

THRESHOLD = 4
SHINGLE = 4
#: Fingerprints that one task compares at once under one anchor.
BUCKET = 50_000

_ASCII_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str | None) -> int:
    """64-bit SimHash: a bit is set if it is set in over half the hashed 4-word shingles, repeats included."""
    words = text.encode("utf-8", "replace").translate(_ASCII_LOWER).split() if text else []
    if not words:
        return 0
    hash64 = xxhash.xxh64_intdigest
    if len(words) <= SHINGLE:
        return hash64(b" ".join(words), 42)
    hashes = np.array([hash64(b" ".join(x), 42) for x in zip(words, words[1:], words[2:], words[3:])], dtype=">u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


@F.pandas_udf(T.LongType())
def fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Fingerprints as signed longs."""
    for batch in texts:
        yield pd.Series(np.array([fingerprint(t) for t in batch], dtype=np.uint64).view(np.int64))


# ---- anchors


def _decode(block: np.ndarray) -> np.ndarray:
    """The Hamming(15,11) code word nearest to each 15-bit value."""
    syndrome = np.zeros_like(block)
    for i in range(15):
        syndrome ^= np.where((block >> i) & 1, i + 1, 0)
    return np.where(syndrome > 0, block ^ (1 << np.maximum(syndrome - 1, 0)), block)


@lru_cache
def _tables() -> list[np.ndarray]:
    """For 0, 1 and 2 flips: the code words covering a point so far from each 15-bit value; short rows repeat."""
    every = np.arange(1 << 15)
    flips = [[0], [1 << i for i in range(15)], [(1 << i) | (1 << j) for i in range(15) for j in range(i)]]
    out, seen = [], np.empty((len(every), 0), np.int64)
    for masks in flips:
        seen = np.concatenate([seen, *(_decode(every ^ m)[:, None] for m in masks)], axis=1)
        rows = np.sort(seen, axis=1)
        first = np.concatenate([np.ones((len(rows), 1), bool), rows[:, 1:] != rows[:, :-1]], axis=1)
        width = int(first.sum(axis=1).max())
        order = np.argsort(~first, axis=1, kind="stable")[:, :width]
        picked = np.take_along_axis(rows, order, 1)
        kept = np.take_along_axis(first, order, 1)
        out.append(np.where(kept, picked, picked[:, :1]))
    return out


def half_anchors(half: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchors that cover a point within ``reach`` (1 or 2) of each 32-bit half: (position in input, anchor)."""
    one, two, raw = half & 0x7FFF, (half >> 15) & 0x7FFF, half >> 30
    near, masks = _tables(), [[0], [1, 2], [3]]
    parts = []
    for a in range(reach + 1):
        for b in range(reach + 1 - a):
            for flips in range(min(2, reach - a - b) + 1):
                for mask in masks[flips]:
                    both = near[a][one][:, :, None] | (near[b][two] << 15)[:, None, :]
                    parts.append(both.reshape(len(half), -1) | ((raw ^ mask) << 30)[:, None])
    keys = np.sort(np.concatenate(parts, axis=1), axis=1)
    first = np.concatenate([np.ones((len(keys), 1), bool), keys[:, 1:] != keys[:, :-1]], axis=1)
    row, column = np.nonzero(first)
    return row, keys[row, column]


def _halves(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bits = prints.view(np.uint64)
    return (bits >> np.uint64(32)).astype(np.int64), (bits & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _to_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``fp`` -> ``k1, k2, fp``: an anchor of either half; k2 is 0."""
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(prints), 20_000):
            some = prints[at : at + 20_000]
            for which, half in enumerate(_halves(some)):
                row, key = half_anchors(half, 1)
                yield pa.record_batch([pa.array(key | (which << 32)), pa.array(np.zeros(len(key), np.int64)), pa.array(some[row])], ["k1", "k2", "fp"])


def _to_second_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``k1, fp`` -> ``k1, k2, fp``: the anchors of the half that k1 isn't from."""
    for batch in batches:
        first, prints = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        for at in range(0, len(prints), 2_000):
            some, k1 = prints[at : at + 2_000], first[at : at + 2_000]
            high, low = _halves(some)
            row, key = half_anchors(np.where(k1 >> 32 == 0, low, high), 2)
            yield pa.record_batch([pa.array(k1[row]), pa.array(key + 1), pa.array(some[row])], ["k1", "k2", "fp"])


# ---- comparison


def forest(prints: np.ndarray, threshold: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Edges (fingerprint, root) that connect what is linked within ``threshold`` among distinct fingerprints.

    Each component is searched from its first member: whoever is reached leaves the rest, so a
    dense group costs little and nobody is compared twice.
    """
    bits = prints.view(np.uint64)
    rest = np.arange(len(bits))
    ends, roots = [], []
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        front = [root]
        while front and len(rest):
            near = np.bitwise_count(bits[rest] ^ bits[front.pop()]) <= threshold
            if near.any():
                reached = rest[near]
                rest = rest[~near]
                front.extend(reached)
                ends.append(reached)
                roots.append(np.full(len(reached), root))
    if not ends:
        return prints[:0], prints[:0]
    return prints[np.concatenate(ends)], prints[np.concatenate(roots)]


def _compare(most: int):
    """Rows sorted by (k1, k2, fp) -> edges ``u, v`` and, for anchors of over ``most`` rows, ``k1, u`` for another deal."""

    def batch_of(k1: np.ndarray | None, u: np.ndarray, v: np.ndarray | None) -> pa.RecordBatch:
        none = pa.nulls(len(u), pa.int64())
        return pa.record_batch([none if k1 is None else pa.array(k1), pa.array(u), none if v is None else pa.array(v)], ["k1", "u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 3
        passing: tuple[int, int] | None = None  # the anchor whose rows go on unseen

        def settle(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            nonlocal passing
            k1, k2, fp = rows
            if not len(fp):
                return
            cuts = np.flatnonzero((k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])) + 1
            starts, sizes = np.concatenate([[0], cuts]), np.diff(np.concatenate([[0], cuts, [len(fp)]]))
            small = np.repeat(sizes <= 32, sizes)
            run_no = np.repeat(np.arange(len(sizes)), sizes)
            for shift in range(1, min(32, int(sizes.max()))):
                same = np.flatnonzero((run_no[shift:] == run_no[:-shift]) & small[shift:])
                near = same[np.bitwise_count(fp[same].view(np.uint64) ^ fp[same + shift].view(np.uint64)) <= THRESHOLD]
                if len(near):
                    yield batch_of(None, fp[near], fp[near + shift])
            for i in np.flatnonzero(sizes > 32):
                own = slice(starts[i], starts[i] + sizes[i])
                if k2[starts[i]] == 0 and (sizes[i] > most or passing == (k1[starts[i]], 0)):
                    yield batch_of(k1[own], fp[own], None)
                else:
                    yield batch_of(None, *forest(fp[own]))

        for batch in batches:
            new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if not len(new[0]):
                continue
            rows = [np.concatenate([a, b]) for a, b in zip(held, new)]
            k1, k2, fp = rows
            last = (int(k1[-1]), int(k2[-1]))
            if passing is not None:  # the rest of an anchor that is passed on
                own = (k1 == passing[0]) & (k2 == passing[1])
                if own.any():
                    yield batch_of(k1[own], fp[own], None)
                    rows = [x[~own] for x in rows]
                    k1, k2, fp = rows
                if last != passing:
                    passing = None
            if not len(fp):
                held = [np.empty(0, np.int64)] * 3
                continue
            open_from = int(np.flatnonzero((k1 != last[0]) | (k2 != last[1]))[-1]) + 1 if ((k1 != last[0]) | (k2 != last[1])).any() else 0
            yield from settle([x[:open_from] for x in rows])
            held = [x[open_from:] for x in rows]
            if last[1] == 0 and len(held[0]) > most:
                passing = last
                yield batch_of(held[0], held[2], None)
                held = [np.empty(0, np.int64)] * 3
        yield from settle(held)

    return run


def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``u, v``: edges that connect whatever is linked within THRESHOLD among distinct longs ``fp``."""

    def compared(rows: DataFrame) -> DataFrame:
        dealt = rows.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "fp")
        return stored(dealt.mapInArrow(_compare(bucket), "k1 long, u long, v long"))

    found = compared(prints.select("fp").mapInArrow(_to_anchors, "k1 long, k2 long, fp long"))
    hot = found.where("v is null").select("k1", F.col("u").alias("fp"))
    edges = found.where("v is not null")
    if not hot.isEmpty():
        again = compared(hot.mapInArrow(_to_second_anchors, "k1 long, k2 long, fp long"))
        edges = edges.unionByName(again)
    return edges.select("u", "v").distinct()


def clustered(rows: DataFrame, fp: str, member: str) -> DataFrame:
    """Per distinct fingerprint in column ``fp``: ``fp``, and ``first``, the least ``member`` of its component."""
    classes = stored(rows.groupBy(F.col(fp).alias("fp")).agg(F.min(member).alias("own")))
    roots = stored(components(links(classes)))
    linked = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    linked = linked.select("fp", "own", F.coalesce("root", "fp").alias("root"))
    least = stored(linked.groupBy("root").agg(F.min("own").alias("first")))
    return linked.join(least, "root").select("fp", "first")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) and ``component_id`` for each row of ``docs(doc_id, text)``.

    Texts without words, null ones included, have fingerprint zero and are linked like any other.
    Rows with a null doc_id take part and can't name a component; one of only such rows has a null
    id. Repeated rows come out as often as they went in. Whole texts count, however long.
    """
    rows = stored(docs.select("doc_id", fingerprints(F.col("text")).alias("fp")))
    groups = clustered(rows, "fp", "doc_id")
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return rows.join(groups, "fp").select("doc_id", hexed.alias("fingerprint"), F.col("first").alias("component_id"))


def minhashes(text: str | None) -> tuple[int, int, list[int]]:
    """Two hashes of all words of a text, in lower case, and its MinHash bands over five-word shingles."""
    raw = (text or "").encode("utf-8", "replace").lower()
    words, _ = paragraphs.words_in(raw)
    return (*paragraphs.whole_hashes(words), paragraphs.bands_of(paragraphs.shingles_of(words)))


def _to_bands(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        marks = pd.DataFrame([minhashes(t) for t in batch], columns=["h", "h2", "bands"])
        marks["fp"] = np.array([fingerprint(t) for t in batch], dtype=np.uint64).view(np.int64)
        yield marks


def similar_texts(classes: DataFrame, texts: DataFrame, bucket: int = paragraphs.BUCKET) -> DataFrame:
    """``node, root`` for the distinct texts ``classes(node, row, bands, fp)`` that are similar to another one.

    Similar is a Jaccard coefficient of ``paragraphs.SIMILARITY`` over five-word shingles, computed
    exactly for texts whose fingerprints ``fp`` are linked and for what collides in a band: a component
    of fingerprints counts as one more band. Bands that hold the same texts are compared once. A
    node's text is that of ``row`` in ``texts(row, written)``.
    """
    worded = classes.where(F.size("bands") > 0)
    near = worded.join(clustered(worded, "fp", "node"), "fp").select("node", F.xxhash64(F.lit("fp"), "first").alias("k"))
    banded = stored(classes.select("node", F.explode("bands").alias("k")).unionByName(near))
    held = banded.groupBy("k").agg(F.min("node").alias("a"), F.max("node").alias("b"), F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"))
    once = stored(held.where("a <> b").groupBy("a", "b", "n", "x").agg(F.min("k").alias("k")).select("k"))
    bands = banded.join(once, "k", "left_semi").groupBy("node").agg(F.collect_list("k").alias("bands"))
    nodes = stored(classes.select("node", "row").join(stored(bands), "node"))
    return paragraphs.similar_lines(nodes, lambda some: texts.join(some, "row").select("node", "written"), bucket)


@stage
def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each near-duplicate group just the row with the least doc_id (null last, then any one).

    Near is a Jaccard coefficient of at least 0.8 over five-word shingles, checked exactly. Candidates
    are texts whose SimHash fingerprints are linked through anchors, within 4 bits, and, since few such
    pairs are that near, beside them what collides in a MinHash band.
    Texts of the same words are one; those without words, null ones included, are equal.
    """
    marks, row = fresh(docs, "marks", "row")
    marked = F.pandas_udf(_to_bands, "h long, h2 long, bands array<long>, fp long")
    rows = numbered(docs.withColumn(marks, marked(F.col("text"))), row)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"), F.col(row).alias("row"))
    each = rows.select(F.col(f"{marks}.h").alias("h"), F.col(f"{marks}.h2").alias("h2"), F.col(f"{marks}.bands").alias("bands"), F.col(f"{marks}.fp").alias("fp"), order.alias("own"))
    classes = each.groupBy("h", "h2").agg(F.min("own").alias("own"), F.first("bands").alias("bands"), F.first("fp").alias("fp"))
    classes = stored(classes.select("own", "own.row", "bands", "fp", F.monotonically_increasing_id().alias("node")))
    linked = similar_texts(classes, rows.select(F.col(row).alias("row"), F.col("text").alias("written")))
    groups = classes.select("node", "own").join(stored(linked), "node", "left").select("own", F.coalesce("root", "node").alias("root"))
    winners = groups.groupBy("root").agg(F.min("own").alias("first")).select(F.col("first.row").alias(row))
    # most rows stay, so the ids of the others are the smaller side to join the texts with
    others = stored(rows.select(row).join(winners, row, "left_anti"))
    return rows.join(others, row, "left_anti").select(*docs.columns)


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
