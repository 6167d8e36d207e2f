"""Benchmark decontamination by word windows.

Benchmark texts are normalised and cut into windows of ``WORDS`` words; a shorter text is one window.
Their hashes, sorted, form a set that is broadcast with the texts, where these are no more than
``HELD`` bytes. Documents are scanned whole: a text's words are cut and hashed for a block of texts at
once, a window's hash is looked up, and a hit counts only if its words are the same. What is found are
places in the text, so that spans or whole documents can be removed.

A larger benchmark isn't broadcast. Its hashes are reduced to a bitmap of ``SLOTS`` bits, whatever their
number; windows of documents that pass it are joined with the benchmark's by their words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, fresh, numbered, ship, stored, table

#: A word in lower-cased text: digits, a-z and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a window.
WORDS = 10
#: Bytes of normalised benchmark text that are broadcast at most.
HELD = 8 << 20
#: Bits of the map that stands for a larger benchmark; 16 MB.
SLOTS = 1 << 27
#: Bytes of text, about, that are cut at once.
BLOCK = 1 << 21

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_INSIDE = np.zeros(256, bool)
_INSIDE[48:58] = _INSIDE[97:123] = _INSIDE[128:] = True

_BYTE = np.random.default_rng(12).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _STEP = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)
_UNBASE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

FOUND = "n_words long, n_hit long, spans array<struct<start: int, end: int>>, items array<string>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_FOUND = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("spans", _SPANS), ("items", pa.list_(pa.string()))])


class Cut(NamedTuple):
    """The words of some texts: where they start and end in ``raw``, and each text's first word."""

    raw: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    bounds: np.ndarray


def cut(texts: pa.Array) -> Cut:
    """Lower-cased bytes and words of texts; null texts have none. A character beyond ASCII is made of bytes beyond it."""
    kind = pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()
    texts = pc.fill_null(texts, "").cast(kind).cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    raw = _FOLD[whole[offsets[0] : offsets[-1]]]
    bounds = offsets - offsets[0]
    inside = _INSIDE[raw]
    before, after = np.zeros(len(raw), bool), np.zeros(len(raw), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[bounds[bounds < len(raw)]] = False
    after[bounds[bounds > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    return Cut(raw, starts, np.flatnonzero(inside & ~after) + 1, np.searchsorted(starts, bounds), bounds)


def _raised(base: int, n: int) -> np.ndarray:
    if len(_powers.get(base, ())) < n:
        steps = np.full(max(n, BLOCK + 1), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base][:n]


def word_hashes(c: Cut) -> np.ndarray:
    """A number per word that depends on its bytes alone: differences of running sums over blocks of bytes."""
    out = np.empty(len(c.starts), np.uint64)
    at = 0
    while at < len(out):
        low = c.starts[at]
        to = max(at + 1, int(np.searchsorted(c.ends, low + BLOCK, "right")))
        piece = c.raw[low : c.ends[to - 1]]
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_BYTE[piece] * _raised(_BASE, len(piece)), out=sums[1:])
        begin = c.starts[at:to] - low
        out[at:to] = (sums[c.ends[at:to] - low] - sums[begin]) * _raised(_UNBASE, len(piece))[begin]
        at = to
    out ^= out >> np.uint64(32)
    return out * _STEP


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A number per run of ``length`` words, the runs across texts included."""
    n = len(words) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = words[:n] * np.uint64(2 * length + 1)
    for i in range(1, length):
        out = out * _STEP + words[i : n + i]
    return out ^ (out >> np.uint64(31))


def windows_of(c: Cut, words: int, lengths: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per length ``length, first word, hash`` of the benchmark windows in texts, which are cut to one length each."""
    hashed, sizes = word_hashes(c), np.diff(c.first)
    for length in lengths:
        own = np.repeat(sizes >= words if length == words else sizes == length, sizes)
        left = np.repeat(c.first[1:], sizes) - np.arange(len(hashed))
        at = np.flatnonzero(own & (left >= length))
        if len(at):
            yield length, at, window_hashes(hashed, length)[at]


def _bytes_of(c: Cut, raw: bytes, at: int, length: int) -> bytes:
    return b" ".join([raw[s:e] for s, e in zip(c.starts[at : at + length].tolist(), c.ends[at : at + length].tolist())])


class Known:
    """The hash set: per length sorted hashes, each with the place of its window, and the texts it is in."""

    def __init__(self, texts: list[str], ids: list[list[str]], words: int):
        c = cut(pa.array(texts, pa.string()))
        self.raw, self.starts, self.ends, self.ids = c.raw.tobytes(), c.starts, c.ends, ids
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, list[list[int]]]] = {}
        text_of = np.repeat(np.arange(len(texts)), np.diff(c.first))
        lengths = sorted({min(words, int(n)) for n in np.diff(c.first) if n})
        for length, at, hashed in windows_of(c, words, lengths):
            kept_hash, kept_at, kept_in = [], [], []
            order = np.argsort(hashed, kind="stable")
            for h, p in zip(hashed[order].tolist(), at[order].tolist()):
                back = len(kept_hash) - 1
                while back >= 0 and kept_hash[back] == h and self.window(kept_at[back], length) != self.window(p, length):
                    back -= 1
                if back >= 0 and kept_hash[back] == h:
                    if kept_in[back][-1] != text_of[p]:
                        kept_in[back].append(int(text_of[p]))
                else:
                    kept_hash.append(h)
                    kept_at.append(p)
                    kept_in.append([int(text_of[p])])
            self.by_length[length] = (np.array(kept_hash, np.uint64), np.array(kept_at), kept_in)

    def window(self, at: int, length: int) -> bytes:
        return _bytes_of(self, self.raw, at, length)

    def search(self, c: Cut) -> Iterator[tuple[int, int, list[int]]]:
        """``first word, length, texts`` of every window of the set that occurs in the texts."""
        hashed, raw = word_hashes(c), None
        until = np.repeat(c.first[1:], np.diff(c.first))
        for length, (hashes, places, texts) in self.by_length.items():
            here = window_hashes(hashed, length)
            if not len(here):
                continue
            bits = min(26, max(12, int(len(hashes)).bit_length() + 4))
            shift = np.uint64(64 - bits)
            some = np.zeros(1 << bits, bool)
            some[hashes >> shift] = True
            at = np.flatnonzero(some[here >> shift])
            at = at[at + length <= until[at]]
            low, high = np.searchsorted(hashes, here[at]), np.searchsorted(hashes, here[at], "right")
            for i, a, b in zip(at.tolist(), low.tolist(), high.tolist()):
                if a == b:
                    continue
                raw = c.raw.tobytes() if raw is None else raw
                window = _bytes_of(c, raw, i, length)
                for j in range(a, b):
                    if self.window(places[j], length) == window:
                        yield i, length, texts[j]
                        break


def _blocks(texts: pa.Array) -> Iterator[pa.Array]:
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        done = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, done + BLOCK, "right")))
        yield texts.slice(at, to - at)
        at = to


def _characters(c: Cut, text: int, at: np.ndarray) -> np.ndarray:
    """Places in ``raw`` as characters of a text."""
    low, high = c.bounds[text], c.bounds[text + 1]
    begun = np.concatenate([[0], np.cumsum((c.raw[low:high] & 0xC0) != 0x80)])
    return begun[at - low]


def _covered(c: Cut, hits: list[tuple[int, int]]) -> tuple[np.ndarray, dict[int, list[dict[str, int]]]]:
    """Hit words per text, and the spans of characters from first to last hit word of each run."""
    change = np.zeros(len(c.starts) + 1, np.int64)
    for at, length in hits:
        change[at] += 1
        change[at + length] -= 1
    hit = np.cumsum(change[:-1]) > 0
    total = np.concatenate([[0], np.cumsum(hit)])
    counts = total[c.first[1:]] - total[c.first[:-1]]
    spans = {}
    for text in np.flatnonzero(counts).tolist():
        own = np.concatenate([[False], hit[c.first[text] : c.first[text + 1]], [False]])
        edges = np.flatnonzero(own[1:] != own[:-1]) + c.first[text]
        begin = _characters(c, text, c.starts[edges[::2]])
        end = _characters(c, text, c.ends[edges[1::2] - 1])
        spans[text] = [{"start": s, "end": e} for s, e in zip(begin.tolist(), end.tolist())]
    return counts, spans


def scan(texts: pa.Array, known: Known) -> pa.Array:
    """A struct FOUND per text."""
    n_words, n_hit, all_spans, all_items = [], [], [], []
    for block in _blocks(texts):
        c = cut(block)
        found = list(known.search(c))
        counts, spans = _covered(c, [(at, length) for at, length, _ in found])
        items: dict[int, set[str]] = {}
        of = np.searchsorted(c.first, [at for at, _, _ in found], "right") - 1
        for text, (_, _, within) in zip(of.tolist(), found):
            for own in within:
                items.setdefault(text, set()).update(known.ids[own])
        n_words.append(np.diff(c.first))
        n_hit.append(counts)
        all_spans += [spans.get(i, []) for i in range(len(block))]
        all_items += [sorted(items.get(i, ())) for i in range(len(block))]
    whole = lambda parts: pa.array(np.concatenate(parts) if parts else np.empty(0, np.int64), pa.int64())
    columns = [whole(n_words), whole(n_hit), pa.array(all_spans, _SPANS), pa.array(all_items, _FOUND.field("items").type)]
    return pa.StructArray.from_arrays(columns, fields=list(_FOUND))


def items_of(benchmark: DataFrame) -> DataFrame:
    """``words, ids``: distinct normalised texts, as arrays of words, with the ids of their items as strings, none empty."""
    words = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(WORD), F.lit(0))
    rows = benchmark.select(F.col("item_id").cast("string").alias("id"), words.alias("words")).where(F.size("words") > 0)
    return rows.groupBy("words").agg(F.sort_array(F.collect_set("id")).alias("ids"))


def _by_set(docs: DataFrame, items: DataFrame, words: int) -> Column:
    rows = items.select(F.array_join("words", " ").alias("text"), "ids").collect()  # no more than HELD bytes
    known = docs.sparkSession.sparkContext.broadcast(Known([r["text"] for r in rows], [r["ids"] for r in rows], words))

    @F.arrow_udf(FOUND)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield scan(texts, known.value)

    return found(F.col("text"))


def _by_join(docs: DataFrame, items: DataFrame, words: int, slots: int, row: str, name: str) -> DataFrame:
    """``docs``, whose rows ``row`` numbers, with a struct FOUND: windows that pass a bitmap are joined by their words."""
    spark = docs.sparkSession
    lengths = sorted(r[0] for r in items.select(F.least(F.size("words"), F.lit(words))).distinct().collect())
    shift = np.uint64(64 - slots.bit_length() + 1)
    longest = F.least(F.size("words"), F.lit(words))
    places = items.select("ids", "words", F.explode(F.sequence(F.lit(1), F.size("words") - longest + 1)).alias("at"))
    windows = stored(places.select(F.array_join(F.slice("words", F.col("at"), longest), " ").alias("w"), F.explode_outer("ids").alias("id")).distinct())

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = cut(batch.column(0))
            slot = np.concatenate([h >> shift for _, _, h in windows_of(c, words, lengths)] or [np.empty(0, np.uint64)])
            yield pa.record_batch([pa.array((slot >> np.uint64(6)).astype(np.int64)), pa.array(np.left_shift(np.uint64(1), slot & np.uint64(63)).view(np.int64))], ["cell", "bits"])

    cells = windows.select("w").distinct().mapInArrow(bits, "cell long, bits long")
    held = cells.groupBy("cell").agg(F.bit_or("bits").alias("bits")).toPandas()  # at most SLOTS / 64 rows
    filled = np.zeros(max(1, slots >> 6), np.uint64)
    filled[held["cell"].to_numpy(np.int64)] = held["bits"].to_numpy(np.int64).view(np.uint64)
    seen = spark.sparkContext.broadcast(filled)

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, done = batch.column(0).to_numpy(), 0
            for block in _blocks(batch.column(1)):
                c, own = cut(block), rows[done : done + len(block)]
                done += len(block)
                hashed, raw = word_hashes(c), c.raw.tobytes()
                until = np.repeat(c.first[1:], np.diff(c.first))
                for length in lengths:
                    slot = window_hashes(hashed, length) >> shift
                    at = np.flatnonzero(seen.value[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1))
                    at = at[at + length <= until[at]]
                    if not len(at):
                        continue
                    text = np.searchsorted(c.first, at, "right") - 1
                    found = [_bytes_of(c, raw, i, length) for i in at.tolist()]
                    columns = [own[text], at - c.first[text], np.full(len(at), length)]
                    yield pa.record_batch([pa.array(x, pa.int64()) for x in columns] + [pa.array(found, pa.binary()).cast(pa.string())], ["row", "at", "length", "w"])

    texts = docs.select(row, "text")
    met = stored(texts.mapInArrow(passing, "row long, at long, length long, w string"))
    hits = stored(met.join(windows, "w").select("row", "at", "length", "id"))
    # one document's own windows and the items it holds
    of_row = hits.groupBy("row").agg(F.collect_set(F.struct("at", "length")).alias("at"), F.sort_array(F.collect_set("id")).alias("items"))

    @F.pandas_udf(FOUND)
    def placed(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, places, items in batches:
            out = []
            for text, own, ids in zip(texts, places, items):
                c = cut(pa.array([text], pa.string()))
                counts, spans = _covered(c, [(p["at"], p["length"]) for p in own] if own is not None else [])
                out.append((len(c.starts), int(counts[0]), spans.get(0, []), [] if ids is None else list(ids)))
            yield pd.DataFrame(out, columns=["n_words", "n_hit", "spans", "items"])

    own_row, at, ids = fresh(docs, "leak_row", "leak_at", "leak_items")
    joined = docs.join(of_row.select(F.col("row").alias(own_row), F.col("at").alias(at), F.col("items").alias(ids)), F.col(row) == F.col(own_row), "left")
    return joined.withColumn(name, placed("text", at, ids)).drop(own_row, at, ids, row)


def leaks(docs: DataFrame, benchmark: DataFrame, words: int = WORDS, held: int = HELD, slots: int = SLOTS) -> tuple[DataFrame, str]:
    """``docs`` with a struct of what is found of ``benchmark(item_id, text)`` in ``text``, and its name.

    ``n_words`` and ``n_hit`` are the text's words and those in a window, ``spans`` their places in
    characters, one per run of hit words, ``items`` the ids of the items found, as sorted strings. Null
    and empty texts have no words; nor have items without any, which are in nothing. Items that share
    an id count once, and those without an id hit words but are not named. Repeated documents each
    have their row; other columns stay. An empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    ship(spark)
    items = stored(items_of(benchmark))
    size = items.agg(F.sum(F.length(F.encode(F.array_join("words", " "), "utf-8")) + F.length(F.array_join("ids", " ")))).first()[0] or 0
    name, row = fresh(docs, "leak", "row")
    if size <= held:
        return docs.withColumn(name, _by_set(docs, items, words)), name
    return _by_join(numbered(docs, row), items, words, slots, row, name), name


def without(text: Column, spans: Column) -> Column:
    """``text`` less its ``spans``; what stands around them stays as it is."""

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for whole, own in zip(texts, spans):
            for span in reversed(own if whole is not None else ()):
                whole = whole[: span["start"]] + whole[span["end"] :]
            out.append(whole)
        return pd.Series(out, dtype=object)

    return F.when(F.size(spans) > 0, cleaned(text, spans)).otherwise(text)


def clean_documents(docs: DataFrame, benchmark: DataFrame, documents: bool = False, **options) -> DataFrame:
    """``docs`` without the spans found, or with ``documents`` without those that hold any; columns as they are."""
    found, name = leaks(docs, benchmark, **options)
    if documents:
        return found.where(F.col(f"{name}.n_hit") == 0).select(*docs.columns)
    return found.withColumn("text", without(F.col("text"), F.col(f"{name}.spans"))).select(*docs.columns)


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, name = leaks(documents(spark, sf_dir).select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    items = F.col(f"{name}.items")
    return found.select(
        "doc_id",
        f"{name}.n_words",
        f"{name}.n_hit",
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.col(f"{name}.n_hit") > 0).alias("contaminated"),
    )


OP12_SQL = rf"""
WITH item AS (
  SELECT item_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM benchmark WHERE text IS NOT NULL
), win AS MATERIALIZED (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM (
    SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM (SELECT *, least({WORDS}, len(w)) AS k FROM item WHERE len(w) > 0))
), doc AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents
), spot AS (
  SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS g FROM (
    SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc, (SELECT DISTINCT k FROM win))
), hit AS MATERIALIZED (SELECT r, k, i, item_id FROM spot JOIN win USING (k, g)
), covered AS (
  SELECT r, count(DISTINCT i + j) AS n_hit FROM (SELECT r, i, unnest(range(k)) AS j FROM (SELECT DISTINCT r, k, i FROM hit)) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""
