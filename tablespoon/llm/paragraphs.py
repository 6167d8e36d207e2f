"""Substring dedup: MinHash banding of paragraphs, verified by exact Jaccard, clustered by components.

Paragraphs are of two kinds, over words in lower case:

* lines of at least ``WORDS`` words, and paragraphs set over several lines: shorter lines one after
  another, without a blank or a longer line between, that have ``WORDS`` words together. Each has a
  MinHash signature over its five-word shingles, cut into ``BANDS`` bands of ``ROWS`` values, which
  makes a pair of similarity 0.8 collide with probability 0.997. Those of the same words are one
  node, so a group of copies costs one signature.
* passages inside of them or across: windows of ``WORDS`` words at places that their own words
  choose (the least hashed shingle of every ``REACH`` neighbouring ones). Any passage of
  ``WORDS + REACH - 1`` = 50 words has a place chosen alike wherever it occurs. Their band is the
  whole window: they collide if they are equal. They are looked for in what no removed paragraph
  holds, and grow by the words around them that the first occurrence has, too. What is repeated
  beyond a text's last equal window is shorter than ``REACH`` words, or it would hold another one, so
  as many words to each side are enough.

Lines that collide in a band are verified by the Jaccard coefficient of their shingle sets. Within
a band links form a spanning forest, not all pairs; a band's group above ``BUCKET`` lines or
``BUCKET_CHARS`` characters is cut into chunks that are compared two by two in groups of their own. Components of the verified links
are clusters; the earliest paragraph of each stays, the others are to be removed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, stored
from .components import components

WORDS, REACH, SHINGLE = 20, 31, 5
BANDS, ROWS = 8, 3
SIMILARITY = 0.8
#: Lines, and characters in lines, of one band's group that are compared at once.
BUCKET, BUCKET_CHARS = 2_000, 8_000_000
#: Bytes of text that are hashed together, about; a longer document goes alone.
CHUNK = 1 << 20

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, so that they can be divided by
_draw = np.random.default_rng(8)
_BYTES = _draw.integers(0, 1 << 63, 256, dtype=np.uint64)
_A = _draw.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _draw.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_powers: dict[int, np.ndarray] = {}
_CUT = pa.schema([*((c, pa.int64()) for c in ("doc_id", "row", "line", "n_lines", "start", "words", "h", "h2")), ("bands", pa.list_(pa.int64()))])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _power(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 to n, at least, modulo 2**64; kept for the next call."""
    if len(_powers.get(base, ())) <= n:
        out = np.full(max(n + 1, 2 * CHUNK), base, np.uint64)
        out[0] = 1
        _powers[base] = np.multiply.accumulate(out)
    return _powers[base]


def _ranges(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of each range of ``values``, from running sums."""
    until = np.concatenate([[np.uint64(0)], np.add.accumulate(values * _power(base, len(values))[: len(values)])])
    back = _power(pow(base, -1, 1 << 64), len(values))
    return _mix((until[ends] - until[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def words_in(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word of ``raw``, which is in lower case as far as ASCII goes."""
    data = np.frombuffer(raw, np.uint8)
    full = np.concatenate([[False], ~_BLANK[data], [False]])
    edges = np.flatnonzero(full[1:] != full[:-1])
    starts, ends = edges[0::2], edges[1::2]
    return _ranges(_BYTES[data], _BASES[0], starts, ends), starts


def _runs(hashes: np.ndarray) -> np.ndarray:
    """Hash of every five words in a row."""
    at = np.arange(max(0, len(hashes) - SHINGLE + 1))
    return _ranges(hashes, _BASES[1], at, at + SHINGLE)


def shingles(line: str) -> np.ndarray:
    """Distinct hashed shingles of a line; of fewer words than a shingle, all of them as one."""
    return shingles_of(words_in(line.encode("utf-8", "replace").lower())[0])


def shingles_of(hashes: np.ndarray) -> np.ndarray:
    """:func:`shingles` of hashed words."""
    if 0 < len(hashes) < SHINGLE:
        return _ranges(hashes, _BASES[1], np.array([0]), np.array([len(hashes)]))
    return np.unique(_runs(hashes))


def whole_hashes(hashes: np.ndarray) -> list[int]:
    """Two hashes of all hashed words in their order."""
    ends = np.array([0]), np.array([len(hashes)])
    return [int(_ranges(hashes, base, *ends).view(np.int64)[0]) for base in _BASES]


def bands_of(sets: np.ndarray) -> list[int]:
    """MinHash bands of a set of hashed shingles; an empty one has none."""
    if not len(sets):
        return []
    least = np.empty(BANDS * ROWS, np.uint64)
    for f in range(BANDS * ROWS):
        mixed = sets * _A[f] + _B[f]
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(_BASES[1])
        least[f] = mixed.min()
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for row in range(ROWS):
        keys = _mix(keys * np.uint64(_BASES[0]) + least.reshape(BANDS, ROWS)[:, row])
    return keys.view(np.int64).tolist()


def _sliding(values: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` over every ``width`` neighbouring values, by doubling."""
    out, have = values, 1
    while have * 2 <= width:
        out = op(out[:-have], out[have:])
        have *= 2
    return op(out[: len(values) - width + 1], out[width - have : width - have + len(values) - width + 1])


def chosen(runs: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Places that hold the least of some REACH neighbouring values of one document, ascending.

    A document with fewer values than that has its least one chosen.
    """
    out = np.zeros(len(runs), bool)
    if len(runs) >= REACH:
        least = _sliding(runs, REACH, np.minimum)
        least[doc[: len(least)] != doc[REACH - 1 :]] = 0
        padded = np.concatenate([np.zeros(REACH - 1, np.uint64), least, np.zeros(REACH - 1, np.uint64)])
        out = _sliding(padded, REACH, np.maximum) == runs
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.empty(0, np.int64)
    sizes = np.diff(np.append(first, len(doc)))
    for start, size in zip(first[sizes < REACH], sizes[sizes < REACH]):
        out[start + int(runs[start : start + size].argmin())] = True
    return np.flatnonzero(out)


def _paragraphs(doc_ids: list[int | None], row_ids: list[int], texts: list[bytes]) -> pa.RecordBatch | None:
    """The paragraphs of some texts, hashed together: see :func:`_cut`."""
    raw = b"\n".join(texts)
    offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    hashes, at = words_in(raw)
    if not len(hashes):
        return None
    doc = np.searchsorted(offsets, at, "right") - 1
    breaks = np.concatenate([[0], np.add.accumulate(np.frombuffer(raw, np.uint8) == 10, dtype=np.int64)])
    line = breaks[at]  # lines are numbered through the texts
    first_word, past_word = np.searchsorted(doc, np.arange(len(texts))), np.searchsorted(doc, np.arange(len(texts)), "right")

    starts = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
    long = np.diff(np.append(starts, len(line))) >= WORDS
    apart = (doc[starts][1:] != doc[starts][:-1]) | (np.diff(line[starts]) > 1)
    starts = starts[np.concatenate([[True], apart | long[1:] | long[:-1]])]
    sizes = np.diff(np.append(starts, len(line)))
    starts, sizes = starts[sizes >= WORDS], sizes[sizes >= WORDS]
    runs = _runs(hashes)
    keys = np.empty((len(starts), BANDS), np.uint64)
    if len(starts):
        edges = np.empty(2 * len(starts), np.int64)
        edges[0::2], edges[1::2] = starts, starts + sizes - SHINGLE + 1
        padded = np.append(runs, np.uint64(0))
        for band in range(BANDS):
            key = np.full(len(starts), band + 1, np.uint64)
            for f in range(band * ROWS, (band + 1) * ROWS):
                mixed = padded * _A[f] + _B[f]
                mixed ^= mixed >> np.uint64(31)
                mixed *= np.uint64(_BASES[1])
                key = _mix(key * np.uint64(_BASES[0]) + np.minimum.reduceat(mixed, edges)[0::2])
            keys[:, band] = key

    inside = doc[: len(runs)] == doc[SHINGLE - 1 :]
    places = np.flatnonzero(inside)[chosen(runs[inside], doc[: len(runs)][inside])]
    places = places[places + WORDS <= past_word[doc[places]]]

    begin = np.concatenate([starts, places])
    length = np.concatenate([sizes, np.full(len(places), WORDS)])
    if not len(begin):
        return None
    own = doc[begin]
    number = np.concatenate([line[starts] - breaks[offsets[doc[starts]]], np.full(len(places), -1)])
    lines = np.concatenate([line[starts + sizes - 1] - line[starts] + 1, np.zeros(len(places), np.int64)])
    signatures = pa.ListArray.from_arrays(
        pa.array(np.concatenate([np.arange(len(starts) + 1) * BANDS, np.full(len(places), len(starts) * BANDS)]), pa.int32()),
        pa.array(keys.reshape(-1).view(np.int64)),
    )
    top = [_ranges(hashes, base, begin, begin + length).view(np.int64) for base in _BASES]
    columns = [np.array(row_ids, np.int64)[own], number, lines, begin - first_word[own], length, *top]
    ids = pa.array(doc_ids, pa.int64()).take(pa.array(own))
    return pa.record_batch([ids, *(pa.array(c, pa.int64()) for c in columns), signatures], _CUT.names)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, row, text`` -> the paragraphs of each text.

    ``doc_id, row, line, n_lines, start, words, h, h2, bands``: line is the first line's number, or -1
    for a window; start counts words from 0; bands is empty for windows.
    """
    for batch in batches:
        held: tuple[list, list, list] = ([], [], [])
        size = 0
        for doc_id, row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            raw = (text.as_py() or "").encode("utf-8", "replace").lower()
            if size and size + len(raw) > CHUNK:
                if (out := _paragraphs(*held)) is not None:
                    yield out
                held, size = ([], [], []), 0
            for values, value in zip(held, (doc_id, row, raw)):
                values.append(value)
            size += len(raw)
        if held[0] and (out := _paragraphs(*held)) is not None:
            yield out


def _forest(sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Edges (member, root) that connect what is similar among shingle sets; everyone reached leaves the rest."""
    flat, sizes = np.concatenate(sets), np.array([len(s) for s in sets])
    starts = np.concatenate([[0], sizes.cumsum()[:-1]])
    rest, out = np.arange(len(sets)), []
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        front = [root]
        while front and len(rest):
            now = front.pop()
            # a set's size bounds its similarity
            fits = rest[(np.minimum(sizes[rest], sizes[now]) >= similarity * np.maximum(sizes[rest], sizes[now]))]
            if not len(fits):
                continue
            if len(fits) * 4 > len(sets):
                shared = np.add.reduceat(np.isin(flat, sets[now]).astype(np.int64), starts)[fits]
            else:
                shared = np.array([len(np.intersect1d(sets[i], sets[now], assume_unique=True)) for i in fits])
            near = fits[shared >= similarity * (sizes[fits] + sizes[now] - shared) - 1e-9]
            if len(near):
                rest = rest[~np.isin(rest, near)]
                front.extend(near)
                out.extend((int(i), int(root)) for i in near)
    return out


def _compare(most: int, similarity: float):
    """Rows ``k, chunk, node, line`` sorted by (k, chunk) -> edges ``u, v``, and ``k, u`` of groups above ``most``.

    A chunk of -1 is a whole group; groups dealt again by chunks are compared however large.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: tuple[int, int] | None = None
        nodes: list[int] = []
        sets: list[np.ndarray] = []
        passing, held = False, 0
        us: list[int] = []
        vs: list[int] = []

        def settle() -> None:
            for i, j in _forest(sets, similarity) if len(nodes) > 1 else ():
                us.append(nodes[i])
                vs.append(nodes[j])

        def batch_of(k: list, u: list, v: list) -> pa.RecordBatch:
            return pa.record_batch([pa.array(x, pa.int64()) for x in (k, u, v)], ["k", "u", "v"])

        for batch in batches:
            on: tuple[list, list] = ([], [])  # what is passed on
            for i, (k, chunk, node) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)))):
                if (k, chunk) != group:
                    settle()
                    group, nodes, sets, passing, held = (k, chunk), [], [], False, 0
                if passing:
                    on[0].append(k)
                    on[1].append(node)
                    continue
                line = batch.column(3)[i].as_py()
                nodes.append(node)
                sets.append(shingles(line))
                held += len(line)
                if chunk < 0 and len(nodes) > 1 and (len(nodes) > most or held > BUCKET_CHARS):
                    on[0].extend([k] * len(nodes))
                    on[1].extend(nodes)
                    nodes, sets, passing = [], [], True
            if on[0]:
                yield batch_of(on[0], on[1], [None] * len(on[0]))
            if us:
                yield batch_of([None] * len(us), us, vs)
                us, vs = [], []
        settle()
        if us:
            yield batch_of([None] * len(us), us, vs)

    return run


def similar_lines(nodes: DataFrame, texts: Callable[[DataFrame], DataFrame], bucket: int = BUCKET, similarity: float = SIMILARITY) -> DataFrame:
    """``node, root`` for the distinct paragraphs ``nodes(node, bands, ...)`` linked to another one.

    ``texts`` gives ``node, written`` for some of the nodes, which it gets without their bands; a node
    may come more than once.
    """
    banded = nodes.select("node", F.explode("bands").alias("k"))
    shared = banded.groupBy("k").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("k")
    shared = stored(shared)
    met = stored(banded.join(shared, "k", "left_semi").distinct())
    some = stored(nodes.drop("bands").join(met.select("node").distinct(), "node", "left_semi"))
    written = stored(texts(some).dropDuplicates(["node"]))

    def compared(rows: DataFrame) -> DataFrame:
        dealt = rows.repartition("k", "chunk").sortWithinPartitions("k", "chunk", "node").select("k", "chunk", "node", "written")
        return stored(dealt.mapInArrow(_compare(bucket, similarity), "k long, u long, v long"))

    found = compared(met.withColumn("chunk", F.lit(-1).cast("long")).join(written, "node"))
    edges, large = found.where("v is not null"), found.where("v is null").select("k", F.col("u").alias("node"))
    if not large.isEmpty():
        weight = F.ceil(2 * F.sum(F.length("written")) / BUCKET_CHARS)
        chunks = large.join(written, "node").groupBy("k").agg(F.greatest(F.ceil(2 * F.count("*") / bucket), weight).alias("chunks"))
        own = F.pmod(F.xxhash64("node"), F.col("chunks"))
        pairs = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
        again = large.join(chunks, "k").select("k", "node", "chunks", own.alias("own"), pairs.alias("other"))
        again = again.select("k", "node", (F.least("own", "other") * F.col("chunks") + F.greatest("own", "other")).alias("chunk"))
        edges = edges.unionByName(compared(again.join(written, "node")))
    return components(edges.select("u", "v"))


def _written(rows: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """The lines of paragraphs ``some(node, row, line, n_lines)``; each text is read and split once."""

    def of(some: DataFrame) -> DataFrame:
        asked = stored(some.groupBy("row").agg(F.collect_list(F.struct("node", "line", "n_lines")).alias("asked")))
        texts = rows.select("row", "text").join(asked, "row").select(F.split("text", "\n").alias("lines"), "asked")
        each = texts.select("lines", F.explode("asked").alias("a"))
        lines = F.slice("lines", (F.col("a.line") + 1).cast("int"), F.col("a.n_lines").cast("int"))
        return each.select("a.node", F.array_join(lines, "\n").alias("written"))

    return of


def repeats(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """The repeated paragraphs of ``docs(doc_id, text)``: one row per paragraph in a cluster of two or more.

    ``doc_id, line, n_lines, start_word, n_words, cluster, first_doc_id, removed``. ``line`` is the
    number of the paragraph's first line from 0, ``n_lines`` how many lines it has, both null for a
    passage, which may be joined from several that overlap or touch.
    ``cluster`` tells clusters apart within one result, ``first_doc_id`` is the document that keeps
    the paragraph, ``removed`` says whether this one goes. Order is by doc_id (null last), then by
    text and place. A passage in paragraphs that are removed is not listed again, nor a kept one in
    paragraphs that are listed. Null, empty and short texts have no paragraphs; rows that repeat
    doc_id and text are one document; documents without repeats have no row, and an empty table gives none.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("row"), "text")
    longs = ", ".join(f"{c} long" for c in _CUT.names[:-1])
    cut = stored(rows.mapInArrow(_cut, f"{longs}, bands array<long>"))
    end = (F.col("start") + F.col("words")).alias("end")

    # paragraphs: those of equal words are a node, linked nodes a cluster
    lines = cut.where("line >= 0")
    at = F.min(F.struct("row", "line", "n_lines")).alias("at")
    nodes = lines.groupBy("h", "h2").agg(_twice().alias("twice"), at, F.first("bands").alias("bands"))
    nodes = stored(nodes.select("h", "h2", "twice", "at.*", "bands", F.monotonically_increasing_id().alias("node")))
    linked = similar_lines(nodes.drop("h", "h2", "twice"), _written(rows), bucket)
    clusters = nodes.select("node", "h", "h2", "twice").join(linked, "node", "left").where("twice or root is not null")
    clusters = clusters.select("h", "h2", F.coalesce("root", "node").alias("cluster"))
    found = lines.select("doc_id", "row", "line", "n_lines", "start", end, "h", "h2").join(clusters, ["h", "h2"]).drop("h", "h2")
    whole = _judged(stored(found.distinct()))

    # windows: equal ones are a cluster, but for those that go with a paragraph
    windows = cut.where("line < 0").select("doc_id", "row", "start", end, "h", "h2")
    equal = windows.groupBy("h", "h2").agg(_twice().alias("twice")).where("twice")
    equal = stored(equal.select("h", "h2", (-1 - F.monotonically_increasing_id()).alias("cluster")))
    left = _outside(windows.join(equal, ["h", "h2"]).drop("h", "h2"), whole.where("removed"))
    passages = _grown(_judged(stored(left.dropDuplicates(["row", "start"]))), rows)

    gone, stay = passages.where("removed"), _outside(passages.where("not removed"), whole)
    whole = whole.withColumn("n_words", F.col("end") - F.col("start"))
    out = whole.drop("end").unionByName(_joined(gone.unionByName(stay)), allowMissingColumns=True)
    return out.select("doc_id", "line", "n_lines", F.col("start").alias("start_word"), "n_words", "cluster", "first_doc_id", "removed")


def _twice() -> Column:
    """Whether a group's paragraphs are in two places."""
    spot = F.xxhash64("row", "start")
    return F.min(spot) != F.max(spot)


def _judged(found: DataFrame) -> DataFrame:
    """``found(doc_id, row, start, cluster, ...)`` in clusters of two or more, with ``first_doc_id`` and ``removed``."""
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "start")
    first = stored(found.groupBy("cluster").agg(F.min(order).alias("first"), _twice().alias("twice")).where("twice").drop("twice"))
    marked = found.join(first, "cluster").withColumn("removed", order != F.col("first"))
    return stored(marked.withColumn("first_doc_id", F.col("first.doc_id")).drop("first"))


def _outside(passages: DataFrame, whole: DataFrame) -> DataFrame:
    """``passages(row, start, end, ...)`` that paragraphs ``whole(row, start, end)`` don't cover.

    Paragraphs one after another cover what lies across their borders, too. A text's are ordered in
    one group, which is bounded by the text.
    """
    by = Window.partitionBy("row").orderBy("start", "end")
    until = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    runs = whole.select("row", "start", "end").withColumn("opens", F.coalesce((F.col("start") > until).cast("int"), F.lit(1)))
    runs = runs.withColumn("run", F.sum("opens").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.groupBy("row", "run").agg(F.min("start").alias("start"), F.max("end").alias("reach")).drop("run")
    both = passages.withColumn("reach", F.lit(None).cast("long")).unionByName(runs, allowMissingColumns=True)
    earlier = Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("covered", F.max("reach").over(earlier))
    return both.where("reach is null and end > coalesce(covered, 0)").drop("reach", "covered")


def _around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``row, text, places`` -> each window's REACH words before it, nearest first, and after it, as hashes; 0 is no word."""
    for batch in batches:
        out: list[tuple] = []
        for row, text, places in zip(*(c.to_pylist() for c in batch.columns)):
            words, none = words_in(text.encode("utf-8", "replace").lower())[0], np.zeros(REACH, np.uint32)
            words = np.concatenate([none, words.astype(np.uint32) | np.uint32(1), none])
            at = np.array([p["start"] for p in places])[:, None] + REACH
            before, after = words[at - 1 - np.arange(REACH)], words[at + WORDS + np.arange(REACH)]
            out.extend((row, p["start"], p["cluster"], p["removed"], b.tobytes(), a.tobytes()) for p, b, a in zip(places, before, after))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary()]
        columns = zip(*out) if out else [()] * len(types)
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], ["row", "start", "cluster", "removed", "before", "after"])


def alike(own: pd.Series, first: pd.Series) -> pd.Series:
    """How many words agree from the first one on."""
    a, b = (np.frombuffer(b"".join(x), np.uint32).reshape(-1, REACH) for x in (own, first))
    same = (a == b) & (a != 0)
    return pd.Series(np.where(same.all(axis=1), REACH, same.argmin(axis=1)))


def _grown(passages: DataFrame, rows: DataFrame) -> DataFrame:
    """Windows with the words around them that a removed one shares with its cluster's first.

    Only windows that no neighbour overlaps or touches on a side are compared. The first one of a cluster grows
    by what it shares with any other.
    """
    near = Window.partitionBy("row", "removed").orderBy("start")
    alone = F.coalesce(F.lag("end").over(near) < F.col("start"), F.lit(True)) | F.coalesce(F.lead("start").over(near) > F.col("end"), F.lit(True))
    ends = stored(passages.withColumn("alone", alone).where("removed and alone").select("row", "start", "cluster", "removed"))
    firsts = passages.where("not removed").select("row", "start", "cluster", "removed")
    firsts = firsts.join(ends.select("cluster").distinct(), "cluster", "left_semi")
    places = ends.unionByName(firsts).groupBy("row").agg(F.collect_list(F.struct("start", "cluster", "removed")).alias("places"))
    texts = rows.select("row", "text").join(stored(places), "row").select("row", "text", "places")
    around = stored(texts.mapInArrow(_around, "row long, start long, cluster long, removed boolean, before binary, after binary"))
    first = around.where("not removed").groupBy("cluster").agg(F.first("before").alias("first_before"), F.first("after").alias("first_after"))
    shared = F.pandas_udf(alike, "long")
    grown = around.where("removed").join(stored(first), "cluster").select("row", "start", "cluster", shared("before", "first_before").alias("left"), shared("after", "first_after").alias("right"))
    grown = stored(grown.dropDuplicates(["row", "start"]))
    most = stored(grown.groupBy("cluster").agg(F.max("left").alias("left"), F.max("right").alias("right")))
    gone = passages.where("removed").join(grown.drop("cluster"), ["row", "start"], "left")
    both = gone.unionByName(passages.where("not removed").join(most, "cluster", "left"))
    wider = {"start": F.col("start") - F.coalesce("left", F.lit(0)), "end": F.col("end") + F.coalesce("right", F.lit(0))}
    return stored(both.withColumns(wider).drop("left", "right"))


def _joined(passages: DataFrame) -> DataFrame:
    """Passages of a text that overlap or touch and share a fate as one."""
    same = Window.partitionBy("row", "removed").orderBy("start", "end", "cluster")
    until = F.max("end").over(same.rowsBetween(Window.unboundedPreceding, -1))
    run = F.sum("opens").over(same.rowsBetween(Window.unboundedPreceding, 0))
    opened = passages.withColumn("opens", F.coalesce((F.col("start") > until).cast("int"), F.lit(1))).withColumn("run", run)
    joined = opened.groupBy("row", "removed", "run").agg(
        F.first("doc_id").alias("doc_id"),
        F.min("start").alias("start"),
        (F.max("end") - F.min("start")).alias("n_words"),
        F.min_by("cluster", "start").alias("cluster"),
        F.min_by("first_doc_id", "start").alias("first_doc_id"),
    )
    return joined.drop("run")


def op8_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(documents(spark, sf_dir))
