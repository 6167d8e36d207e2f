"""Nearest neighbours along shifted Hilbert curves.

Every curve turns the vectors by a rotation of its own, keeps a few axes, spreads them evenly,
shifts them and numbers their cells along a Hilbert curve. Spark range-partitions the vectors by
curve and key; a vector's rank on a curve is its partition's offset plus its place there. Ranks are
cut into blocks of ``BLOCK``. A query looks through its own block and the two next to it on each
curve, so at least ``BLOCK`` neighbours on either side, and what it finds there is ranked by the
exact distance. Groups are bounded: a block, and the queries of three blocks.

The windows cover less of a table the larger it is, so their answers only bound the distance. In a
second pass the blocks of the first curve, each with its centre and radius, meet the queries, up to
about ``ASKED`` at once; a query searches every block that can hold something as near as its bound.
So no neighbour is missed whatever the table's size. Where vectors are spread evenly over many
dimensions no block can be left out, and the pass compares all queries with all vectors.

Equal vectors are one point. Ties go to the smaller vec_id, so of the ids at a point no more than
the ``k + 1`` smallest can be in any answer; the others are searched for, never answers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table
from .hilbert import hilbert_key

CURVES, AXES, BITS, BLOCK = 16, 8, 7, 2048
#: Queries, about, that a block is searched for at once.
ASKED = 2048
#: Vectors, about, from which means and spreads of the axes are estimated.
FITTED = 10_000
SEED = 20


def _fit(points: DataFrame, dims: int, curves: int, axes: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per curve: projection, offset and shift. The sample is some FITTED points, drawn by their hash."""
    share = min(1.0, FITTED / points.count())
    some = points.where(F.pmod(F.xxhash64("packed"), F.lit(1 << 20)) <= int(share * (1 << 20))).select("packed").toPandas()["packed"]
    if not len(some):
        some = points.select("packed").limit(FITTED).toPandas()["packed"]
    sample = np.frombuffer(b"".join(map(bytes, some)), "<f8").reshape(-1, dims)
    draw = np.random.default_rng(SEED)
    out = []
    for _ in range(curves):
        turned = np.linalg.qr(draw.normal(size=(dims, dims)))[0][:, :axes]
        seen = sample @ turned
        spread = np.where(seen.std(axis=0) > 0, seen.std(axis=0), 1.0)
        out.append((turned / spread, seen.mean(axis=0) / spread, draw.random(turned.shape[1]) * 0.25))
    return out


def _keys(vectors: np.ndarray, curve: tuple[np.ndarray, np.ndarray, np.ndarray], bits: int) -> np.ndarray:
    project, offset, shift = curve
    even = 1 / (1 + np.exp(np.clip(-1.702 * (vectors @ project - offset), -500, 500)))
    cells = np.floor((even + shift) / 1.25 * (1 << bits)).astype(np.int64)
    return hilbert_key(np.clip(cells, 0, (1 << bits) - 1), bits)


def _distances(found: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances, the squares added in the order of the components."""
    return np.sqrt(np.add.accumulate((found - query) ** 2, axis=1)[:, -1])


def points_of(vectors: DataFrame, k: int) -> tuple[DataFrame, int]:
    """``point, ids, packed, h, h2`` per distinct vector, and the number of components.

    ``point`` numbers the vectors in order of their least id, ``ids`` are their k + 1 least,
    ``packed`` their doubles. Vectors that are null, zero or hold null or non-finite components, and
    rows without an id, take no part, nor do vectors of another length than most have (the longest,
    at a tie).
    """
    parts = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))
    fine = F.forall("parts", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("parts", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), parts.alias("parts"))
    rows = stored(rows.where("vec_id is not null and parts is not null").where(fine).distinct())
    lengths = rows.groupBy(F.size("parts").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    dims = lengths["dims"] if lengths else 1
    rows = rows.where(F.size("parts") == dims).withColumns({"h": F.xxhash64("parts"), "h2": F.xxhash64(F.lit(1), "parts")})
    turn = F.row_number().over(Window.partitionBy("h", "h2").orderBy("vec_id"))
    few = rows.withColumn("turn", turn).where(F.col("turn") <= k + 1)
    found = few.groupBy("h", "h2").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("parts").alias("parts"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(3).flatten().to_numpy(zero_copy_only=False).astype("<f8").reshape(-1, dims)
            yield pa.record_batch([batch.column(0), batch.column(1), batch.column(2), pa.array([x.tobytes() for x in flat], pa.binary())], ["h", "h2", "ids", "packed"])

    packed = stored(found.select("h", "h2", "ids", "parts").mapInArrow(pack, "h long, h2 long, ids array<long>, packed binary"))
    return stored(packed.orderBy(F.element_at("ids", 1), "h", "h2").withColumn("point", F.monotonically_increasing_id())), dims


def ranked(points: DataFrame, fitted: list, bits: int) -> DataFrame:
    """``curve, rank, point, packed``: every point's exact rank on every curve."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column(1)
            vectors = np.frombuffer(b"".join(packed.to_pylist()), "<f8").reshape(batch.num_rows, -1)
            for number, curve in enumerate(fitted):
                keys = _keys(vectors, curve, bits)
                yield pa.record_batch([pa.array(np.full(len(keys), number, np.int32)), pa.array(keys), batch.column(0), packed], ["curve", "key", "point", "packed"])

    keyed = stored(points.select("point", "packed").mapInArrow(key, "curve int, key long, point long, packed binary"))
    parts = max(len(fitted), int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = keyed.repartitionByRange(parts, "curve", "key", "point").sortWithinPartitions("curve", "key", "point")
    # ids count up within a partition, in its order
    dealt = stored(dealt.select("curve", "point", "packed", F.monotonically_increasing_id().alias("id")))
    part = F.shiftright("id", 33).alias("part")
    sizes = dealt.groupBy("curve", part).agg(F.count("*").alias("n"), F.min("id").alias("least"))
    before = F.sum("n").over(Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = stored(sizes.select("curve", "part", "least", F.coalesce(before, F.lit(0)).alias("before")))
    joined = dealt.withColumn("part", part).join(offsets, ["curve", "part"])
    return joined.select("curve", (F.col("before") + F.col("id") - F.col("least")).alias("rank"), "point", "packed")


def _closer(most: int):
    """Rows of a block and some queries -> ``q, point, score``: what the block holds within the queries' bounds.

    Per query no more than the ``most`` nearest of the block, ties to the smaller point.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, found, centre, radius, ids, queries, bounds in zip(*(batch.column(c) for c in range(7))):
                centre, bounds = np.frombuffer(centre.as_py(), "<f8"), np.frombuffer(bounds.as_py(), "<f8")
                queries = np.frombuffer(queries.as_py(), "<f8").reshape(-1, len(centre))
                away = np.sqrt(((queries - centre) ** 2).sum(axis=1))
                far = away + radius.as_py()
                asked = np.flatnonzero(away - radius.as_py() <= bounds + 1e-9 * far)
                if not len(asked):
                    continue
                names, ids = np.frombuffer(names.as_py(), "<i8"), np.frombuffer(ids.as_py(), "<i8")
                found = np.frombuffer(found.as_py(), "<f8").reshape(-1, len(centre))
                moved, out = found - centre, ([], [], [])
                square = (moved**2).sum(axis=1)
                for at in range(0, len(asked), 256):
                    some = asked[at : at + 256]
                    rough = square[None, :] - 2 * (queries[some] - centre) @ moved.T + (away[some] ** 2)[:, None]
                    limit = bounds[some] ** 2
                    if most < len(found):
                        limit = np.minimum(limit, np.partition(rough, most - 1, axis=1)[:, most - 1])
                    # far more than products in doubles can be off by
                    near = rough <= (limit + 1e-9 * far[some] ** 2)[:, None]
                    for i in np.flatnonzero(near.any(axis=1)):
                        own = np.flatnonzero(near[i])
                        exact = _distances(found[own], queries[some[i]])
                        first = np.lexsort((names[own], exact))[:most]
                        first = first[exact[first] <= bounds[some[i]]]
                        out[0].append(np.full(len(first), ids[some[i]]))
                        out[1].append(names[own][first])
                        out[2].append(exact[first])
                if out[0]:
                    yield pa.record_batch([pa.array(np.concatenate(x)) for x in out], ["q", "point", "score"])

    return run


def _remaining(rows: DataFrame, best: DataFrame, most: int, asked: int) -> DataFrame:
    """``q, point, score`` of all points as near as the last of a query's ``most`` in ``best(q, point, score)``.

    ``rows(block, point, packed, asks)`` are the points along one curve. Blocks and groups of queries
    are a row each and meet in pairs, of which the search skips those that are too far apart.
    """

    def block(group: pd.DataFrame) -> pd.DataFrame:
        every = np.frombuffer(b"".join(map(bytes, group["packed"])), "<f8").reshape(len(group), -1)
        centre = every.mean(axis=0)
        radius = np.sqrt(((every - centre) ** 2).sum(axis=1)).max()
        return pd.DataFrame({"names": [group["point"].to_numpy("<i8").tobytes()], "found": [every.tobytes()], "centre": [centre.tobytes()], "radius": [radius]})

    def queries(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"ids": [group["point"].to_numpy("<i8").tobytes()], "queries": [b"".join(map(bytes, group["packed"]))], "bounds": [group["bound"].to_numpy("<f8").tobytes()]})

    blocks = stored(rows.groupBy("block").applyInPandas(block, "names binary, found binary, centre binary, radius double"))
    last = F.when(F.count("*") >= most, F.max("score")).otherwise(F.lit(float("inf"))).alias("bound")
    bounds = best.groupBy("q").agg(last)
    seeking = rows.where("asks").join(bounds, F.col("point") == F.col("q"), "left").fillna(float("inf"), "bound")
    seeking = stored(seeking.select("point", "packed", "bound"))
    groups = max(1, -(-seeking.count() // asked))
    dealt = seeking.withColumn("dealt", F.pmod(F.xxhash64("point"), F.lit(groups)))
    sought = stored(dealt.groupBy("dealt").applyInPandas(queries, "ids binary, queries binary, bounds binary"))
    return blocks.crossJoin(sought).mapInArrow(_closer(most), "q long, point long, score double")


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, curves: int = CURVES, axes: int = AXES, bits: int = BITS, block: int = BLOCK, exact: bool = True) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found for the rows of ``vectors(vec_id, embedding)`` that are queries.

    ``is_query`` is a condition on vec_id. The score is the Euclidean distance in doubles; ties go
    to the smaller vec_id, and a query is never its own answer. Rows that repeat an id and its
    vector count once. The answer is exact where an id has one vector; ``curves``, ``axes``, ``bits`` and ``block`` change how
    much is searched, not what is found. ``exact=False`` leaves out the second pass, so that only what
    lies in a query's windows is found. With fewer than k candidates all come out. Without vectors
    the result is empty.
    """
    points, dims = points_of(vectors, k)
    fitted = _fit(points, dims, curves, min(axes, dims)) if points.take(1) else []
    asked = vectors.where("vec_id is not null").where(is_query).select(
        F.col("vec_id").cast("long").alias("query_id"), F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0)).alias("parts")
    )
    asked = asked.select("query_id", F.xxhash64("parts").alias("h"), F.xxhash64(F.lit(1), "parts").alias("h2")).distinct()
    asked = stored(asked.join(points.select("h", "h2", "point"), ["h", "h2"]).select("query_id", "point"))
    sought = asked.select("point").distinct().withColumn("asks", F.lit(True))

    rows = ranked(points, fitted, bits) if fitted else points.select(F.lit(0).alias("curve"), F.lit(0).cast("long").alias("rank"), "point", "packed")
    rows = stored(rows.join(sought, "point", "left").withColumn("block", F.floor(F.col("rank") / block)))
    base = rows.select("curve", "block", "point", "packed", F.lit(False).alias("asks"))
    around = F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1))
    probes = rows.where("asks").select("curve", around.alias("block"), "point", "packed", F.lit(True).alias("asks"))
    # blocks without a query have nothing to answer
    used = probes.select("curve", "block").distinct()
    base = base.join(used, ["curve", "block"], "left_semi")
    most = k + 2

    def search(group: pd.DataFrame) -> pd.DataFrame:
        asks = group["asks"].to_numpy()
        every = np.frombuffer(b"".join(map(bytes, group["packed"])), "<f8").reshape(len(group), -1)
        names, queries, ids = group["point"].to_numpy()[~asks], every[asks], group["point"].to_numpy()[asks]
        found = every[~asks]
        out_q, out_p, out_d = [], [], []
        if len(found):
            square = (found**2).sum(axis=1)
            for at in range(0, len(queries), 256):
                some = queries[at : at + 256]
                rough = square[None, :] - 2 * some @ found.T
                width = min(len(found), 4 * most)
                near = np.argpartition(rough, width - 1, axis=1)[:, :width] if width < len(found) else np.tile(np.arange(len(found)), (len(some), 1))
                for i, own in enumerate(near):
                    exact = _distances(found[own], some[i])
                    first = np.lexsort((names[own], exact))[:most]
                    out_q.append(np.full(len(first), ids[at + i]))
                    out_p.append(names[own][first])
                    out_d.append(exact[first])
        if not out_q:
            return pd.DataFrame({"q": pd.Series(dtype="int64"), "point": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        return pd.DataFrame({"q": np.concatenate(out_q), "point": np.concatenate(out_p), "score": np.concatenate(out_d)})

    met = base.unionByName(probes).groupBy("curve", "block").applyInPandas(search, "q long, point long, score double")

    def first(met: DataFrame) -> DataFrame:
        met = met.groupBy("q", "point").agg(F.min("score").alias("score"))
        turn = F.row_number().over(Window.partitionBy("q").orderBy("score", "point"))
        return met.withColumn("turn", turn).where(F.col("turn") <= most).drop("turn")

    best = stored(first(met))
    if exact:
        along = rows.where("curve = 0").select("block", "point", "packed", F.col("asks").isNotNull().alias("asks"))
        best = first(best.unionByName(_remaining(along, best, most, ASKED)))
    named = stored(best.join(points.select("point", "ids"), "point").select("q", "score", F.explode("ids").alias("vec_id")))
    answers = asked.join(named, asked["point"] == named["q"]).where("vec_id <> query_id")
    # an id with several vectors counts with its nearest
    answers = answers.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op10_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP10_SQL = """
WITH cast_up AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
), fine AS (
  SELECT vec_id, e FROM cast_up
  WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), vectors AS (
  SELECT vec_id, e FROM fine WHERE len(e) = (SELECT len(e) FROM fine GROUP BY len(e) ORDER BY count(*) DESC, len(e) DESC LIMIT 1)
), scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, min(sqrt(list_reduce(list_transform(list_zip(q.e, v.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda a, b: a + b))) AS score
  FROM vectors AS q JOIN vectors AS v ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id GROUP BY ALL
), placed AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS place, vec_id, score FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM placed WHERE place <= 10
"""
