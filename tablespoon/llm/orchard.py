"""Centroid clustering whose nearest centroids are found by Orchard's search.

Every centroid has the list of the others, nearest first. A vector starts at centroid 0 and goes
along its list; at a closer centroid it jumps to that one's list, past those it has visited. By the
triangle inequality it can stop at a neighbour that is strictly beyond twice its current distance: all
later ones are farther from it than the current one. Vectors and centroids are whole numbers,
so distances, ties and means are exact and reruns agree.

Centroids and their lists are small (their number is a parameter) and go out with the tasks; a task
sends back sums per centroid, never vectors, so a cluster of any size is no more work than its rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship, stored, table

CENTROIDS, ROUNDS, DIMS, SCALE = 40, 5, 64, 256
#: Whole components beyond this size count as this; squared distances stay below 2^60.
LARGEST = 1 << 26


def lists_of(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per centroid all centroids by distance, itself first and ties by number, and the squared distances.

    A last column that lies beyond everything ends each list.
    """
    apart = np.stack([((centroids - c) ** 2).sum(axis=1) for c in centroids])
    apart[np.diag_indices(len(centroids))] = -1  # itself before copies of it
    order = np.argsort(apart, axis=1, kind="stable")
    gaps = np.take_along_axis(apart, order, axis=1)
    end = np.full((len(centroids), 1), np.iinfo(np.int64).max)
    return np.hstack([order, np.zeros_like(end)]), np.hstack([gaps, end])


def search(vectors: np.ndarray, centroids: np.ndarray, lists: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """Each vector's nearest centroid, ties to the smaller number, its squared distance, and how many distances that took."""
    order, gaps = lists
    n = len(vectors)
    current, at = np.zeros(n, np.int64), np.ones(n, np.int64)
    distance = ((vectors - centroids[0]) ** 2).sum(axis=1)
    visited = np.zeros((n, len(centroids)), bool)
    visited[:, 0] = True
    active, taken = np.arange(n), n
    while len(active):
        own, place = current[active], at[active]
        going = gaps[own, place] <= 4 * distance[active]
        active, neighbour = active[going], order[own, place][going]
        at[active] += 1
        new = ~visited[active, neighbour]
        here, other = active[new], neighbour[new]
        visited[here, other] = True
        found = ((vectors[here] - centroids[other]) ** 2).sum(axis=1)
        taken += len(here)
        better = (found < distance[here]) | ((found == distance[here]) & (other < current[here]))
        here = here[better]
        current[here], distance[here], at[here] = other[better], found[better], 1
    return current, distance, taken


def whole_vectors(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """``vec_id, x``: vectors of ``dims`` components, none null or non-finite, each as floor(scale * component)."""
    parts = F.transform("embedding", lambda c: c.cast("double"))
    fine = F.forall("parts", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    # outside of the range of doubles a product would be infinite, which is above the bound as well
    whole = F.transform("parts", lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(float(LARGEST))), F.lit(float(-LARGEST)))).cast("int"))
    rows = vectors.select("vec_id", parts.alias("parts")).where(F.size("parts") == dims).where(fine)
    return rows.select("vec_id", whole.alias("x"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.int64)


def _moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round; a task sends their sums, which the driver gets added up."""
    lists, dims, k = lists_of(centroids), centroids.shape[1], len(centroids)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            own = search(x, centroids, lists)[0]
            np.add.at(total, own, x)
            count += np.bincount(own, minlength=k)
        filled = np.flatnonzero(count)
        columns = [np.repeat(filled, dims), np.tile(np.arange(dims), len(filled)), total[filled].ravel(), np.repeat(count[filled], dims)]
        yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["cluster", "dim", "total", "n"])

    partial = rows.select("x").mapInArrow(sums, "cluster long, dim long, total long, n long")
    moved = centroids.copy()
    for r in partial.groupBy("cluster", "dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():  # k * dims rows
        moved[r["cluster"], r["dim"]] = r["total"] // r["n"]
    return moved


def starts(rows: DataFrame, centroids: int, dims: int = DIMS) -> np.ndarray:
    """The vectors with the smallest sha256 of ``2:<vec_id>``, ties by vector; rows without an id come last."""
    hashed = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    first = rows.select(hashed.alias("hash"), "x").orderBy(F.asc_nulls_last("hash"), "x").limit(centroids).collect()
    return np.array([r["x"] for r in first], np.int64).reshape(-1, dims)


def clusters(vectors: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, cluster, distance`` of ``vectors(vec_id, embedding)``, and the centroids.

    Vectors that are null, hold null or non-finite components or have another length than ``dims`` take
    no part. Components too large for exact distances (2^26 after scaling) count as that large. Repeated
    rows each count; ties go to the smaller centroid; a centroid that no vector is nearest to stays. With
    fewer vectors than ``centroids`` each starts one. Without any the result is empty. Other columns of
    ``vectors`` are left out.
    """
    ship(vectors.sparkSession)
    rows = stored(whole_vectors(vectors, dims, scale))
    middle = starts(rows, centroids, dims)
    schema = f"vec_id {dict(rows.dtypes)['vec_id']}, cluster int, distance long"
    if not len(middle):
        return rows.sparkSession.createDataFrame([], schema), middle
    for _ in range(rounds):
        middle = _moved(rows, middle)
    lists = lists_of(middle)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, distance, _ = search(_matrix(batch.column(1), dims), middle, lists)
            yield pa.record_batch([batch.column(0), pa.array(own, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"])

    return rows.mapInArrow(assign, schema), middle


def op13_orchard_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = clusters(table(spark, sf_dir, "embeddings"))
    found = stored(found)
    inertia = {r["cluster"]: int(r["inertia"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()}
    within = lambda n: n if n < 1 << 63 else None
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(i, within(inertia.get(i, 0)), within(sum(inertia.values())), name) for i, name in enumerate(names)]
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # a row per centroid
    return found.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    distance = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"

    def assigned(i: int) -> str:
        return f"""a{i} AS MATERIALIZED (
  SELECT r, any_value(vec_id) AS vec_id, any_value(x) AS x, arg_min(cluster, (CAST(d AS HUGEINT), cluster)) AS cluster, min(d) AS d
  FROM (SELECT r, vec_id, x, cluster, CAST({distance} AS BIGINT) AS d FROM kept, c{i}) GROUP BY r
)"""

    def moved(i: int) -> str:
        return f"""c{i + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(m, c) AS c FROM c{i} LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS m FROM (
      SELECT cluster, i, CAST(sum(v) AS BIGINT) AS s, count(*) AS n FROM (
        SELECT cluster, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM a{i}) GROUP BY cluster, i)
    GROUP BY cluster) USING (cluster)
)"""

    rounds = ",\n".join(f"{assigned(i)}, {moved(i)}" for i in range(ROUNDS))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: CAST(floor(greatest(least({SCALE} * CAST(e AS DOUBLE), {LARGEST}), -{LARGEST})) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {DIMS}
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY s NULLS LAST, x) - 1 AS cluster, x AS c FROM (
    SELECT sha256('2:' || CAST(vec_id AS VARCHAR)) AS s, x FROM kept ORDER BY s NULLS LAST, x LIMIT {CENTROIDS})
), {rounds}, {assigned(ROUNDS)}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} USING (cluster)
"""


OP13_SQL = _sql()
