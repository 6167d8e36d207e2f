"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The distinct vectors, as whole numbers, are the fit list; its sums are exact, so its rows are centred
without rounding off what they have in common. With X the centred rows over the root of their number,
a step takes a direction v, multiplies it by X (a number per row) and that by X transposed, in one
pass over the stored rows: a task sends sums as long as a row, never rows. The vectors Xv are as long as
the table, so none is kept: each is X times a known short vector, from which a task computes its
part anew. They are reorthogonalised in full against all before them, by products measured in the same
pass, and the directions v on the driver, twice.

The steps go on until the directions span all that the rows do, so no eigenvalue is missed, not even a
repeated one; where a step ends in nothing a new direction is drawn. Then X = U R V' with a small R,
bidiagonal up to rounding, whose singular values are the deviations and whose right singular
vectors turn V into the components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship, stored, table

COMPONENTS, SCALE, OFFSET = 16, 64, 1_000_000
#: Larger entries count as this; whole components stay below 2^60.
LARGEST = float(1 << 53)
#: Rows of the fit list that are stored as one block.
BLOCK = 1024
SEED = 11
#: What counts as nothing, against the root of the trace.
NOTHING = 1e-13

_LONG = 1 << 63


class Whitening(NamedTuple):
    """The fit: rows, sums per dimension, and per component its vector, eigenvalue and share of the trace."""

    n: int
    sums: list[int]
    components: np.ndarray  # dims by components
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float


def whole_rows(vectors: DataFrame) -> DataFrame:
    """``vec_id, x``: vectors without null or non-finite entries, each entry as floor(SCALE * entry) + OFFSET."""
    parts = F.transform("embedding", lambda c: c.cast("double"))
    fine = F.forall("parts", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & (F.size("parts") > 0)
    whole = F.transform("parts", lambda c: F.floor(F.greatest(F.least(c, F.lit(LARGEST)), F.lit(-LARGEST)) * SCALE).cast("long") + OFFSET)
    return vectors.select("vec_id", parts.alias("parts")).where("parts is not null").where(fine).select("vec_id", whole.alias("x"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def from_mean(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exactly: longs, or Python's integers where longs are too short."""
    most = int(np.abs(x).max(initial=0)) * n + max(map(abs, sums), default=0)
    if most < _LONG:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def deviations(moved: np.ndarray) -> list[int | None]:
    """The squares' sum of each row, exactly; None if no long holds it."""
    most = max(map(abs, (int(moved.min()), int(moved.max())))) if moved.size else 0
    exact = moved if moved.dtype == object or most**2 * moved.shape[1] < _LONG else moved.astype(object)
    return [int(s) if s < _LONG else None for s in (exact**2).sum(axis=1)] if moved.size else []


def _sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Rows, and sums per dimension; high and low halves add up apart so that no long overflows."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            columns = [np.arange(dims), high, low, np.full(dims, len(x))]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["dim", "high", "low", "n"])

    whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    rows = fit.mapInArrow(part, "dim long, high long, low long, n long").groupBy("dim").agg(*map(whole, ("high", "low", "n"))).collect()  # dims rows
    sums = [0] * dims
    for r in rows:
        sums[r["dim"]] = (int(r["high"]) << 32) + int(r["low"])
    return int(rows[0]["n"]) if rows else 0, sums


def _centred(fit: DataFrame, dims: int, n: int, sums: list[int]) -> DataFrame:
    """``block``: the centred rows as doubles, up to BLOCK in one value."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = from_mean(_matrix(batch.column(0), dims), n, sums).astype("<f8") / n
            yield pa.record_batch([pa.array([rows[i : i + BLOCK].tobytes() for i in range(0, len(rows), BLOCK)], pa.binary())], ["block"])

    return stored(fit.mapInArrow(pack, "block binary"))


def summed(blocks: DataFrame, dims: int, of: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum of ``of(rows)``, ``size`` numbers, over all blocks: a task adds up its own, Spark adds up the tasks'."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for block in batch.column(0):
                total += of(np.frombuffer(block.as_buffer(), "<f8").reshape(-1, dims))
        yield pa.record_batch([pa.array(np.arange(size)), pa.array(total)], ["at", "total"])

    out = np.zeros(size)
    for r in blocks.mapInArrow(part, "at long, total double").groupBy("at").agg(F.sum("total").alias("total")).collect():  # size rows
        out[r["at"]] = r["total"]
    return out


def bidiagonalise(step: Callable[[np.ndarray, np.ndarray], tuple[float, np.ndarray, np.ndarray]], dims: int, trace: float) -> tuple[np.ndarray, np.ndarray]:
    """``V, R`` with X V = U R for orthonormal U and V, U never formed.

    ``step(P, q)`` gives, for y = X q and U = X P, the numbers y'y, U'y and X'y. ``trace`` is that of
    X'X; the steps end where V has all of it, or every dimension.
    """
    draw = np.random.default_rng(SEED)
    directions, short, back = np.zeros((dims, 0)), np.zeros((dims, 0)), np.zeros((dims, 0))
    r = np.zeros((dims, dims))
    scale = np.sqrt(trace)
    v = None
    for k in range(dims):
        if v is None:
            v = _orthogonal(draw.normal(size=dims), directions)
        # Xv less its parts along U, which are X'u_j times v
        along = back.T @ v
        q = v - short @ along
        for _ in range(4):
            square, rest, z = step(short, q)
            # what rounding has left of U in it, as measured; where that is much, the remainder is measured anew
            along, q, z = along + rest, q - short @ rest, z - back @ rest
            alpha = np.sqrt(max(square - rest @ rest, 0.0))
            if alpha <= NOTHING * scale or np.linalg.norm(rest) <= 1e-8 * alpha:
                break
        directions = np.column_stack([directions, v])
        r[:k, k] = along
        if alpha > NOTHING * scale:
            r[k, k] = alpha
            short, back = np.column_stack([short, q / alpha]), np.column_stack([back, z / alpha])
            following = z / alpha - alpha * v
        else:
            short, back = np.column_stack([short, np.zeros(dims)]), np.column_stack([back, np.zeros(dims)])
            following = np.zeros(dims)
        if trace - (r**2).sum() <= np.finfo(float).eps * dims * trace:
            return directions, r[: k + 1, : k + 1]
        for _ in range(2):
            following = following - directions @ (directions.T @ following)
        v = _orthogonal(following, directions) if np.linalg.norm(following) > NOTHING * scale else None
    return directions, r


def _orthogonal(v: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """``v`` less its parts along the directions, of length 1; a short remainder is cleaned again at its new length."""
    for _ in range(3):
        v = v - directions @ (directions.T @ v)
        v = v / np.linalg.norm(v)
    return v


def fitted(rows: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening:
    """The fit over the distinct vectors of ``rows(x)``; components of deviation zero are left out."""
    fit = stored(rows.select("x").distinct())
    n, sums = _sums(fit, dims)
    blocks = _centred(fit, dims, n, sums)
    trace = float(summed(blocks, dims, lambda c: np.array([(c**2).sum()]), 1)[0]) / n
    if not trace:
        return Whitening(n, sums, np.zeros((dims, 0)), np.zeros(0), np.zeros(0), 0.0)

    def step(short: np.ndarray, q: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def products(c: np.ndarray) -> np.ndarray:
            y = c @ q
            return np.concatenate([[y @ y], c.T @ y, (c @ short).T @ y])

        found = summed(blocks, dims, products, 1 + dims + short.shape[1]) / n
        return float(found[0]), found[1 + dims :], found[1 : 1 + dims]

    directions, r = bidiagonalise(step, dims, trace)
    _, deviation, turned = np.linalg.svd(r)
    values = deviation**2
    kept = min(components, int((values > np.finfo(float).eps * dims * values[0]).sum()))
    found = directions @ turned.T[:, :kept]
    found /= np.linalg.norm(found, axis=0)
    white = found / deviation[:kept]
    middle = summed(blocks, dims, lambda c: (c @ white).sum(axis=0), kept) / n

    def products(c: np.ndarray) -> np.ndarray:
        w = c @ white - middle
        return (w.T @ w).ravel()

    covariance = summed(blocks, dims, products, kept * kept).reshape(kept, kept) / n
    error = float(np.abs(covariance - np.eye(kept)).max())
    return Whitening(n, sums, found, values[:kept], values[:kept] / trace, error)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> tuple[DataFrame, Whitening | None]:
    """``vec_id, deviation, whitened`` of ``vectors(vec_id, embedding)``, and the fit.

    ``whitened`` has a number per component, by falling eigenvalue; at most ``components``, and none whose
    eigenvalue is zero, so one distinct vector alone gives empty arrays. ``deviation`` is the exact sum over
    dimensions of (n * x - sum)^2, null where no long holds it. Rows that are null, empty or hold null or
    non-finite entries take no part, nor do those of another length than most have (the longest, at a
    tie). Repeated rows each come out, and count once in the fit. Entries beyond 2^53 count as that.
    Without rows the result is empty and there is no fit. Other columns are left out.
    """
    ship(vectors.sparkSession)
    rows = stored(whole_rows(vectors))
    schema = f"vec_id {dict(rows.dtypes)['vec_id']}, deviation long, whitened array<double>"
    lengths = rows.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if lengths is None:
        return rows.sparkSession.createDataFrame([], schema), None
    dims = lengths["dims"]
    rows = rows.where(F.size("x") == dims)
    fit = fitted(rows, dims, components)
    n, sums, white = fit.n, fit.sums, fit.components / np.sqrt(fit.eigenvalues)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            moved = from_mean(_matrix(batch.column(1), dims), n, sums)
            flat = (moved.astype(float) / n) @ white
            ends = pa.array(np.arange(len(flat) + 1) * white.shape[1], pa.int32())
            arrays = pa.ListArray.from_arrays(ends, pa.array(flat.ravel(), pa.float64()))
            yield pa.record_batch([batch.column(0), pa.array(deviations(moved), pa.int64()), arrays], ["vec_id", "deviation", "whitened"])

    return rows.mapInArrow(project, schema), fit


def op11_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, fit = whiten(table(spark, sf_dir, "embeddings"))
    n, explained, error = (fit.n, fit.explained.tolist(), fit.identity_error) if fit else (0, [], 0.0)
    shares = F.array(*map(F.lit, explained)) if explained else F.array().cast("array<double>")
    rows = found.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
