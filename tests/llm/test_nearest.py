import numpy as np
import pytest
from pyspark.sql import functions as F

from tablespoon.llm import nearest
from tablespoon.llm.hilbert import hilbert_key

SCHEMA = "vec_id long, embedding array<float>, label int, point string, h string"


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(None if i is None else int(i), v, 0, "x", "y") for i, v in zip(ids, vectors)], SCHEMA)


def brute(vectors, queries, k):
    x = np.array(vectors, np.float32).astype(float)
    out = {}
    for q in queries:
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((np.arange(len(x)), d)) if i != q][:k]
        out[q] = [(i, d[i]) for i in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_curve_visits_neighbouring_cells():
    for axes, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes), axis=-1).reshape(-1, axes)
        key = hilbert_key(grid, bits)
        assert sorted(key) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def test_exact_within_a_block(spark):
    vectors = np.random.default_rng(1).normal(size=(300, 12)).astype(np.float32).tolist()
    got = found(nearest.nearest(table(spark, vectors), F.col("vec_id") % 50 == 0, k=5, curves=2))
    want = brute(vectors, range(0, 300, 50), 5)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]] and np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12)


def test_recall_over_many_blocks(spark):
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(40, 16))
    vectors = (centres[draw.integers(0, 40, 4000)] + 0.4 * draw.normal(size=(4000, 16))).astype(np.float32).tolist()
    got = found(nearest.nearest(table(spark, vectors), F.col("vec_id") % 100 == 0, curves=8, block=128))
    want = brute(vectors, range(0, 4000, 100), 10)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert all(len(got[q]) == 10 for q in want) and hits >= 0.9 * 400


@pytest.mark.parametrize("n", [1500, 15_000])
def test_recall_of_the_windows_alone(spark, n):
    """Clustered vectors at two sizes ten times apart, windows of the same size: a fifth of the smaller table, a fiftieth of the larger."""
    draw = np.random.default_rng(6)
    centres = draw.normal(size=(60, 16))
    vectors = (centres[draw.integers(0, 60, n)] + 0.3 * draw.normal(size=(n, 16))).astype(np.float32).tolist()
    step = n // 50
    got = found(nearest.nearest(table(spark, vectors), F.col("vec_id") % step == 0, block=100, exact=False))
    want = brute(vectors, range(0, n, step), 10)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)


def test_nothing_is_missed_beyond_the_windows(spark, monkeypatch):
    """Vectors in all directions, windows over a hundredth of them: only the second pass can find the rest."""
    monkeypatch.setattr(nearest, "ASKED", 16)
    vectors = np.random.default_rng(4).normal(size=(3000, 32)).astype(np.float32).tolist()
    got = found(nearest.nearest(table(spark, vectors), F.col("vec_id") % 60 == 0, curves=1, block=10))
    want = brute(vectors, range(0, 3000, 60), 10)
    assert {q: [i for i, _ in got[q]] for q in got} == {q: [i for i, _ in want[q]] for q in want}


def test_ties_and_copies(spark):
    """A third of all rows is one vector, split over blocks by nobody: ties go to the smaller id."""
    draw = np.random.default_rng(3)
    vectors = draw.normal(size=(600, 6)).astype(np.float32).tolist()
    for i in range(0, 600, 3):
        vectors[i] = vectors[0]
    got = found(nearest.nearest(table(spark, vectors), F.col("vec_id") % 100 == 0, curves=4, block=64))
    assert [i for i, _ in got[0]] == list(range(3, 33, 3)) and [i for i, _ in got[300]] == list(range(0, 30, 3))
    assert all(s == 0 for _, s in got[300])


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 0.0], [0.0, 1.0], None, [0.0, 0.0], [nan, 1.0], [inf, 1.0], [None, 1.0], [1.0, 0.0], [], [1.0, 2.0, 3.0], [2.0, 0.0], [1.0, 0.0]]
    ids = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, None, 0]
    got = found(nearest.nearest(table(spark, vectors, ids), F.col("vec_id") % 2 == 0, k=10, curves=2))
    assert got == {0: [(7, 0.0), (1, np.sqrt(2.0))]}
    assert nearest.nearest(table(spark, []), F.col("vec_id") % 2 == 0).count() == 0
    assert nearest.nearest(table(spark, [None, [0.0]]), F.col("vec_id") % 2 == 0).count() == 0
