import hashlib

import numpy as np
import pytest

from tablespoon.llm import orchard
from tests.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, x string, cluster int, label int"


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(None if i is None else int(i), v, "a", 7, 0) for i, v in zip(ids, vectors)], SCHEMA)


def nearest(x, c):
    d = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
    return d.argmin(axis=1), d.min(axis=1)


def brute(ids, vectors, k, rounds, scale=256):
    x = np.floor(scale * np.array(vectors, np.float32).astype(float)).astype(np.int64)
    order = sorted(range(len(ids)), key=lambda i: (hashlib.sha256(f"2:{ids[i]}".encode()).hexdigest(), x[i].tolist()))
    c = x[order[:k]].copy()
    for _ in range(rounds):
        own = nearest(x, c)[0]
        for j in set(own.tolist()):
            c[j] = x[own == j].sum(axis=0) // (own == j).sum()
    return *nearest(x, c), c


@pytest.mark.parametrize("kind", ["spread", "grouped", "grid", "line"])
def test_search_as_brute_force(kind):
    draw = np.random.default_rng(5)
    if kind == "spread":
        x, c = draw.integers(-300, 300, (800, 16)), draw.integers(-300, 300, (30, 16))
    elif kind == "grouped":
        middle = draw.integers(-3000, 3000, (30, 16))
        x, c = middle[draw.integers(0, 30, 800)] + draw.integers(-20, 20, (800, 16)), middle + draw.integers(-5, 5, (30, 16))
    elif kind == "grid":  # ties everywhere, centroids that are equal
        x, c = draw.integers(-1, 2, (800, 3)), draw.integers(-1, 2, (30, 3))
    else:
        x, c = draw.integers(-50, 50, (800, 1)), np.arange(-60, 60, 4)[:, None]
    own, distance, taken = orchard.search(x, c, orchard.lists_of(c))
    want = nearest(x, c)
    assert (own == want[0]).all() and (distance == want[1]).all()
    assert taken <= 800 * 30
    if kind in ("grouped", "line"):
        assert taken < 0.7 * 800 * 30  # the lists end the search early


def test_one_centroid():
    own, distance, _ = orchard.search(np.array([[3], [5]]), np.array([[4]]), orchard.lists_of(np.array([[4]])))
    assert own.tolist() == [0, 0] and distance.tolist() == [1, 1]


def test_clusters_as_brute_force(spark):
    draw = np.random.default_rng(6)
    middle = draw.normal(size=(9, 12))
    vectors = (middle[draw.integers(0, 9, 600)] + 0.2 * draw.normal(size=(600, 12))).astype(np.float32)
    vectors[200:400] = vectors[0]  # a third of all rows
    ids = list(range(600))
    found, centroids = orchard.clusters(table(spark, vectors.tolist()), 9, 4, 12)
    own, distance, c = brute(ids, vectors, 9, 4)
    assert (centroids == c).all()
    got = {r.vec_id: (r.cluster, r.distance) for r in found.collect()}
    assert got == {i: (own[i], distance[i]) for i in ids}


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 0.5], [1.0, 0.5], [1.0, 0.5], None, [nan, 0.0], [inf, 0.0], [None, 1.0], [], [1.0], [-1.0, 0.0], [-1.0, 0.001], [3e38, -3e38]]
    ids = [0, 0, 1, 2, 3, 4, 5, 6, 7, None, 9, 10]
    found, centroids = orchard.clusters(table(spark, vectors, ids), 2, 3, 2)
    rows = found.collect()
    assert sorted(r.vec_id for r in rows if r.vec_id is not None) == [0, 0, 1, 9, 10] and len(rows) == 6
    assert all(r.distance >= 0 for r in rows) and len(centroids) == 2
    few, centroids = orchard.clusters(table(spark, vectors[:3], ids[:3]), 40, 5, 2)
    # equal centroids: the first takes all, the others stay
    assert [r.cluster for r in few.collect()] == [0, 0, 0] and centroids.tolist() == [[256, 128]] * 3
    for none in ([], [None, [nan, 1.0]]):
        found, centroids = orchard.clusters(table(spark, none), 3, 2, 2)
        assert found.count() == 0 and found.columns == ["vec_id", "cluster", "distance"]


def test_query_as_sql(spark):
    assert difference(orchard.op13_orchard_clusters(spark, SF_DIR), connect(SF_DIR), orchard.OP13_SQL) is None
