import numpy as np
import pytest

from tablespoon.llm import whitening as w

SCHEMA = "vec_id long, embedding array<float>, x string, n long, whitened int"
SF_DIR = "/root/testdata/sf0.001"


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(None if i is None else int(i), v, "a", 1, 0) for i, v in zip(ids, vectors)], SCHEMA)


def brute(vectors):
    """Exact rows and sums, eigenvalues and vectors by falling eigenvalue."""
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(int) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (fit * n - sums) / n
    values, components = np.linalg.eigh(centred.T @ centred / n)
    return x, n, sums, values[::-1], components[:, ::-1]


def same_up_to_sign(a, b, error):
    return all(min(np.abs(a[:, i] - b[:, i]).max(), np.abs(a[:, i] + b[:, i]).max()) < error for i in range(a.shape[1]))


@pytest.mark.parametrize("kind", ["falling", "even", "flat"])
def test_as_eigenvectors(spark, kind):
    draw = np.random.default_rng(1)
    deviations = {"falling": 30.0 / 1.3 ** np.arange(20), "even": np.full(20, 3.0), "flat": np.r_[np.full(5, 4.0), np.zeros(15)]}[kind]
    turned = np.linalg.qr(draw.normal(size=(20, 20)))[0] if kind == "falling" else np.eye(20)
    vectors = ((draw.normal(size=(400, 20)) * deviations) @ turned + 5).astype(np.float32)
    vectors[100:250] = vectors[0]  # more than a third of all rows
    found, fit = w.whiten(table(spark, vectors.tolist()), 16)
    x, n, sums, values, components = brute(vectors)
    k = 5 if kind == "flat" else 16
    assert fit.n == n == 250 and fit.sums == sums.tolist() and fit.components.shape == (20, k)
    assert np.allclose(fit.eigenvalues, values[:k], rtol=1e-10) and np.allclose(fit.explained, values[:k] / values.sum(), rtol=1e-10)
    assert np.allclose(np.linalg.norm(fit.components, axis=0), 1, rtol=1e-14)
    assert same_up_to_sign(fit.components, components[:, :k], 1e-9)
    assert fit.identity_error < 1e-9
    got = {r.vec_id: r for r in found.collect()}
    assert len(got) == 400
    want = ((x * n - sums) / n) @ (fit.components / np.sqrt(fit.eigenvalues))
    for i in range(0, 400, 7):
        assert got[i].deviation == int(((x[i] * n - sums) ** 2).sum())
        assert np.allclose(got[i].whitened, want[i], rtol=1e-12, atol=1e-12)


def test_repeated_eigenvalues_are_all_found():
    """A Krylov space holds one vector per distinct eigenvalue; the others come with new directions."""
    values = np.array([9.0, 9.0, 9.0, 4.0, 4.0, 1.0, 0.0, 0.0])
    turned = np.linalg.qr(np.random.default_rng(2).normal(size=(8, 8)))[0]
    x = np.sqrt(values)[:, None] * turned

    def step(short, q):
        y = x @ q
        return y @ y, (x @ short).T @ y, x.T @ y

    directions, r = w.bidiagonalise(step, 8, values.sum())
    assert np.allclose(directions.T @ directions, np.eye(directions.shape[1]), atol=1e-13)
    assert np.allclose(np.sort(np.linalg.svd(r)[1] ** 2)[::-1][:6], values[:6], atol=1e-12)
    rest = r - np.diag(np.diag(r)) - np.diag(np.diag(r, 1), 1)
    assert np.abs(rest).max() < 1e-12  # bidiagonal


def test_exact_beyond_longs():
    x = np.array([[1 << 55, -(1 << 50)], [3, 4]], np.int64)
    moved = w.from_mean(x, 1 << 20, [5, 1 << 70])
    assert moved.tolist() == [[(1 << 75) - 5, -(1 << 70) - (1 << 70)], [3 * (1 << 20) - 5, 4 * (1 << 20) - (1 << 70)]]
    assert w.deviations(moved) == [None, None]
    assert w.deviations(np.array([[1 << 31, 1 << 31], [3, -4]])) == [None, 25]
    assert w.deviations(np.array([[1 << 30, 1 << 31], [3, -4]])) == [(1 << 60) + (1 << 62), 25]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 2.0], [1.0, 2.0], [3.0, 1.0], None, [nan, 1.0], [inf, 1.0], [None, 1.0], [], [1.0], [0.0, 5.0], [0.0, 5.0]]
    ids = [0, 0, 1, 2, 3, 4, 5, 6, 7, None, None]
    found, fit = w.whiten(table(spark, vectors, ids))
    rows = found.collect()
    assert fit.n == 3 and sorted(str(r.vec_id) for r in rows) == ["0", "0", "1", "None", "None"]
    assert all(len(r.whitened) == 2 for r in rows) and fit.identity_error < 1e-9
    one, fit = w.whiten(table(spark, [[1.0, 2.0]] * 3))
    assert [(r.deviation, r.whitened) for r in one.collect()] == [(0, [])] * 3 and fit.n == 1
    large, fit = w.whiten(table(spark, [[3e38, 1.0], [-3e38, 0.0], [0.0, 0.0]]))
    assert [r.deviation for r in large.orderBy("vec_id").collect()][:2] == [None, None] and fit.explained[0] > 0.99
    for none in ([], [None, [nan]]):
        found, fit = w.whiten(table(spark, none))
        assert found.count() == 0 and fit is None


def test_query_as_brute_force(spark):
    df = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").toPandas()
    x, n, sums, values, components = brute(df["embedding"].tolist())
    got = w.op11_whiten(spark, SF_DIR).toPandas()
    assert list(got.columns) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert len(got) == len(df) * 16 and set(got["n"]) == {n} and got["identity_error"].nunique() == 1
    assert got["identity_error"].max() < 1e-10
    by = got.sort_values(["vec_id", "component"])
    assert np.allclose(by["explained"].to_numpy().reshape(-1, 16), values[:16] / values.sum(), rtol=1e-10)
    white = by["whitened"].to_numpy().reshape(-1, 16)
    order = np.argsort(df["vec_id"].to_numpy())
    want = ((x * n - sums) / n)[order] @ (components[:, :16] / np.sqrt(values[:16]))
    assert same_up_to_sign(white, want, 1e-6)
    exact = ((x * n - sums) ** 2).sum(axis=1)[order]
    assert (by["deviation"].to_numpy().reshape(-1, 16) == exact[:, None]).all()
