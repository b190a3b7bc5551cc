import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from formflow.llm import whitening
from formflow.llm.queries import op12_embedding_whitening, table

SCHEMA = "vec_id long, embedding array<double>, label string"


def brute(vectors, components):
    """(eigenvalues, vectors, x less mean, exact deviations) with a dense solver."""
    x = np.floor(1024 * np.asarray(vectors, dtype=float)) + 100_000
    c = x - x.mean(axis=0)
    values, vecs = np.linalg.eigh(c.T @ c / len(x))
    whole = x.astype(np.int64).astype(object)
    return values[::-1][:components], vecs[:, ::-1][:, :components], c, ((len(x) * whole - whole.sum(axis=0)) ** 2).sum(axis=1), values.sum()


def test_inertia_counts():
    rng = np.random.default_rng(0)
    for _ in range(300):
        a = rng.standard_normal((rng.integers(1, 12),) * 2)
        a = a + a.T
        if rng.random() < 0.4:
            np.fill_diagonal(a, 0)
        assert whitening.positive_pivots(a) == (np.linalg.eigvalsh(a) > 0).sum()
    assert whitening.positive_pivots(np.zeros((3, 3))) == 0


@pytest.mark.parametrize("spectrum", [[9, 9, 9, 9, 9, 9, 1, 1], [100, 99.9999, 50, 1, 1, 1e-3, 0, 0], [8, 7, 6, 5, 4, 3, 2, 1], [5] * 8, [1e9, 1, 1, 1, 0, 0, 0, 0]])
def test_feast_finds_all_of_any_spectrum(spark, spectrum):
    q, _ = np.linalg.qr(np.random.default_rng(1).standard_normal((8, 8)))
    matrix = (q * np.array(spectrum, float)) @ q.T
    matrix = (matrix + matrix.T) / 2
    values, vectors = whitening.principal_components(spark, matrix, 5)
    want = [v for v in sorted(spectrum, reverse=True)[:5] if v > 1e-11 * sum(spectrum)]
    assert np.allclose(values, want, rtol=1e-12, atol=1e-13 * max(spectrum))
    assert np.allclose(vectors.T @ vectors, np.eye(len(want)), atol=1e-13)
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-13 * max(spectrum)


def test_missed_eigenvalues_are_an_error(spark):
    with pytest.raises(ArithmeticError):
        whitening.feast(spark, np.diag([3.0, 2.0, 1.0]), [(1.5, 4.0, 1)], sweeps=3)


def test_registered_query_equals_dense_solver(spark):
    d = "/root/testdata/sf0.001"
    rows = table(spark, d, "embeddings").orderBy("vec_id").toPandas()
    values, vectors, centred, deviation, trace = brute(rows.embedding.tolist(), 8)
    got = op12_embedding_whitening(spark, d).toPandas()
    assert len(got) == 8 * len(rows) and (got.n == len(rows)).all() and got.identity_error.nunique() == 1 and got.identity_error.max() < 1e-9
    for k in range(8):
        own = got[got.component == k + 1].sort_values("vec_id")
        want = centred @ vectors[:, k] / np.sqrt(values[k])
        sign = np.sign(want @ own.whitened.to_numpy())
        assert np.abs(sign * want - own.whitened.to_numpy()).max() < 1e-9
        assert np.abs(own.explained.to_numpy() * trace / values[k] - 1).max() < 1e-12
        assert own.deviation.tolist() == list(deviation)


def test_unusable_rows_and_clashing_names(spark):
    rng = np.random.default_rng(2)
    good = [(i if i else None, rng.standard_normal(5).tolist(), "x") for i in range(40)] + [(7, [0.5] * 5, "x")] * 3
    bad = [(90, None, "x"), (91, [None, 1.0, 1.0, 1.0, 1.0], "x"), (92, [float("nan")] * 5, "x"), (93, [1.0, float("-inf"), 0.0, 0.0, 0.0], "x")]
    got = whitening.whiten(cases.with_clashes(spark.createDataFrame(good + bad, SCHEMA).withColumns({"x": F.lit(1), "white": F.lit(2)})), 3).toPandas()
    values, vectors, centred, deviation, _ = brute([v for _, v, _ in good], 3)
    assert len(got) == 3 * len(good) and (got.n == len(good)).all()
    assert sorted(map(int, got[got.component == 1].deviation)) == sorted(deviation)
    want = np.sort(np.abs(centred @ vectors[:, 0] / np.sqrt(values[0])))
    assert np.allclose(np.sort(np.abs(got[got.component == 1].whitened)), want, atol=1e-10)


@pytest.mark.parametrize("rows,expected", [
    ([], 0), ([(1, None, "a")], 0), ([(1, [1.0, 2.0], "a")], 0), ([(1, [1.0, 2.0], "a")] * 4, 0), ([(1, [], "a"), (2, [], "b")], 0),
    ([(1, [1.0, 3.0], "a"), (2, [2.0, 3.0], "a")], 2), ([(1, [1.0, 0.0], "a"), (2, [-1.0, 0.0], "a"), (3, [0.0, 1.0], "a"), (4, [0.0, -1.0], "a")], 8)])
def test_degenerate_tables(spark, rows, expected):
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == expected
    assert all(r.identity_error < 1e-9 for r in got)


def test_large_values_stay_exact(spark):
    vectors = [[1e6 + i, -1e6 * i, 3.0] for i in range(20)]
    got = whitening.whiten(spark.createDataFrame([(i, v, "") for i, v in enumerate(vectors)], SCHEMA), 1).toPandas().sort_values("vec_id")
    assert [int(v) for v in got.deviation] == list(brute(vectors, 1)[3])


def test_mixed_dimensions_are_an_error(spark):
    with pytest.raises(ValueError, match="entries"):
        whitening.whiten(spark.createDataFrame([(1, [1.0], ""), (2, [1.0, 2.0], "")], SCHEMA))
