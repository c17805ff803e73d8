"""Embedding whitening: inertia counts and eigenvectors against numpy, rows against brute force."""

import math

import duckdb
import numpy as np
import pytest

from tallyreel.llm import queries, whitening

SF_DIR = "/root/testdata/sf0.001"


def brute(vectors):
    """By the definition: n, exact deviations, eigenvalues and unit vectors of the rows that take part."""
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in vectors]
    n, dim = len(x), len(x[0])
    sums = [sum(row[i] for row in x) for i in range(dim)]
    deviations = [sum((n * row[i] - sums[i]) ** 2 for i in range(dim)) for row in x]
    y = np.array([[(n * row[i] - sums[i]) / n for i in range(dim)] for row in x])
    values, columns = np.linalg.eigh(y.T @ y / n)
    return n, deviations, y, values[::-1], columns.T[::-1]


def check(rows, vectors, components=8):
    n, deviations, y, values, units = brute(vectors)
    k = min(components, len(values))
    assert len(rows) == n * k
    by_row = [rows[i * k : (i + 1) * k] for i in range(n)]
    for i, mine in enumerate(by_row):
        assert [r["component"] for r in mine] == list(range(1, k + 1))
        assert {(r["n"], r["deviation"]) for r in mine} == {(n, deviations[i])}
    for j in range(k):
        assert by_row[0][j]["explained"] == pytest.approx(values[j] / values.sum(), rel=1e-9, abs=1e-12)
        if values[j] > 1e-9 * values[0]:
            got = np.array([mine[j]["whitened"] for mine in by_row])
            want = y @ units[j] / np.sqrt(values[j])
            assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-6
    assert all(r["identity_error"] < 1e-9 for r in rows)


@pytest.mark.parametrize("dim", [1, 2, 7, 40])
def test_inertia_counts(dim):
    a = np.random.default_rng(dim).standard_normal((dim, dim))
    v = a + a.T
    values = np.linalg.eigvalsh(v)
    for shift in [*((values[:-1] + values[1:]) / 2), values[0] - 1, values[-1] + 1]:
        assert whitening.count_above(v, shift) == (values > shift).sum()
    assert whitening.count_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


@pytest.mark.parametrize(
    "v", [np.eye(6), np.zeros((4, 4)), np.diag([5.0, 5, 5, 1, 0, 0, 0, 0, 0]), np.ones((7, 7)), np.diag([1, 1 + 1e-13, 1 + 1e-9, 0.5])]
)
def test_equal_eigenvalues(v):
    values, units = whitening.leading(v, 8)
    assert np.allclose(values, np.linalg.eigvalsh(v)[::-1][:8], atol=1e-13)
    assert np.allclose(units @ units.T, np.eye(len(units)), atol=1e-13) and np.allclose(units @ v, values[:, None] * units, atol=1e-12)


def test_op13_against_numpy(spark):
    vectors = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF_DIR}/embeddings.parquet' ORDER BY vec_id").fetchall()
    rows = queries.op13_embedding_whitening(spark, SF_DIR).orderBy("vec_id", "component").collect()
    assert [r["vec_id"] for r in rows[::8]] == [v[0] for v in vectors]
    check(rows, [v[1] for v in vectors])


def frame(spark, rows):
    return spark.createDataFrame([(i, v, n) for n, (i, v) in enumerate(rows)], "vec_id long, vector array<double>, component int")


def test_rows_that_take_no_part_and_repeats(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, 1.0, -2.0]), (1, [0.5, 1.0, -2.0]), (None, [3.0, 0.25, 0.0]), (4, [-1.0, 2.0, 7.5]), (5, [0.0, 0.0, 0.0])]
    bad = [(6, None), (7, []), (8, [1.0, None, 2.0]), (9, [nan, 1.0, 1.0]), (10, [inf, 1.0, 1.0]), (11, [1.0, 2.0])]
    rows = whitening.whiten(frame(spark, good + bad).repartition(3)).collect()
    order = {(i, tuple(v)): v for i, v in good}
    assert sorted({(r["vec_id"] is None, r["vec_id"] or 0) for r in rows}) == sorted({(i is None, i or 0) for i, _ in order})
    assert len(rows) == 15
    # The third component of four different points in space exists, and ids of equal rows keep a row each.
    assert sum(r["vec_id"] == 1 for r in rows) == 6
    ordered = sorted(rows, key=lambda r: ([1, 1, None, 4, 5].index(r["vec_id"])))
    regrouped = [r for i in range(0, 15, 3) for r in ordered[i : i + 3]]
    first = sorted(ordered[:6], key=lambda r: r["component"])
    regrouped[:6] = [*first[::2], *first[1::2]]
    check(regrouped, [v for _, v in good])


def test_no_variance_and_no_rows(spark):
    rows = whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert len(rows) == 4 and all(r["whitened"] is None and r["explained"] == 0 and r["deviation"] == 0 for r in rows)
    empty = whitening.whiten(frame(spark, []))
    assert empty.count() == 0 and empty.columns[:3] == ["vec_id", "component", "n"]
    assert whitening.whiten(frame(spark, [(1, None)])).count() == 0


def test_values_too_large_for_a_long(spark):
    rows = whitening.whiten(frame(spark, [(1, [1e300, 0.0]), (2, [0.0, 1.0]), (3, [1e9, 0.0])])).collect()
    by_id = {r["vec_id"]: r for r in rows}
    assert len(rows) == 6 and by_id[1]["deviation"] is None
    assert all(r["component"] != 1 or r["whitened"] is not None for r in rows)
