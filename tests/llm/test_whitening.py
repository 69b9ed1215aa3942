"""Whitening: the solver on known matrices, exact sums, and the query against numpy."""

import math

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from cohortloom.llm import whitening
from cohortloom.llm.plans import QUERIES

L = np.longdouble


def known(values, seed=0):
    """A matrix with these eigenvalues, and its eigenvectors, in extended precision."""
    n = len(values)
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(n, n)))
    q = q.astype(L)
    for _ in range(3):
        q = q + q @ ((np.eye(n) - q.T @ q) / 2)
    a = (q * np.array(values, L)) @ q.T
    return (a + a.T) / 2, q


@pytest.mark.parametrize(
    "values, error",
    [
        ([5, 4, 3, 2, 1], 1e-17),
        ([1 + 1e-9, 1, 1 - 1e-9, 0.5, 0.1], 1e-9),
        ([1 + 1e-6, 1, 0.5, 0.5 - 1e-7, 1e-3], 1e-11),
        ([3, 1e-6, 1e-9, 1e-12, 0], 1e-6),
        ([2e7, 1.5e7, 1.5e7 - 1e-3, 4, 2], 1e-8),
        (list(np.linspace(3, 1, 40)), 1e-16),
    ],
)
def test_eigenvectors_of_known_matrices(values, error):
    a, q = known(values)
    found, x = whitening.eigenvectors(a)
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 1e-18 * len(a)
    assert np.abs(found - np.array(values, L)).max() < 1e-18 * len(a) * max(values)
    assert np.minimum(np.abs(x - q).max(axis=0), np.abs(x + q).max(axis=0)).max() < error


@pytest.mark.parametrize("values", [[1, 1, 1, 0.3, 0.2], [2] * 6, [0, 0, 0], [1, 0, 0, 0]])
def test_equal_eigenvalues_give_an_orthonormal_basis(values):
    a, _ = known(values)
    found, x = whitening.eigenvectors(a)
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 1e-17
    assert np.abs(a @ x - x * found).max() < 1e-17


def table(folder, rows):
    ids, vectors = zip(*rows) if rows else ([], [])
    columns = {"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(vectors, pa.list_(pa.float32())), "label": pa.array([0] * len(ids), pa.int32()), "Whitened": pa.array(["x"] * len(ids))}
    pq.write_table(pa.table(columns), folder / "embeddings.parquet")
    return str(folder)


def test_query_against_numpy(spark, tmp_path):
    rng = np.random.default_rng(5)
    sound = [(k, (rng.normal(size=40) * np.linspace(3, 1, 40)).astype(np.float32).tolist()) for k in range(400)]
    sound += sound[:20] + [(None, sound[0][1])]
    odd = [(900, None), (901, [None] + [0.0] * 39), (902, [math.nan] + [0.0] * 39), (903, [math.inf] * 40), (904, []), (905, [1.0] * 39)]
    rows = [tuple(r) for r in QUERIES["op13_whitening"](spark, table(tmp_path, sound + odd)).collect()]
    x = np.floor(64 * np.array([v for _, v in sound])).astype(int) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    z = x - sums / n
    values, u = np.linalg.eigh(z.T @ z / n)
    values, u = values[::-1], u[:, ::-1]
    want = (z @ u / np.sqrt(values))[:, :32]
    deviation = {k: sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, sums)) for (k, _), r in zip(sound, x)}
    assert len(rows) == 32 * n
    assert all(r[2] == n and r[3] == deviation[r[0]] for r in rows)
    assert max(abs(r[5] - values[r[1] - 1] / values.sum()) for r in rows) < 1e-12
    assert len({r[6] for r in rows}) == 1 and rows[0][6] < 1e-10
    place = {k: i for i, (k, _) in enumerate(sound)}
    got = np.zeros((n, 32))
    for r in rows:
        got[place[r[0]], r[1] - 1] = r[4]
    at = sorted(place.values())
    sign = np.sign((got[at] * want[at]).sum(axis=0))
    assert np.abs(got[at] * sign - want[at]).max() < 1e-9


@pytest.mark.parametrize("rows", [[], [(1, [0.5, 0.25])], [(1, None)], [(k, [1.0, -1.0]) for k in range(5)]])
def test_nothing_to_whiten(spark, tmp_path, rows):
    got = QUERIES["op13_whitening"](spark, table(tmp_path, rows))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.collect() == []


def test_fewer_components_than_dimensions(spark, tmp_path):
    rng = np.random.default_rng(6)
    base = rng.integers(-50, 50, size=(200, 2)) / 64
    rows = [(k, [float(a), float(b), float(a + b), 0.0]) for k, (a, b) in enumerate(base)]
    got = QUERIES["op13_whitening"](spark, table(tmp_path, rows)).collect()
    assert {r.component for r in got} == {1, 2} and got[0].identity_error < 1e-10


def test_sums_are_exact_and_do_not_follow_partitions(spark):
    rows = [(k, [3.0e9 * (-1) ** k, float(k), 1e30 if k == 7 else 0.0]) for k in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>")
    results = []
    for parts in (1, 7):
        found = whitening.fit_rows(df.repartition(parts), "v")
        n, sums = whitening.column_sums(found, "v", 64, 1_000_000)
        cov = whitening.covariance(found, "v", n, sums, 64, 1_000_000)
        results.append((n, sums, cov.tolist()))
    assert results[0] == results[1]
    x = [[max(-(1 << 40), min(1 << 40, math.floor(64 * c))) + 1_000_000 for c in v] for _, v in rows]
    assert results[0][1] == [sum(c) for c in zip(*x)]
    n, sums = 60, results[0][1]
    assert results[0][2] == [[n * sum(r[i] * r[j] for r in x) - sums[i] * sums[j] for j in range(3)] for i in range(3)]


def test_general_interface_keeps_other_columns(spark, tmp_path):
    folder = table(tmp_path, [(k, [float(k % 7), float(k % 5), float(k % 3)]) for k in range(100)])
    df = spark.read.parquet(f"{folder}/embeddings.parquet").drop("Whitened")
    white, model, error = whitening.whiten(df, most=2)
    assert white.columns == ["vec_id", "label", "deviation", "whitened"]
    assert white.count() == 100 and model.n == 100 and len(model.values) == 2 and error < 1e-10
