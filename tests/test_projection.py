"""Wide projection against numpy on dense copies."""

import numpy as np
import pytest

from cohortloom.operators import projection

ENTRIES = "row BIGINT, col BIGINT, value DOUBLE"


def sparse(rows, cols, share, seed, rank=None):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=(rows, cols)) + 3
    if rank:
        a = rng.normal(size=(rows, rank)) @ (rng.normal(size=(rank, cols)) * np.linspace(8, 1, rank)[:, None]) + rng.normal(size=(rows, cols)) * 0.2
    a[rng.random((rows, cols)) > share] = 0
    return a


def frame(spark, a):
    return spark.createDataFrame([(int(i), int(j), float(a[i, j])) for i, j in zip(*np.nonzero(a))], ENTRIES)


def dense(a):
    spread = a.std(axis=0, ddof=1)
    return np.divide(a - a.mean(axis=0), spread, out=np.zeros_like(a), where=spread > 1e-12)


def check(spark, a, k, error, **options):
    found = projection.project(frame(spark, a).repartition(5), k, tolerance=1e-8, **options)
    z = dense(a)
    u, s, vt = np.linalg.svd(z, full_matrices=False)
    want = s[:k] / np.sqrt(len(a) - 1)
    assert np.abs(np.array(found.deviations) - want).max() < error * want[0]
    scores = {r.row: r.score for r in found.scores.collect()}
    got = np.array([scores[i] for i in range(len(a))])
    assert got.shape == (len(a), k)
    assert np.abs(got.T @ got - np.diag(np.diagonal(got.T @ got))).max() < 1e-7 * s[0] ** 2
    parts = {r.col: r.part for r in found.components.collect()}
    p = np.array([parts.get(j, [0.0] * k) for j in range(a.shape[1])])
    assert np.abs(p.T @ p - np.eye(k)).max() < 1e-9
    assert np.abs(z @ p - got).max() < 1e-4 * s[0]
    return found


def test_all_components_of_narrow_data(spark):
    found = check(spark, sparse(80, 12, 0.6, 1), 12, 1e-12, block=12)
    assert found.rounds <= 2


def test_leading_components_of_data_wider_than_the_block(spark):
    check(spark, sparse(60, 300, 0.5, 2, rank=6), 4, 1e-5, block=12)


def test_constant_columns_and_equal_rows(spark):
    a = sparse(40, 8, 0.7, 3)
    a[:, 2], a[:, 5], a[5] = 4.0, 0.0, a[6]
    check(spark, a, 6, 1e-12, block=16)


def test_width_of_thirteen_thousand(spark):
    """12,927 columns, most cells absent: nothing of the width times the width, or of rows times the width, is made."""
    rng = np.random.default_rng(5)
    group = rng.integers(0, 3, 120)
    rows = [(i, int(c), 1.0 + float(rng.random())) for i in range(120) for c in set(rng.integers(0, 12_927, 60)) | set(range(100 * group[i], 100 * group[i] + 80))]
    rows.append((0, 12_926, 1.0))
    found = projection.project(spark.createDataFrame({(r[0], r[1]): r for r in rows}.values(), ENTRIES), 2, block=8)
    scores = np.array([r.score for r in sorted(found.scores.collect(), key=lambda r: r.row)])
    centers = np.array([scores[group == g].mean(axis=0) for g in range(3)])
    nearest = np.argmin(((scores[:, None] - centers[None]) ** 2).sum(axis=2), axis=1)
    assert (nearest == group).all()


@pytest.mark.parametrize("rows", [[], [(1, 1, 2.0)], [(1, 1, 2.0), (2, 1, 2.0)]])
def test_nothing_to_project(spark, rows):
    found = projection.project(spark.createDataFrame(rows, ENTRIES), 2, block=4)
    assert found.deviations == [] and all(r.score == [] for r in found.scores.collect())
    assert found.scores.count() == len(rows)
