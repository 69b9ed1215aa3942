"""Whitening of embeddings: exact distributed covariance, float32 eigenvectors refined in higher precision.

Vectors become whole numbers, so sums, products and the covariance are exact and do not depend on how
the rows are partitioned. Tasks centre their rows by the whole part of the mean, multiply blocks that
doubles hold exactly, and hand on sums of d * d numbers; the fraction of the mean is taken off the sums.

The solver starts from float32 eigenvectors of the covariance. An iteration of Ogita and Aishima corrects
all of them at once by matrix products: R = I - X'X and S = X'AX give the eigenvalues and a matrix E, and
X + XE has half as many wrong digits. It runs in doubles until it settles, then in extended precision.
Eigenvalues too close for the current precision are only made orthogonal by it; each such cluster gets a
sub-solve: the eigenvectors of its own small block X'(A - mI)X, m in the cluster's middle, whose rounding errors
are those of the cluster's width, not of A.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType

#: An entry whose scaled value lies further from zero counts as this: products of two such and sums of them fit what follows.
FURTHEST = 1 << 40
#: Entries of a block of rows inside a task.
BLOCK = 1 << 20
#: Bits after the point in the sums of the check of the result.
FRACTION = 60


def whole(entries: np.ndarray, scale: int, shift: int) -> np.ndarray:
    """floor(scale * entry) + shift as whole numbers."""
    return np.clip(np.floor(scale * entries), -FURTHEST, FURTHEST).astype(np.int64) + shift


def _vectors(batch: pa.RecordBatch, at: int, scale: int, shift: int) -> np.ndarray:
    """The batch's vectors, none null and all of one length, as whole numbers."""
    lists = batch.column(at)
    flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return whole(flat.reshape(len(lists), -1), scale, shift)


def fit_rows(df: DataFrame, vector: str) -> DataFrame:
    """Rows of `df` whose vector takes part: not null, without null or non-finite entries, of the most common length above 0.

    Of lengths that are equally common the greatest counts; vectors of another length cannot share its components.
    """
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    sound = df.filter(v.isNotNull() & ~bad & (F.size(v) > 0))
    sizes = sound.groupBy(F.size(v).alias("size")).agg(F.count("*").alias("n"))
    top = sizes.orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    return sound.filter(F.size(v) == (top[0]["size"] if top else -1))


def _blocks(x: np.ndarray) -> Iterator[np.ndarray]:
    step = max(1, BLOCK // x.shape[1])
    for a in range(0, len(x), step):
        yield x[a : a + step]


def _exact_gram(z: np.ndarray) -> np.ndarray:
    """z'z of whole numbers without rounding, as Python's numbers where 64 bits are too few."""
    most = int(np.abs(z).max(initial=0))
    if most * most * len(z) < 1 << 53:
        f = z.astype(np.float64)
        return (f.T @ f).astype(np.int64)
    z = z.astype(object)
    return z.T @ z


def _halves(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """high * 2^32 + low, both within 64 bits."""
    return (values >> 32).astype(np.int64), (values & 0xFFFFFFFF).astype(np.int64)


def _summed(partial: DataFrame) -> dict[tuple[int, int], int]:
    """The whole sums of (i, j, high, low) rows by (i, j); d * d of them at most."""
    big = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("high", "low")]
    return {(r["i"], r["j"]): (int(r["high"]) << 32) + int(r["low"]) for r in partial.groupBy("i", "j").agg(*big).collect()}


_PARTIAL = "i INT, j INT, high BIGINT, low BIGINT"


def _partial_rows(totals: np.ndarray) -> pa.RecordBatch:
    """The upper triangle of a symmetric matrix of whole numbers."""
    i, j = np.triu_indices(len(totals))
    high, low = _halves(totals[i, j])
    return pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(high), pa.array(low)], ["i", "j", "high", "low"])


def column_sums(rows: DataFrame, vector: str, scale: int, shift: int) -> tuple[int, list[int]]:
    """(number of rows, sum of each dimension), exact; of no rows (0, [])."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _vectors(batch, 0, scale, shift)
            limit = int(np.abs(x).max(initial=0)) * len(x)
            high, low = _halves(x.sum(axis=0) if limit < 1 << 62 else x.astype(object).sum(axis=0))
            i = np.arange(-1, len(high), dtype=np.int32)
            high, low = np.append(0, high), np.append(len(x), low)
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(np.zeros(len(i), np.int32)), pa.array(high), pa.array(low)], ["i", "j", "high", "low"])

    found = _summed(rows.select(vector).mapInArrow(add, _PARTIAL))
    return found.get((-1, 0), 0), [found[k, 0] for k in range(len(found) - 1)]


def covariance(rows: DataFrame, vector: str, n: int, sums: list[int], scale: int, shift: int) -> np.ndarray:
    """n^2 times the covariance (divisor n) of the rows' whole vectors, exact, as Python's whole numbers.

    Rows are centred by the whole part of the mean before they are multiplied.
    """
    d = len(sums)
    mean = np.array([s // n for s in sums], np.int64)

    def multiply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, room = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            for x in _blocks(_vectors(batch, 0, scale, shift)):
                gram = _exact_gram(x - mean)
                most = int(np.abs(np.diagonal(gram)).max())  # no entry is larger
                if total is not None and room + most >= 1 << 62:
                    yield _partial_rows(total)
                    total, room = None, 0
                total = gram if total is None else total + gram
                room += most
        if total is not None:
            yield _partial_rows(total)

    found = _summed(rows.select(vector).mapInArrow(multiply, _PARTIAL))
    rest = [s - n * int(m) for s, m in zip(sums, mean, strict=True)]
    out = np.empty((d, d), object)
    for (i, j), value in found.items():
        out[i, j] = out[j, i] = n * value - rest[i] * rest[j]
    return out


def _correct(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(x corrected, eigenvalues, width below which two eigenvalues count as one) in the precision of `a` and `x`."""
    ax = a @ x
    r = np.eye(len(a), dtype=a.dtype) - x.T @ x
    s = x.T @ ax
    s = (s + s.T) / 2  # else a rounding error over a small gap would cost orthogonality
    values = np.diagonal(s) / (1 - np.diagonal(r))
    norm = lambda m: float(np.sqrt((m * m).sum()))
    width = 2 * (norm(s - np.diag(np.diagonal(s))) + float(np.abs(values).max()) * norm(r))
    gap = values[None, :] - values[:, None]
    far = np.abs(gap) > width
    with np.errstate(divide="ignore", invalid="ignore"):
        e = np.where(far, (s + values[None, :] * r) / gap, r / 2)
    return x + x @ e, values, width


def _split_clusters(a: np.ndarray, x: np.ndarray, width: float) -> np.ndarray:
    """Sub-solves: in each group of eigenvalues no further apart than `width`, turn the vectors onto the group's own eigenvectors."""
    values = np.diagonal(x.T @ (a @ x))
    order = np.argsort(values)
    x, values = x[:, order].copy(), values[order]
    groups = np.split(np.arange(len(values)), np.flatnonzero(np.diff(values) > width) + 1)
    for g in (g for g in groups if len(g) > 1):
        block = x[:, g]
        for _ in range(2):  # the vectors of the group alone: orthonormal to the precision of x
            block = block + block @ ((np.eye(len(g), dtype=x.dtype) - block.T @ block) / 2)
        small = block.T @ (a @ block - values[g].mean() * block)
        _, turn = np.linalg.eigh(((small + small.T) / 2).astype(np.float64))
        turn = turn.astype(x.dtype)
        turn = turn + turn @ ((np.eye(len(g), dtype=x.dtype) - turn.T @ turn) / 2)
        x[:, g] = block @ turn
    return x


def eigenvectors(a: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling, and unit eigenvectors as columns) of a symmetric matrix given in extended precision."""
    scale = np.abs(a).max() or a.dtype.type(1)
    a = a / scale
    _, start = np.linalg.eigh(a.astype(np.float32))
    x = start.astype(np.float64)
    for kind in (np.float64, np.longdouble):
        m, x, before = a.astype(kind), x.astype(kind), np.inf
        for _ in range(rounds):
            y, values, width = _correct(m, x)
            x = y
            step = width / 2
            if step <= 64 * float(np.finfo(kind).eps) * len(a) or step > before / 2:
                break
            before = step
        x = _split_clusters(m, x, max(width, len(a) * float(np.finfo(kind).eps)) * 4)
        x, values, _ = _correct(m, x)
    for _ in range(2):
        x = x + x @ ((np.eye(len(a), dtype=x.dtype) - x.T @ x) / 2)
    order = np.argsort(-values, kind="stable")
    return (values[order] * scale), x[:, order]


class Model(NamedTuple):
    """What whitening needs of the fit list; everything here is of the size of a few vectors."""

    n: int
    sums: list[int]  #: of each dimension
    values: np.ndarray  #: eigenvalues of the components, falling
    vectors: np.ndarray  #: unit eigenvectors as columns
    trace: float  #: of the covariance
    scale: int
    shift: int


def fit(rows: DataFrame, vector: str, most: int = 32, scale: int = 64, shift: int = 1_000_000) -> Model:
    """The leading components, at most `most`, of `rows`, which `fit_rows` has chosen.

    Components whose eigenvalue is zero up to rounding do not exist: whitening would divide by it.
    """
    n, sums = column_sums(rows, vector, scale, shift)
    if not n:
        return Model(0, [], np.zeros(0), np.zeros((0, 0)), 0.0, scale, shift)
    whole_v = covariance(rows, vector, n, sums, scale, shift)
    exact = np.array([[np.longdouble(int(c)) / np.longdouble(n) / np.longdouble(n) for c in r] for r in whole_v], np.longdouble)
    values, vectors = eigenvectors(exact)
    keep = np.flatnonzero(values > len(sums) * 1e-15 * max(values[0], np.longdouble(0)))[:most]
    trace = float(sum(int(whole_v[k, k]) for k in range(len(sums))) / (n * n))
    return Model(n, sums, values[keep].astype(np.float64), vectors[:, keep].astype(np.float64), trace, scale, shift)


def transform(rows: DataFrame, vector: str, model: Model) -> DataFrame:
    """`rows` without the vector, with `deviation` (long) and `whitened` (array<double>, an entry per component).

    deviation: the sum over the dimensions of (n * x - sum)^2, exact; null where a long cannot hold it.
    """
    n, d = model.n, len(model.sums)
    mean = np.array([s // n for s in model.sums] if n else [], np.int64)
    rest = np.array([s - n * int(m) for s, m in zip(model.sums, mean, strict=True)], object)
    fraction = np.array([r / n for r in rest], np.float64)
    weights = model.vectors / np.sqrt(model.values)
    scale, shift = model.scale, model.shift

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            last = batch.num_columns - 1
            x = _vectors(batch, last, scale, shift) - mean
            most = (int(np.abs(x).max(initial=0)) + 1) * n
            if most * most * d < 1 << 63:
                deviation = ((n * x - rest.astype(np.int64)) ** 2).sum(axis=1)
            else:
                exact = ((n * x.astype(object) - rest) ** 2).sum(axis=1)
                deviation = [v if v < 1 << 63 else None for v in exact.tolist()]
            w = (x - fraction) @ weights
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in range(last)] + [pa.array(deviation, pa.int64()), lists], [*batch.schema.names[:last], "deviation", "whitened"]
            )

    others = [c for c in rows.columns if c != vector]
    shape = rows.select(*others).schema.add("deviation", LongType()).add("whitened", ArrayType(DoubleType()))
    return rows.select(*others, vector).mapInArrow(project, shape)


def identity_error(white: DataFrame, n: int, column: str = "whitened") -> float:
    """Largest absolute entry of the whitened rows' covariance (divisor n) minus the identity, measured on the rows.

    Tasks add products of rows centred by their mean, which is zero up to rounding; sums are kept to
    2^-60, so they do not depend on the order in which tasks end. Without rows or components it is 0.
    """

    def multiply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            w = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            if w.shape[1]:
                w = np.hstack((w, np.ones((len(w), 1))))  # the last column gives the sums
                total = w.T @ w if total is None else total + w.T @ w
        if total is not None:
            yield _partial_rows(np.vectorize(int, otypes=[object])(np.rint(total * 2.0**FRACTION)))

    found = _summed(white.select(column).mapInArrow(multiply, _PARTIAL))
    if not found:
        return 0.0
    size = max(i for i, _ in found) + 1
    moments = np.zeros((size, size))
    for (i, j), value in found.items():
        moments[i, j] = moments[j, i] = value / (n << FRACTION)
    mean = moments[:-1, -1]
    return float(np.abs(moments[:-1, :-1] - np.outer(mean, mean) - np.eye(size - 1)).max())


def whiten(df: DataFrame, vector: str = "embedding", most: int = 32, scale: int = 64, shift: int = 1_000_000) -> tuple[DataFrame, Model, float]:
    """(rows with `deviation` and `whitened` in place of the vector, the model, the measured identity error).

    Rows whose vector is null or has null or non-finite entries are dropped, as are empty vectors and
    those of another than the most common length (see `fit_rows`). All other rows are fitted and returned,
    repeated ones as often as they come, with all other columns (a column named like a new one is refused by Spark). An entry
    beyond 2^40 after scaling counts as 2^40. If all rows are equal, or there is one, there are no components and `whitened` is empty.
    """
    rows = fit_rows(df, vector)
    model = fit(rows, vector, most, scale, shift)
    white = transform(rows, vector, model)
    return white, model, identity_error(white, model.n) if len(model.values) else 0.0
