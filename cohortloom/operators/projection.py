"""Principal components of wide sparse data in long form: no row, covariance or factor is ever dense.

Block iteration on (row, col, value). A block of random columns is multiplied by the scaled matrix and by its
transpose in turn, each time an aggregation of entries times the other side's short arrays. Centring is
implicit: the mean row times the block is taken off the sums, so zeros stay absent. Between the products the
block is made orthonormal by a QR of the tall side, whose triangles are combined in a tree. What leaves a task is
a short array for each row or column, and triangles of the block's width.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.relational import spread_lookup
from cohortloom.session import cut, drop_cut

#: Triangles that one step of the tree combines.
FAN = 16


class Projection(NamedTuple):
    scores: DataFrame  #: (row, score): an array<double> with an entry per component
    components: DataFrame  #: (col, part): the unit components, an array<double> with an entry per component
    deviations: list[float]  #: sample deviation along each component, falling
    rounds: int  #: rounds done


def _stacked(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def triangle(tall: DataFrame, column: str) -> np.ndarray:
    """R of the QR of the rows in array column `column`: each task's triangle, then triangles of triangles; none of no rows."""

    def reduce(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            if batch.num_rows:
                rows = _stacked(batch.column(0))
                r = np.linalg.qr(rows if r is None else np.vstack((r, rows)), mode="r")
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array(list(r), pa.list_(pa.float64()))], ["r"])

    level = tall.select(F.col(column).alias("r")).mapInArrow(reduce, "r ARRAY<DOUBLE>")
    for _ in range(max(1, math.ceil(math.log(max(2, level.rdd.getNumPartitions()), FAN))) - 1):
        level = level.repartition(max(1, level.rdd.getNumPartitions() // FAN)).mapInArrow(reduce, "r ARRAY<DOUBLE>")
    rows = [r["r"] for r in level.collect()]  # FAN triangles at most
    return np.linalg.qr(np.array(rows), mode="r") if rows else np.zeros((0, 0))


def turned(rows: DataFrame, key: str, column: str, matrix: np.ndarray, name: str) -> DataFrame:
    """(key, name): each row's array times `matrix`, which is of the block's size."""

    def turn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = _stacked(batch.column(1)) @ matrix
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(out), pa.list_(pa.float64()))], [key, name])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, column).mapInArrow(turn, f"{key} {kind}, {name} ARRAY<DOUBLE>")


def _sums(column: str, width: int, weight: str) -> F.Column:
    return F.array(*[F.sum(F.col(weight) * F.get(column, F.lit(j))) for j in range(width)])


def scaled_entries(entries: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(scaled, shift, n): entries (row, col, w) by their column's sample deviation, (col, c) the scaled means, and the rows.

    Cells that are absent count as zero. A column without spread has w = 0 and c = 0. `entries` has one row per cell.
    """
    n = entries.select("row").distinct().count()
    given = entries.groupBy("col").agg(F.count("*").alias("m"), F.avg("value").alias("a"), F.var_pop("value").alias("v"))
    m, a = F.col("m"), F.col("a")
    spread = m * F.col("v") + a * a * m * (n - m) / n  # squared distances from the mean, zeros included
    deviation = F.sqrt(spread / max(1, n - 1))
    inverse = F.when(deviation > F.abs(a) * 1e-12, 1 / deviation).otherwise(0.0)
    columns = cut(given.select("col", inverse.alias("inverse"), (m * a / n * inverse).alias("c")))
    scaled = spread_lookup(entries.select("row", "col", "value"), columns.select("col", "inverse"), "col")
    return cut(scaled.select("row", "col", (F.col("value") * F.col("inverse")).alias("w"))), columns.select("col", "c"), n


def project(entries: DataFrame, k: int = 10, block: int = 32, rounds: int = 60, tolerance: float = 1e-4) -> Projection:
    """The rows of `entries` (row, col, value) on the `k` leading principal components of their standardised columns.

    Every column is centred and scaled to unit sample deviation, absent cells being zeros. The block has `block` columns, k at least,
    drawn from hashes of the columns' keys; rounds go on until the k leading deviations change by less than `tolerance` of the first.
    With no more columns than the block the result is exact after a round. Fewer components than k come back if the data have
    fewer; without rows or spread there are none, and scores are empty arrays.
    """
    if not 0 < k <= block:
        raise ValueError("block must be k at least")
    scaled, shift, n = scaled_entries(entries)
    start = F.transform(F.sequence(F.lit(0), F.lit(block - 1)), lambda j: F.xxhash64("col", j) / F.lit(2.0**63))
    right, width = cut(shift.select("col", start.alias("b"))), block
    last, done, y = None, 0, None
    while True:
        done += 1
        means = right.join(shift, "col").agg(_sums("b", width, "c").alias("d")).first()["d"]
        sums = spread_lookup(scaled, right, "col").groupBy("row").agg(_sums("b", width, "w").alias("y"))
        if y is not None:
            drop_cut(y)
        y = cut(sums.select("row", F.zip_with("y", F.array(*[F.lit(x or 0.0) for x in means]), lambda s, d: s - d).alias("y")))
        _, size, across = np.linalg.svd(triangle(y, "y")) if n else (None, np.zeros(0), None)
        live = size > 1e-12 * size.max(initial=0)
        if not live.any():
            none = F.array().cast("array<double>")
            return Projection(y.select("row", none.alias("score")), shift.select("col", none.alias("part")), [], done)
        to_unit = across[: len(size)][live].T / size[live]
        left = turned(y, "row", "y", to_unit, "q")
        total = np.array(y.select(F.lit(1.0).alias("one"), "y").agg(_sums("y", width, "one").alias("t")).first()["t"]) @ to_unit
        width = int(live.sum())
        arrived = spread_lookup(scaled, left, "row").groupBy("col").agg(_sums("q", width, "w").alias("b"))
        drift = F.array(*[F.lit(float(t)) for t in total])
        moved = cut(arrived.join(shift, "col").select("col", F.zip_with("b", drift, lambda s, t: s - F.col("c") * t).alias("b")))
        drop_cut(right)
        _, values, turn = np.linalg.svd(triangle(moved, "b"))
        kept = values > 1e-12 * values[0]
        lead = np.zeros(k)
        lead[: min(k, len(values))] = values[:k]
        if done >= rounds or (last is not None and np.abs(lead - last).max() <= tolerance * lead[0]) or len(values) < block:
            break
        last = lead
        right = cut(turned(moved, "col", "b", turn[kept].T / values[kept], "b"))
        width = int(kept.sum())
    top = min(k, int(kept.sum()))
    scores = turned(y, "row", "y", to_unit @ (turn[:top].T * values[:top]), "score")
    parts = turned(moved, "col", "b", turn[:top].T / values[:top], "part")
    return Projection(scores, parts, (values[:top] / math.sqrt(max(1, n - 1))).tolist(), done)
