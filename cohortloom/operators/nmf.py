"""Non-negative matrix factorisation V ~ W H by multiplicative updates on sparse entries."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.columns import argmax_index
from cohortloom.operators.matrix import GUARD, factor_columns, project
from cohortloom.operators.propagate import packed_rows, unpacked
from cohortloom.session import cut, drop_cut, even_keys, keep_placed, planned, tasks_for


@dataclass
class Factors:
    """w: (row, w0..), h: (col, w0..) holding the transpose of H, errors: one value per round."""

    w: DataFrame
    h: DataFrame
    errors: list[float] = field(default_factory=list)


def update_factor(
    entries: DataFrame, factor: DataFrame, other: DataFrame, key: str, other_key: str, other_gram: list, guard: float
) -> DataFrame:
    """factor * (V other) / (factor (other' other) + guard), for the factor on `key`.

    `other_gram` is other' other. The row's share of V other stays beside the new values as n0...
    """
    k = len(other_gram)
    names = factor_columns(k)
    top = project(entries, other.select(other_key, *names), other_key, key, k)
    tops = [F.coalesce(F.col(f"n{i}"), F.lit(0.0)) for i in range(k)]
    cols = []
    for i, c in enumerate(names):
        below = sum((F.col(names[j]) * other_gram[j][i] for j in range(k)), F.lit(0.0))
        cols.append((F.col(c) * (tops[i] / (below + guard))).alias(c))
    kept = [t.alias(f"n{i}") for i, t in enumerate(tops)]
    return factor.select(key, *names).join(top, key, "left").select(key, *cols, *kept)


def _half_distance(squares: float, cross: float, ww: list, hh: list) -> float:
    """|V|^2 - 2 <V, W H> + <W'W, H H'>, halved: W H itself is never built."""
    k = len(ww)
    return 0.5 * (squares - 2 * cross + sum(ww[i][j] * hh[i][j] for i in range(k) for j in range(k)))


_PACKED = "block INT, of INT, ids BINARY, places BINARY, cells BINARY"
_SENT = "block INT, of INT, kind INT, x BINARY"
#: Kinds of rows that pass between the blocks: values for a block's rows or columns, a Gram matrix's part, W and H of a block on their way back to it, sums of a round.
_VALUES, _GRAM, _W, _H, _LOG = range(5)


def _pack(table: pa.Table) -> pa.Table:
    """A block's entries (block, row, col, to, value): a row with its row numbers (of = -1), and one with the entries of each block of columns."""
    block, order = table.column("block")[0].as_py(), np.argsort(table.column("row").to_numpy(), kind="stable")
    row, col, to, value = [table.column(c).to_numpy()[order] for c in ("row", "col", "to", "value")]
    ids, at = np.unique(row, return_inverse=True)
    out = [(block, -1, ids, None, None)]
    for b in np.unique(to):
        here = to == b
        cols, of = np.unique(col[here], return_inverse=True)
        out.append((block, int(b), cols, np.stack((at.reshape(-1)[here], of.reshape(-1))).astype(np.int32), value[here]))
    return packed_rows(_PACKED, out)


def _start(ids: np.ndarray, k: int) -> np.ndarray:
    """`matrix.start_factor` of these keys."""
    return np.stack([(np.fmod(ids * 7 + i * 13, 17) + 1) / 17.0 for i in range(k)], axis=1)


def _scaled(factor: np.ndarray, top: np.ndarray, gram: np.ndarray, guard: float) -> np.ndarray:
    return factor * (top / (factor @ gram + guard))


def _read(arrived: pa.Table, kind: int) -> dict[int, np.ndarray]:
    some = arrived.filter(pc.equal(arrived.column("kind"), kind)).sort_by("of")
    return {of: unpacked(x, np.float64) for of, x in zip(some.column("of").to_pylist(), some.column("x"), strict=True)}


def _passed(arrived: pa.Table, *kinds: int) -> list[tuple]:
    """Rows that go on to the next step as they are."""
    return [(r["block"], r["of"], r["kind"], r["x"]) for r in arrived.filter(pc.is_in(arrived.column("kind"), pa.array(kinds, pa.int32()))).to_pylist()]


def _rows_step(k: int, keys: list[int], first: bool):
    """W of a block from H, and what it gives to the columns."""

    def run(placed: pa.Table, arrived: pa.Table) -> pa.Table:
        out = _passed(arrived, _H, _LOG)
        if placed.num_rows:
            parts = {r["of"]: r for r in placed.sort_by("of").to_pylist()}
            own = parts.pop(-1)
            ids = np.frombuffer(own["ids"], np.int64)
            cells = {b: (np.frombuffer(r["places"], np.int32).reshape(2, -1), np.frombuffer(r["cells"], np.float64), len(r["ids"]) // 8) for b, r in parts.items()}
            if first:
                w = _start(ids, k)
            else:
                given, top = _read(arrived, _VALUES), np.zeros((len(ids), k))
                for b, ((row, col), value, _) in cells.items():
                    h = given[b].reshape(-1, k)
                    for i in range(k):
                        top[:, i] += np.bincount(row, weights=value * h[col, i], minlength=len(ids))
                gram = sum(_read(arrived, _GRAM).values()).reshape(k, k)
                w = _scaled(_read(arrived, _W)[own["block"]].reshape(-1, k), top, gram, GUARD)
            for b, ((row, col), value, n) in cells.items():
                out.append((b, own["block"], _VALUES, np.stack([np.bincount(col, weights=value * w[row, i], minlength=n) for i in range(k)], axis=1)))
            out += [(b, own["block"], _GRAM, w.T @ w) for b in keys]
            out.append((own["block"], own["block"], _W, w))
        return packed_rows(_SENT, out)

    return run


def _columns_step(k: int, keys: list[int], step: int):
    """H of a block from W, and what it gives to the rows; `step` 0 is the start."""

    def run(placed: pa.Table, arrived: pa.Table) -> pa.Table:
        out = _passed(arrived, _W, _LOG)
        if placed.num_rows:
            block, (of, cols) = placed.column("of")[0].as_py(), [placed.sort_by("block").column(c) for c in ("block", "ids")]
            cols = {b: unpacked(x, np.int64) for b, x in zip(of.to_pylist(), cols, strict=True)}
            ids = np.unique(np.concatenate(list(cols.values())))
            places = {b: np.searchsorted(ids, x) for b, x in cols.items()}
            top, gram = np.zeros((len(ids), k)), sum(_read(arrived, _GRAM).values()).reshape(k, k)
            for b, x in _read(arrived, _VALUES).items():
                top[places[b]] += x.reshape(-1, k)
            h = _scaled(_read(arrived, _H)[block].reshape(-1, k), top, gram, 1e-10) if step else _start(ids, k)
            out += [(b, block, _VALUES, h[at]) for b, at in places.items()]
            out += [(b, block, _GRAM, h.T @ h) for b in keys]
            out += [(block, block, _H, h), (block, step, _LOG, np.concatenate([[(h * top).sum()], (h.T @ h).ravel(), gram.ravel()]))]
        return packed_rows(_SENT, out)

    return run


def _factor(k: int, kind: int, key: str):
    """(key, w0..) of a block."""

    def run(placed: pa.Table, arrived: pa.Table) -> pa.Table:
        ids, values = np.zeros(0, np.int64), np.zeros((0, k))
        if placed.num_rows:
            ids = np.unique(np.concatenate([unpacked(x, np.int64) for x in placed.column("ids")]))
            (values,) = _read(arrived, kind).values()
        columns = [pa.array(np.ascontiguousarray(c)) for c in values.reshape(-1, k).T]
        return pa.table([pa.array(ids), *columns], names=[key, *factor_columns(k)])

    return run


def factorize(entries: DataFrame, k: int, max_rounds: int = 99, tolerance: float = 1e-4, rounds_per_job: int = 10) -> Factors:
    """Update W, then H from the new W, until half the squared distance changes by at most `tolerance`.

    V lies in blocks of rows, which keep their entries as numpy arrays by blocks of columns. A round is a step at the rows and one at the columns, and what is shuffled is
    W, H, H once for each block with entries of a column, and the blocks' parts of W'V; the error comes from what those steps computed.
    `rounds_per_job` rounds are one job. If the end lies within a job's rounds, these are done again up to there.
    """
    spark = entries.sparkSession
    kinds = {c: entries.schema[c].dataType for c in ("row", "col")}
    entries = cut(entries)
    squares = entries.agg(F.sum(F.col("value") * F.col("value"))).first()[0] or 0.0
    tasks = tasks_for(entries)
    keys = even_keys(spark, tasks)
    dealt = lambda c: F.get(F.array(*[F.lit(key) for key in keys]), F.pmod(F.xxhash64(c), F.lit(tasks)).cast("int"))
    known = entries.filter(F.col("row").isNotNull() & F.col("col").isNotNull())
    cells = known.select(
        dealt("row").alias("block"), F.col("row").cast("bigint").alias("row"), F.col("col").cast("bigint").alias("col"),
        dealt("col").alias("to"), F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("value"),
    )
    packed = cut(cells.repartition(tasks, "block").groupBy("block").applyInArrow(_pack, _PACKED))
    # Both sides in one cache: a block's entries by `at` = `block`, the column numbers that its blocks of rows use by `at` = `of`.
    both = F.explode(F.array(F.struct(F.col("block").alias("at"), F.lit(0).alias("side")), F.struct(F.col("of").alias("at"), F.lit(1).alias("side"))))
    sided = packed.select("*", both.alias("x")).select("x.at", "x.side", *packed.columns).filter("side = 0 OR of >= 0")
    only = [F.when(F.col("side") == 0, F.col(c)).alias(c) for c in ("places", "cells")]
    placed = keep_placed(sided.select("at", "side", "block", "of", "ids", *only).repartition(tasks, "at").sortWithinPartitions("at"))

    def met(side: int, rows: DataFrame, step, schema: str) -> DataFrame:
        return placed.filter(F.col("side") == side).groupBy("at").cogroup(rows.groupBy("block")).applyInArrow(step, schema)

    def rounds(state: DataFrame, done: int, n: int) -> DataFrame:
        for step in range(done, done + n):
            state = met(1, met(0, state, _rows_step(k, keys, step == 0), _SENT), _columns_step(k, keys, step), _SENT)
            if step == done:
                state = state.filter((F.col("kind") != _LOG) | (F.col("of") >= done))
        return cut(state)

    def errors(state: DataFrame, done: int) -> list[float]:
        sums: dict[int, tuple] = {}
        for r in sorted(state.filter((F.col("kind") == _LOG) & (F.col("of") >= done)).collect(), key=lambda r: (r["of"], r["block"])):
            x = np.frombuffer(r["x"], np.float64)
            hh, ww = x[1 : 1 + k * k], x[1 + k * k :]
            cross, whole, _ = sums.get(r["of"], (0.0, 0.0, None))
            sums[r["of"]] = cross + x[0], whole + hh, ww
        return [_half_distance(squares, float(c), ww.reshape(k, k).tolist(), hh.reshape(k, k).tolist()) for _, (c, hh, ww) in sorted(sums.items())]

    try:
        with planned(spark, tasks):
            state = rounds(spark.createDataFrame([], _SENT), 0, 1)
            found = errors(state, 0) or [0.5 * squares]
            while len(found) <= max_rounds:
                done, before = len(found), state
                state = rounds(before, done, min(rounds_per_job, max_rounds + 1 - done))
                found += errors(state, done)
                if len(found) == done:
                    break  # no entries
                settled = [i for i in range(done, len(found)) if abs(found[i] - found[i - 1]) <= tolerance]
                if settled and settled[0] + 1 < len(found):
                    drop_cut(state)
                    found = found[: settled[0] + 1]
                    state = rounds(before, done, len(found) - done)
                drop_cut(before)
                if settled:
                    break
            schema = lambda key: f"{key} BIGINT, " + ", ".join(f"{c} DOUBLE" for c in factor_columns(k))
            values = lambda side, kind, key: cut(
                met(side, state.filter(F.col("kind") == kind), _factor(k, kind, key), schema(key)).withColumn(key, F.col(key).cast(kinds[key]))
            )
            # The rows' numbers stand in one row of a block.
            w = met(0, state.filter(F.col("kind") == _W), _row_factor(k), schema("row"))
            return Factors(cut(w.withColumn("row", F.col("row").cast(kinds["row"]))), values(1, _H, "col"), found)
    finally:
        placed.unpersist()


def _row_factor(k: int):
    run = _factor(k, _W, "row")
    return lambda placed, arrived: run(placed.filter(pc.equal(placed.column("of"), -1)), arrived)


def assign(w: DataFrame, k: int) -> DataFrame:
    """(row, cluster): the component with the largest weight."""
    return w.select("row", argmax_index(F.array(*factor_columns(k))).alias("cluster"))
