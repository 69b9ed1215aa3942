"""Random walk with restart from one vertex."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.propagate import packed_rows, unpacked
from cohortloom.session import cut, drop_cut, even_keys, keep_placed, planned

_PACKED = "block INT, of INT, srcs BINARY, dsts BINARY, starts BINARY, ends BINARY, si BINARY, di BINARY"
_ROUTED = "block INT, vids BINARY, degree BINARY, send BINARY, take BINARY"
_SENT = "block INT, of INT, x BINARY"


def _pack(table: pa.Table) -> pa.Table:
    """A block's edges (block, src, from, dst, to): their places among the block's sources and targets, which lie by the blocks of the vertices.

    A row for the block itself (of = -1, srcs the blocks of vertices, starts and ends the bounds of theirs), and a row with the sources and the targets of each block of vertices.
    """
    block = table.column("block")[0].as_py()
    sides, blocks = [], set()
    for vertex, home in (("src", "from"), ("dst", "to")):
        ids, first, at = np.unique(table.column(vertex).to_numpy(), return_index=True, return_inverse=True)
        homes = table.column(home).to_numpy()[first]
        order = np.lexsort((ids, homes))
        place = np.empty(len(ids), dtype=np.int32)
        place[order] = np.arange(len(ids), dtype=np.int32)
        sides.append((ids[order], homes[order], place[at.reshape(-1)]))
        blocks |= set(homes.tolist())
    (srcs, from_, si), (dsts, to, di) = sides
    of = np.array(sorted(blocks), dtype=np.int32)
    bounds = lambda homes: np.stack((np.searchsorted(homes, of, "left"), np.searchsorted(homes, of, "right"))).astype(np.int64)
    starts, ends = bounds(from_), bounds(to)
    # By target: their sums are then made in order.
    order = np.argsort(di, kind="stable")
    rows = [(block, -1, of, None, starts, ends, si[order], di[order])]
    rows += [(block, int(v), srcs[starts[0, i] : starts[1, i]], dsts[ends[0, i] : ends[1, i]], None, None, None, None) for i, v in enumerate(of)]
    return packed_rows(_PACKED, rows)


def _route(nodes: pa.Table, packed: pa.Table) -> pa.Table:
    """A block of vertices (block, vid, degree) with the vertices to send to each block of edges, and those that its sums are for."""
    if not nodes.num_rows:
        return packed_rows(_ROUTED, [])
    vids = nodes.column("vid").to_numpy()
    order = np.argsort(vids)
    vids, degree = vids[order], nodes.column("degree").to_numpy()[order].astype(np.float64)

    def places(cell: pa.Scalar) -> np.ndarray:
        ids = unpacked(cell, np.int64)
        at = np.searchsorted(vids, ids)
        known = at < len(vids)
        known[known] = vids[at[known]] == ids[known]
        return np.where(known, at, len(vids)).astype(np.int32)  # one place more for ids that are no vertex

    edges = packed.sort_by("block_of_edges")
    blocks = edges.column("block_of_edges").to_pylist()
    send, take = [[places(x) for x in edges.column(c)] for c in ("srcs", "dsts")]
    head = lambda parts: np.array([x for b, p in zip(blocks, parts, strict=True) for x in (b, len(p))], dtype=np.int32)
    whole = lambda parts: np.concatenate([np.array([len(parts)], dtype=np.int32), head(parts), *parts])
    return packed_rows(_ROUTED, [(nodes.column("block")[0].as_py(), vids, degree, whole(send), whole(take))])


def _parts(cell: pa.Scalar) -> dict[int, np.ndarray]:
    """The places of each block that `whole` in `_route` has laid one after another."""
    data = unpacked(cell)
    n = int(data[0])
    blocks, sizes = data[1 : 1 + 2 * n : 2].tolist(), data[2 : 2 + 2 * n : 2]
    ends = 1 + 2 * n + np.cumsum(sizes, dtype=np.int64)
    return {b: data[e - s : e] for b, s, e in zip(blocks, sizes, ends, strict=True)}


def _vertices(start: int, alpha: float, first: bool, last: bool):
    """A step at the vertices: the sums that arrived give their values, whose shares go to the blocks of edges; at the `last` one the values come back."""

    def run(placed: pa.Table, arrived: pa.Table) -> pa.Table:
        out = []
        for i in range(placed.num_rows):
            vids, degree = unpacked(placed.column("vids")[i], np.int64), unpacked(placed.column("degree")[i], np.float64)
            n = len(vids)
            value = np.zeros(n + 1)
            if not first:
                take = _parts(placed.column("take")[i])
                # In the order of the blocks, so that runs agree.
                sums = arrived.sort_by("of")
                for of, x in zip(sums.column("of").to_pylist(), sums.column("x"), strict=True):
                    value[take[of]] += (1 - alpha) * unpacked(x, np.float64)  # a target is there once
            at = np.searchsorted(vids, start)
            if at < n and vids[at] == start:
                value[at] += 1.0 if first else alpha
            if last:
                return pa.table([pa.array(vids), pa.array(value[:n])], names=["vid", "p"])
            share = np.zeros(n + 1)
            np.divide(value[:n], degree, out=share[:n], where=degree > 0)
            own = placed.column("block")[i].as_py()
            out += [(b, own, share[places]) for b, places in _parts(placed.column("send")[i]).items() if len(places)]
        return pa.table([pa.array([], pa.int64()), pa.array([], pa.float64())], names=["vid", "p"]) if last else packed_rows(_SENT, out)

    return run


def _along(placed: pa.Table, sent: pa.Table) -> pa.Table:
    """A step along a block's edges: the sources' shares, added up for each target."""
    out = []
    for i in range(placed.num_rows):
        of = unpacked(placed.column("srcs")[i]).tolist()
        starts, ends = [unpacked(placed.column(c)[i], np.int64).reshape(2, -1) for c in ("starts", "ends")]
        # Blocks without a vertex send nothing.
        x, at = np.zeros(int(starts[1].max(initial=0))), dict(zip(of, starts.T.tolist(), strict=True))
        for b, cell in zip(sent.column("of").to_pylist(), sent.column("x"), strict=True):
            x[slice(*at[b])] = unpacked(cell, np.float64)
        sums = np.bincount(unpacked(placed.column("di")[i]), weights=x[unpacked(placed.column("si")[i])], minlength=int(ends[1].max(initial=0)))
        own = placed.column("block")[i].as_py()
        out += [(b, own, sums[lo:hi]) for b, lo, hi in zip(of, *ends, strict=True) if hi > lo]
    return packed_rows(_SENT, out)


def _place(nodes: DataFrame, edges: DataFrame, start: int, rows_per_split: int, rows_per_block: int) -> tuple[DataFrame, DataFrame, int]:
    """(vertices, along, tasks): the blocks of vertices and of edges, kept in caches whose partitioning the planner knows.

    The edges of a vertex lie in one block, those of a vertex with more than `rows_per_split` are spread over several. A dead end has an edge
    back to the start.
    """
    spark = nodes.sparkSession
    edges = cut(edges.filter(F.col("src").isNotNull()).select("src", "dst"))
    degrees = cut(edges.groupBy(F.col("src").alias("vid")).agg(F.count("*").alias("degree")))
    known = cut(nodes.select("vid").filter(F.col("vid").isNotNull()).distinct().join(degrees, "vid", "left"))
    back = known.filter(F.col("degree").isNull()).select(F.col("vid").alias("src"), F.lit(start).cast("bigint").alias("dst"))
    rows = degrees.agg(F.sum("degree")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-(rows + known.count()) // rows_per_block))
    keys = F.array(*[F.lit(k) for k in even_keys(spark, tasks)])
    dealt = lambda *by: F.get(keys, F.pmod(F.xxhash64(*by), F.lit(tasks)).cast("int"))
    hubs = cut(degrees.filter(F.col("degree") > rows_per_split).select(F.col("vid").alias("src"), F.ceil(F.col("degree") / rows_per_split).alias("splits")))
    slot = F.when(F.col("splits").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("dst"), F.col("splits"))).cast("int")
    slotted = edges.filter(F.col("dst").isNotNull()).join(hubs, "src", "left").select("src", "dst", slot.alias("slot"))
    slotted = slotted.unionByName(back.withColumn("slot", F.lit(0))).select(
        dealt("src", "slot").alias("block"), "src", dealt("src").alias("from"), "dst", dealt("dst").alias("to")
    )
    packed = cut(slotted.repartition(tasks, "block").groupBy("block").applyInArrow(_pack, _PACKED))
    drop_cut(edges)
    routes = packed.filter("of >= 0").select(F.col("of").alias("block"), F.col("block").alias("block_of_edges"), "srcs", "dsts")
    homes = known.select(dealt("vid").alias("block"), "vid", F.coalesce("degree", F.lit(1)).alias("degree"))
    with planned(spark, tasks):
        routed = cut(homes.groupBy("block").cogroup(routes.groupBy("block")).applyInArrow(_route, _ROUTED))
    along = packed.filter("of < 0").select("block", "srcs", "starts", "ends", "si", "di")
    placed = [keep_placed(t.repartition(tasks, "block").sortWithinPartitions("block")) for t in (routed, along)]
    return *placed, tasks


def restart_walk(
    nodes: DataFrame,
    edges: DataFrame,
    start: int,
    rounds: int = 100,
    alpha: float = 0.15,
    tolerance: float | None = None,
    rows_per_split: int = 100_000,
    cut_every: int = 10,
    rows_per_block: int = 2_000_000,
) -> DataFrame:
    """(vid, probability) after `rounds` of r <- alpha * e + (1 - alpha) * P'r, from all mass at `start`.

    Every out-edge of a vertex is equally likely. Mass on vertices without out-edges returns to the start.

    Vertices and edges lie in blocks (`_place`), which are numpy arrays: a round is a step at the vertices, whose shares go once to each block with edges
    of theirs, and a step along the edges, whose sums go once to each target. `cut_every` rounds are one job. What is left of the first vector after k rounds
    is (1 - alpha)^k, so k rounds are within 2 * (1 - alpha)^k of the limit: with `tolerance` the walk does no more rounds than this bound asks for.
    `start` has to be in `nodes`, else nothing is reached.
    """
    if tolerance is not None:
        rounds = min(rounds, math.ceil(math.log(tolerance / 2) / math.log(1 - alpha)))
    spark = nodes.sparkSession
    vertices, along, tasks = _place(nodes, edges, start, rows_per_split, rows_per_block)

    def met(placed: DataFrame, rows: DataFrame, step, schema: str) -> DataFrame:
        return placed.groupBy("block").cogroup(rows.groupBy("block")).applyInArrow(step, schema)

    arrived, before = spark.createDataFrame([], _SENT), None
    with planned(spark, tasks):
        for step in range(rounds):
            sent = met(vertices, arrived, _vertices(start, alpha, step == 0, False), _SENT)
            arrived = met(along, sent, _along, _SENT)
            if (step + 1) % cut_every == 0 or step + 1 == rounds:
                arrived = cut(arrived)
                if before is not None:
                    drop_cut(before)
                before = arrived
        reached = cut(met(vertices, arrived, _vertices(start, alpha, rounds == 0, True), "vid BIGINT, p DOUBLE"))
    vertices.unpersist()
    along.unpersist()
    return nodes.select("vid").join(reached, "vid", "left").select("vid", F.coalesce("p", F.lit(0.0)).alias("probability"))


def walk_top_patients(nodes: DataFrame, edges: DataFrame, start: int, k: int = 10, **options) -> DataFrame:
    """(key, probability): the k other patients the walk visits most; ties go to the smaller vertex."""
    ranked = restart_walk(nodes, edges, start, **options).join(nodes, "vid")
    others = ranked.filter((F.col("kind") == "patient") & (F.col("vid") != start))
    return others.orderBy(F.desc("probability"), "vid").limit(k).select("key", "probability")
