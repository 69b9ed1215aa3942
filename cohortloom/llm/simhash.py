"""Near-duplicates by SimHash: exact tiled comparison of fingerprints, then connected components.

Tiles. Documents with one fingerprint are one row from the start. Two fingerprints within the
radius agree on at least one of `radius + 1` blocks of bits, so each is sent to the bucket of each of
its block values; a bucket of more than a tile's rows is cut again by blocks of its other bits. What
still exceeds a tile (fingerprints close to each other by the thousand) is cut by population count
and hash into tiles, and every pair of tiles whose population counts are within the radius is compared
by its own group. So a group never has more than two tiles, and no link is lost.

Inside a group numpy compares blocks of rows by exclusive-or and bit count, skipping pairs of blocks
whose population counts differ beyond the radius, and hands on a spanning forest of the links, not
the pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from cohortloom.llm.text import free, utf8
from cohortloom.operators.relational import spread_lookup
from cohortloom.session import cut

BITS = 64
#: Rows of a tile.
TILE = 2048
#: Rows of a block that numpy compares at once, so that the exclusive-or of two blocks fits a cache.
BLOCK = 256
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_LANE = np.arange(8, dtype=np.int64) * 256


def simhash(text: bytes | None, size: int = 4, seed: int = 42) -> int:
    """Fingerprint of one text: a bit is set if over half of the shingle hashes have it; 0 without words."""
    words = (text or b"").lower().split()  # on bytes: A-Z only, and white space of ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    size = min(size, len(words))
    spans = zip(starts[: len(words) - size + 1].tolist(), (ends[size - 1 :] - 1).tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, len(words) - size + 1)
    lanes = hashes.view(np.uint8).reshape(-1, 8) + _LANE
    counts = np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256) @ _BYTE_BITS
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits.ravel(), bitorder="little").view("<u8")[0])


@F.arrow_udf(LongType())
def _simhash(column: pa.Array) -> pa.Array:
    return pa.array(np.array([simhash(t) for t in utf8(column)], dtype=np.uint64).view(np.int64))


def fingerprint(text: Column) -> Column:
    """The 64-bit SimHash of a text column as a signed long; null and texts without words give 0."""
    return _simhash(text)


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _blocks(bits: list[int], n: int) -> list[list[int]]:
    """`bits` dealt into n blocks of consecutive positions, sizes as equal as can be."""
    return [[int(b) for b in part] for part in np.array_split(np.array(bits), n)]


def _value(fp: Column, bits: list[int]) -> Column:
    """The bits of one block, which are consecutive but for one gap at most, as an integer."""
    out, shift, at = F.lit(0).cast("long"), 0, 0
    while at < len(bits):
        end = at
        while end + 1 < len(bits) and bits[end + 1] == bits[end] + 1:
            end += 1
        width = end - at + 1
        part = F.shiftrightunsigned(fp, bits[at]).bitwiseAND(F.lit((1 << width) - 1))
        out, shift, at = out.bitwiseOR(F.shiftleft(part, shift)), shift + width, end + 1
    return out


def _compare(fps: np.ndarray, sides: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of positions with at most `radius` differing bits; with `sides`, only pairs across."""
    ones = np.bitwise_count(fps)
    order = np.argsort(ones, kind="stable")
    fps, ones = fps[order], ones[order].astype(np.int64)
    left, right = [], []
    for a in range(0, len(fps), BLOCK):
        last = ones[min(a + BLOCK, len(fps)) - 1]
        for b in range(a, len(fps), BLOCK):
            if ones[b] - last > radius:
                break  # population counts rise from block to block
            near = np.bitwise_count(fps[a : a + BLOCK, None] ^ fps[None, b : b + BLOCK]) <= radius
            i, j = np.nonzero(near)
            ahead = i + a < j + b
            left.append(order[i[ahead] + a])
            right.append(order[j[ahead] + b])
    i, j = np.concatenate(left or [np.zeros(0, np.int64)]), np.concatenate(right or [np.zeros(0, np.int64)])
    if sides is not None and len(i):
        across = sides[i] != sides[j]
        i, j = i[across], j[across]
    return i, j


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n positions the smallest position that it reaches over the pairs."""
    label = np.arange(n)
    while len(i):
        least = np.minimum(label[i], label[j])
        nxt = label.copy()
        np.minimum.at(nxt, i, least)
        np.minimum.at(nxt, j, least)
        nxt = nxt[nxt]
        if np.array_equal(nxt, label):
            break
        label = nxt
    return label


def _grouped(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(fingerprints, sides) of each group; the rows come sorted by group."""
    rest: list[np.ndarray] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        here = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
        rest = [np.concatenate(x) for x in zip(rest, here, strict=True)] if rest else here
        bounds = np.flatnonzero(rest[0][1:] != rest[0][:-1]) + 1
        for a, b in zip(np.concatenate(([0], bounds[:-1])), bounds, strict=False):
            yield rest[1][a:b].view(np.uint64), rest[2][a:b]
        rest = [x[bounds[-1] :] for x in rest] if len(bounds) else rest
    if rest:
        yield rest[1].view(np.uint64), rest[2]


def links(fps: DataFrame, radius: int = 4, tile: int = TILE) -> DataFrame:
    """(a, b): links between the distinct fingerprints of column `fp` (long) that connect all within `radius`.

    The links of a group are a spanning forest: following them reaches exactly what following all
    pairs within the radius reaches. An empty table and a single fingerprint have none.
    """
    blocks = _blocks(list(range(BITS)), radius + 1)
    fp = F.col("fp")

    def keyed(rows: DataFrame, head: list[Column], cuts: list[list[int]]) -> DataFrame:
        """A row per fingerprint and block, `key` made of `head`, the block's number and its value."""
        options = F.array(*[F.xxhash64(*head, F.lit(n), _value(fp, bits)) for n, bits in enumerate(cuts)])
        return rows.select("fp", F.explode(options).alias("key"))

    def sized(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows of groups that fit a tile, and the rest with the group's size."""
        size = rows.groupBy("key").agg(F.count("*").alias("size")).filter(F.col("size") > tile)
        marked = rows.join(size, "key", "left")
        return marked.filter("size IS NULL").select("key", "fp"), marked.filter("size IS NOT NULL")

    # Keys are hashes: two groups that share one are compared together, which costs time and changes nothing.
    first = cut(fps.select("fp", F.posexplode(F.array(*[_value(fp, b) for b in blocks])).alias("block", "value")))
    first = first.withColumn("key", F.xxhash64("block", "value"))
    size = first.groupBy("key").agg(F.count("*").alias("size")).filter(F.col("size") > tile)
    marked = first.join(size, "key", "left")
    small = marked.filter("size IS NULL").select("key", "fp")
    second = None
    for n, bits in enumerate(blocks):
        others = _blocks([b for b in range(BITS) if b not in bits], radius + 1)
        part = keyed(marked.filter((F.col("size").isNotNull()) & (F.col("block") == n)), [F.col("key")], others)
        second = part if second is None else second.unionByName(part)
    small_2, large = sized(cut(second))
    ones = F.bit_count("fp")
    counts = cut(large.groupBy("key", ones.alias("ones")).agg(F.count("*").alias("rows")))
    slices = F.ceil(F.col("rows") / F.lit(tile)).cast("int")
    tiles = counts.select("key", "ones", slices.alias("slices"))
    mine = large.select("key", "fp", ones.alias("ones")).join(tiles, ["key", "ones"])
    mine = mine.withColumn("slice", F.pmod(F.xxhash64("fp"), F.col("slices")).cast("int"))
    # The tiles of the same group that each tile meets: those of an equal or higher count, at most 65 * slices.
    partner = tiles.select("key", F.col("ones").alias("ones_2"), F.col("slices").alias("slices_2"))
    met = tiles.join(partner, "key").filter(F.col("ones_2").between(F.col("ones"), F.col("ones") + radius))
    met = met.select("key", "ones", "ones_2", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), "slices_2")
    met = met.select("key", "ones", "slice", "ones_2", F.explode(F.sequence(F.lit(0), F.col("slices_2") - 1)).alias("slice_2"))
    met = met.filter((F.col("ones") < F.col("ones_2")) | (F.col("slice") <= F.col("slice_2")))
    pair = F.xxhash64("key", "ones", "slice", "ones_2", "slice_2")
    lower = mine.join(met, ["key", "ones", "slice"]).select(pair.alias("key"), "fp", F.lit(0).alias("side"))
    second_key = [F.col("key"), F.col("ones_2").alias("ones"), F.col("slice_2").alias("slice")]
    upper_of = met.filter((F.col("ones") != F.col("ones_2")) | (F.col("slice") != F.col("slice_2"))).select(*second_key, pair.alias("pair"))
    upper = mine.join(upper_of, ["key", "ones", "slice"]).select(F.col("pair").alias("key"), "fp", F.lit(1).alias("side"))
    groups = small.unionByName(small_2).withColumn("side", F.lit(0)).unionByName(lower).unionByName(upper)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, held = [], [], 0
        for found, _ in _grouped(batches):
            if len(found) < 2:
                continue
            i, j = _compare(found, None, radius)
            if not len(i):
                continue
            root = _forest(len(found), i, j)
            moved = np.flatnonzero(root != np.arange(len(found)))
            a.append(found[moved].view(np.int64))
            b.append(found[root[moved]].view(np.int64))
            held += len(moved)
            if held > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])
                a, b, held = [], [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    dealt = groups.repartition("key").sortWithinPartitions("key").select("key", "fp", "side")
    return dealt.mapInArrow(compare, "a BIGINT, b BIGINT").distinct()


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, root) for every node of the edges (a, b): the smallest node of its connected component.

    Alternating stars: nodes hang their larger neighbours on their smallest one, then their smaller
    neighbours. The edges stay as many as the nodes at most and end as one star per component; the
    number of rounds grows with the logarithm of the component's size.
    """

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).collect()[0])

    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct())
    before = state(edges)
    for _ in range(rounds):
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = spread_lookup(both.filter(F.col("b") > F.col("a")), low, "a")
        stars = cut(large.select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a != b").distinct())
        low = stars.groupBy("a").agg(F.min("b").alias("low"))
        hung = spread_lookup(stars, low, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"))
        edges = cut(hung.select("e.a", "e.b").filter("a != b").distinct())
        after = state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components have not settled after {rounds} rounds")
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def assign(marked: DataFrame, radius: int = 4) -> DataFrame:
    """(fp, root, component_id) for every fingerprint of `marked` (doc_id, fp), which is read twice.

    root: one fingerprint of the component; component_id: the component's smallest doc_id.
    """
    groups = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(groups.select("fp"), radius)).withColumnRenamed("node", "fp")
    placed = groups.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    firsts = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    return cut(spread_lookup(placed.select("fp", "root"), firsts, "root").select("fp", "root", "component_id"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 4) -> DataFrame:
    """(doc_id, fp, component_id) for every row of `docs`: its fingerprint and the smallest id within reach.

    Repeated rows stay repeated rows. A null id takes part but is never the smallest, so a component
    of null ids alone has a null component_id. Other columns are not read.
    """
    marked = cut(docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text)).alias("fp")))
    of = assign(marked, radius).select("fp", "component_id")
    return spread_lookup(marked, of, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 4) -> DataFrame:
    """One row of `docs`, all columns, for each component: that of its smallest id, nulls last.

    Of several rows with that id the one with the smallest fingerprint stays, of equal ones any.
    """
    fp = free(docs, "fp")
    rows = cut(docs.withColumn(fp, fingerprint(F.col(text))))
    marked = rows.select(F.col(doc_id).alias("doc_id"), F.col(fp).alias("fp"))
    of = spread_lookup(marked.distinct(), assign(marked, radius).select("fp", "root"), "fp")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "fp")
    best = of.groupBy("root").agg(F.min(order).alias("best")).select(F.col("best.doc_id").alias("kept_id"), F.col("best.fp").alias("kept_fp"))
    same = F.col(f"rows.{doc_id}").eqNullSafe(F.col("best.kept_id")) & (F.col(f"rows.{fp}") == F.col("best.kept_fp"))
    kept = rows.alias("rows").join(best.alias("best"), same, "left_semi")
    return kept.dropDuplicates([doc_id, fp]).drop(fp)
