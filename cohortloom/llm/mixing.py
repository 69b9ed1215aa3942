"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a row of slots of `block` tokens, whatever the size of the data. Each source has as many
slots as its target fills, the last one cut where the target ends, so targets are met exactly. Slot
k takes the k-th golden-ratio point, rounded to the lattice of all slots so that each point occurs
once, through the cumulative slots of the sources, which names its source; slots are ranked within
their source, and the slot of rank r takes block r of that source. A source's blocks are its
documents in shuffled order, end to end, as often as a document may be repeated. Because every
prefix of the sequence is spread evenly, each source has its share of every stretch of the mix.

Ranks and token offsets are sums inside ranges plus the totals of earlier ranges, so a source, or an
id, with a third of all rows is spread over many tasks. Only the table of sources, one row each, is
ordered in one task. A document's length does not matter: only its number of words travels.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortloom.llm.text import WORD, free, numbered
from cohortloom.session import cut

#: floor(2^32 / golden ratio).
GOLDEN = 2654435769
#: Tokens of a block.
BLOCK = 2048
#: Documents, or slots, that are summed or ranked in one group.
RANGE = 4096


def size_in_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: list[int], share: float, most: float) -> DataFrame:
    """(source, source_size, target) from (source, size) rows, one per document.

    Sources in code-point order, null last, weigh `weights` in turn. Together they shall give
    `share` times all sizes; a source gives at most `most` times its own and the rest goes to the
    others by weight, until nobody is above. In closed form: target = min(cap, level * weight), and
    the level follows from the sources in the order in which they reach their caps.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ranked = sources.withColumn("rank", rank).withColumn("weight", weight).withColumn("cap", F.lit(most) * F.col("source_size"))
    by_cap = W.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_cap.rowsBetween(W.unboundedPreceding, -1)
    after = by_cap.rowsBetween(0, W.unboundedFollowing)
    every = W.orderBy("rank").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    left = F.lit(share) * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    levels = ranked.withColumn("level", left / F.sum("weight").over(after))
    # The first source, by the order of caps, that does not reach its cap fixes the level: the highest that fits.
    fits = F.col("level") * F.col("weight") <= F.col("cap")
    level = F.max(F.when(fits, F.col("level"))).over(every)
    target = F.coalesce(F.least(F.col("cap"), level * F.col("weight")), F.col("cap"))
    return levels.withColumn("target", target).select("source", "source_size", "target", "rank")


def multiplier(slots: int) -> int:
    """The whole number nearest below slots / golden ratio that shares no factor with `slots`."""
    step = slots * GOLDEN >> 32
    while math.gcd(step, slots) != 1:
        step -= 1
    return step


def product(turn: Column, step: int, slots: int) -> Column:
    """turn * step modulo slots, by digits of 20 bits, so that no partial product leaves 64 bits."""
    if slots >= 1 << 41:
        raise ValueError("more than 2^41 slots: take longer blocks")
    out = F.lit(0).cast("long")
    for shift in (40, 20, 0):
        digit = F.shiftright(turn, shift).bitwiseAND(F.lit((1 << 20) - 1))
        out = (out * (1 << 20) + digit * F.lit(step)) % F.lit(slots)
    return out


def schedule(plan: DataFrame, block: int) -> DataFrame:
    """(source, rank, turn): slot `turn` of the mix takes the `rank`-th block of `source`, both from 0."""
    spark = plan.sparkSession
    steps = W.orderBy("rank").rowsBetween(W.unboundedPreceding, 0)
    blocks = F.ceil(F.col("take") / block)
    ends = plan.withColumn("end", F.sum(blocks).over(steps)).withColumn("begin", F.col("end") - blocks).filter("end > begin")
    slots = plan.agg(F.sum(blocks)).collect()[0][0] or 0  # one number
    width = max(1, -(-slots // 1024))
    # Each source stands in the cells of the line that its stretch touches: an equi-join finds a point's source.
    lines = ends.select("source", "begin", "end", F.explode(F.sequence(F.floor(F.col("begin") / width), F.floor((F.col("end") - 1) / width))).alias("cell"))
    at = product(F.col("id"), multiplier(slots), slots) if slots else F.lit(0).cast("long")
    points = spark.range(slots).select(F.col("id").alias("turn"), at.alias("at")).withColumn("cell", F.floor(F.col("at") / width))
    dealt = cut(points.join(lines, "cell").filter("at >= begin AND at < end").select("source", "turn", F.floor(F.col("turn") / RANGE).alias("range")))
    first = dealt.groupBy("source", "range").agg(F.count("*").alias("n"))
    earlier = W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    first = first.select("source", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    inside = W.partitionBy("source", "range").orderBy("turn")
    numbered = dealt.withColumn("at", F.row_number().over(inside) - 1)
    same = [numbered["source"].eqNullSafe(first["source"]), numbered["range"] == first["range"]]
    return numbered.join(first, same).select(numbered["source"], (F.col("first") + F.col("at")).alias("rank"), "turn")


def copies(docs: DataFrame, seed: str) -> DataFrame:
    """`docs` with draw, chunk and copy: the shuffling hash, and which of the equal rows of a chunk a row is.

    Rows equal in id, mark, source and size have one draw and are interchangeable. A chunk is a stretch of
    stored row numbers, so even if all rows are equal no group has more than a chunk's.
    """
    draw = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), "mark"))
    rows = docs.withColumn("draw", draw).withColumn("chunk", F.floor(F.col("row") / RANGE))
    return rows.withColumn("copy", F.row_number().over(W.partitionBy("source", "draw", "size", "chunk").orderBy("row")) - 1)


def layout(docs: DataFrame, plan: DataFrame, seed: str, repeats: int) -> DataFrame:
    """(row, source, size, begin, epoch, take): where each document begins in its source's shuffled row of tokens.

    The order is that of a hash of the seed, the id and the mark; equal rows stand one behind the
    other. A rerun draws the same. Documents that begin behind their source's target are left out.
    """
    docs = docs.filter("size > 0")
    ranges = max(1, -(-docs.count() // RANGE))
    # The first 28 bits of the hash put the documents into ranges whose order is the hash's order.
    place = F.floor(F.conv(F.substring("draw", 1, 7), 16, 10).cast("long") * ranges / (1 << 28))
    rows = cut(copies(docs, seed))
    stacks = rows.groupBy("source", "draw", "size", "chunk").agg((F.count("*") * F.col("size")).alias("words")).withColumn("range", place)
    sums = rows.groupBy("source", place.alias("range")).agg(F.sum("size").alias("total"))
    earlier = W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("of"), F.col("range").alias("in"), F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("first"))
    inside = W.partitionBy("source", "range").orderBy("draw", "size", "chunk").rowsBetween(W.unboundedPreceding, -1)
    stacks = stacks.withColumn("within", F.coalesce(F.sum("words").over(inside), F.lit(0)))
    stacks = stacks.join(sums, stacks["source"].eqNullSafe(sums["of"]) & (stacks["range"] == sums["in"]))
    whole = plan.select(F.col("source").alias("of"), "source_size", "take")
    stacks = stacks.drop("of").join(whole, stacks["source"].eqNullSafe(whole["of"])).select(
        F.col("source").alias("of"), F.col("draw").alias("by"), F.col("size").alias("words"), F.col("chunk").alias("in"), (F.col("first") + F.col("within")).alias("start"), "source_size", "take"
    )
    same = [rows["source"].eqNullSafe(stacks["of"]), rows["draw"] == stacks["by"], rows["size"] == stacks["words"], rows["chunk"] == stacks["in"]]
    epochs = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("epoch")
    begins = rows.join(stacks, same).select("row", "source", "size", "copy", "start", "source_size", "take", epochs)
    begin = F.col("start") + F.col("copy") * F.col("size") + F.col("epoch") * F.col("source_size")
    return begins.select("row", "source", "size", "epoch", "take", begin.alias("begin")).filter("begin < take")


def mix(
    docs: DataFrame, weights: list[int], share: float = 1.5, most: int = 2, seed: str = "mix", block: int = BLOCK,
) -> tuple[DataFrame, DataFrame]:
    """(pieces, plan) for docs (row, doc_id, source, size[, mark]).

    `row` is a unique whole number; the rest may be null or repeat. `mark`, a string, tells rows of
    equal id and size apart; without it they count as copies of one another.
    pieces: (turn, row, source, epoch, from_word, to_word), the words of a document that the slot
    `turn` takes, in the document's own counting. plan: (source, source_size, target). Documents of
    size 0 have no pieces; no documents give empty tables.
    """
    mark = F.col("mark") if "mark" in docs.columns else F.lit("")
    docs = docs.select("row", "doc_id", "source", F.coalesce("size", F.lit(0)).cast("long").alias("size"), mark.alias("mark"))
    plan = cut(targets(docs, weights, share, most).withColumn("take", F.round("target").cast("long")))
    row_of = layout(docs, plan, seed, most).withColumn("stop", F.least(F.col("begin") + F.col("size"), "take"))
    blocks = F.explode(F.sequence(F.floor(F.col("begin") / block), F.floor((F.col("stop") - 1) / block)))
    parts = row_of.select("row", "source", "epoch", "begin", "stop", blocks.alias("rank"))
    turns = schedule(plan, block).withColumnRenamed("source", "of").withColumnRenamed("rank", "block")
    start, end = F.greatest(F.col("rank") * block, "begin"), F.least((F.col("rank") + 1) * block, "stop")
    pieces = parts.join(turns, parts["source"].eqNullSafe(turns["of"]) & (parts["rank"] == turns["block"])).select(
        "turn", "row", "source", "epoch", (start - F.col("begin")).alias("from_word"), (end - F.col("begin")).alias("to_word")
    )
    return pieces, plan.select("source", "source_size", "target")


def taken(docs: DataFrame, weights: list[int], **options) -> DataFrame:
    """(row, doc_id, source, size, source_size, target, taken, first_turn) of each document.

    taken: how many words the mix takes of it; first_turn: the slot that does so first, null for none.
    """
    pieces, plan = mix(docs, weights, **options)
    words = pieces.groupBy("row").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"), F.min("turn").alias("first_turn"))
    plan = plan.withColumnRenamed("source", "of")
    rows = docs.join(words, "row", "left")
    return rows.join(plan, rows["source"].eqNullSafe(plan["of"])).select(
        "row", "doc_id", "source", F.coalesce("size", F.lit(0)).alias("size"), "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "first_turn"
    )


def mark(text: str) -> Column:
    return F.coalesce(F.md5(text), F.lit("null"))


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(row, doc_id, source, size, mark), written once: what the mix needs of a table of texts."""
    return cut(
        docs.select(
            F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
            size_in_words(text).alias("size"), mark(text).alias("mark"),
        )
    )


def remix(docs: DataFrame, weights: list[int], text: str = "text", source: str = "source", **options) -> DataFrame:
    """`docs` as often as the mix takes them, all columns: taken / size times, rounded to whole documents.

    A document of which the mix takes less than half does not appear; texts without words never do.
    """
    rows, key = numbered(docs)
    sizes = rows.select(
        F.col(key).alias("row"), F.col(key).alias("doc_id"), F.col(source).alias("source"), size_in_words(text).alias("size"), mark(text).alias("mark")
    )
    times = F.round(F.col("taken") / F.col("size")).cast("int")
    kept = taken(cut(sizes), weights, **options).filter("size > 0").select(F.col("row").alias(key), times.alias("times")).filter("times > 0")
    times, copy = free(rows, "times"), free(rows, "copy")
    kept = kept.withColumnRenamed("times", times)
    repeated = rows.join(kept, key).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times))))
    return repeated.drop(key, times, copy)
