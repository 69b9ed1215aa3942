"""Numbering and running totals that do not send a whole table through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortloom.session import cut, drop_cut, pin

# monotonically_increasing_id keeps the partition number above these bits, the row position below.
_POSITION_BITS = 33


def dense_index(df: DataFrame, order_by: list[str | Column], name: str = "idx") -> DataFrame:
    """Number the rows 0, 1, 2, ... in the given order.

    The rows are range-sorted and checkpointed; each row's number is its position in its partition
    plus the sizes of the partitions before it. Only one row per partition is ever gathered.
    """
    placed = pin(df.orderBy(*order_by)).withColumn("_at", F.monotonically_increasing_id())
    part = F.shiftright("_at", _POSITION_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    position = F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")  # one row per partition of the sorted data
        .withColumn(name, F.col("_start") + position)
        .drop("_part", "_start", "_at")
    )


def cut_points(df: DataFrame, key: str, by: list[str], rows_per_range: int, most: int) -> DataFrame:
    """(by, _cuts): for each group the values of numeric `key` that cut its rows into ranges of about `rows_per_range`.

    Each group has its own quantile sketch, merged from those of the tasks, so groups on different scales are
    cut evenly and no group is sorted. The number of ranges is the power of two that a group's rows ask for, `most` (itself one) at most.
    """
    sketched = df.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(key).cast("double")).alias("_sketch"), F.count(key).alias("_n"))
    grid = F.kll_sketch_get_quantile_double("_sketch", F.array(*[F.lit(i / most) for i in range(1, most)]))
    ranges = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.lit(1.0), F.col("_n") / rows_per_range))))
    step = F.greatest(F.lit(1), F.lit(most) / ranges).cast("int")
    cut_grid = sketched.filter("_n > 0").withColumn("_step", step).withColumn("_grid", grid)
    return cut_grid.select(*by, F.array_distinct(F.filter("_grid", lambda x, i: (i + 1) % F.col("_step") == 0)).alias("_cuts"))


def exact_quantile(
    df: DataFrame, key: str, q: float, by: list[str] | None = None, name: str = "quantile", rows_per_range: int = 50_000, most_ranges: int = 256
) -> DataFrame:
    """(by, name): the exact `q` quantile of numeric `key` per group, interpolated between its two neighbours.

    The range of values that holds the two ranks is narrowed round by round: cut points from each
    group's sketch, counts per range, and only the ranges with the ranks stay. After the first round
    equal values are one row with their number. When no group has more than `rows_per_range`
    distinct values left, these are added up in order. Nulls do not count; a group without values has no row.
    """
    groups = by or ["_all"]
    rows = df.filter(F.col(key).isNotNull()).withColumn("_n", F.lit(1).cast("long")).withColumn("_all", F.lit(1)).select(*groups, key, "_n")
    same = lambda left, right, on=groups: [left[g].eqNullSafe(right[g]) for g in on]
    place = F.lit(q) * (F.sum("_n") - 1)
    ranks = cut(rows.groupBy(*groups).agg(F.floor(place).alias("_low"), F.ceil(place).alias("_high"), (place - F.floor(place)).alias("_share")))
    old, widest = [ranks], None
    while True:
        points = cut(cut_points(rows, key, groups, 1, most_ranges))
        at = F.size(F.filter("_cuts", lambda c: c < F.col(key))).alias("_range")
        ranged = rows.join(points, same(rows, points)).select(*[rows[g] for g in groups], key, "_n", at)
        counts = ranged.groupBy(*groups, "_range").agg(F.sum("_n").alias("_in"))
        upto = W.partitionBy(*groups).orderBy("_range").rowsBetween(W.unboundedPreceding, 0)
        counts = counts.withColumn("_end", F.sum("_in").over(upto)).withColumn("_before", F.col("_end") - F.col("_in"))
        held = counts.join(ranks, same(counts, ranks)).filter("_high >= _before AND _low < _end")
        held = cut(held.select(*[counts[g] for g in groups], "_range", "_before", "_low", "_high", "_share"))
        rows = cut(ranged.join(held, same(ranged, held, [*groups, "_range"]), "left_semi").groupBy(*groups, key).agg(F.sum("_n").alias("_n")))
        first = F.min("_before")
        ranks = cut(held.groupBy(*groups, "_share").agg((F.min("_low") - first).alias("_low"), (F.min("_high") - first).alias("_high")))
        for table in [*old, points, held]:
            drop_cut(table)
        old, last = [rows, ranks], widest
        widest = rows.groupBy(*groups).agg(F.count("*").alias("n")).agg(F.max("n")).collect()[0][0] or 0  # one number
        if widest <= rows_per_range or widest == last:
            break
    ended = rows.withColumn("_end", F.sum("_n").over(W.partitionBy(*groups).orderBy(key).rowsBetween(W.unboundedPreceding, 0)))
    value = lambda rank: F.min(F.when(F.col("_end") > F.col(rank), F.col(key))).cast("double")
    found = ended.join(ranks, same(ended, ranks)).groupBy(*[ended[g] for g in groups], "_share").agg(value("_low").alias("_a"), value("_high").alias("_b"))
    return found.select(*(by or []), (F.col("_a") * (1 - F.col("_share")) + F.col("_b") * F.col("_share")).alias(name))


def running_totals(
    df: DataFrame, key: str, totals: dict[str, str], by: list[str] | None = None, rows_per_range: int = 50_000, most_ranges: int = 1024
) -> DataFrame:
    """Running sums over descending numeric `key`, where `df` has one row per (by, key).

    `totals` maps a value column to the name of its running sum. Cut points from each group's own
    quantiles split it into ranges; range totals give each range its starting offset, and the sums
    then run inside (by, range) only. Equal keys never straddle a range, as there is one row for each.
    """
    by = by or []
    columns = df.columns
    if not by:
        df = df.withColumn("_all", F.lit(1))
    groups = by or ["_all"]
    df = cut(df)  # read for the sketches, the range totals and the sums
    points = cut(cut_points(df, key, groups, rows_per_range, most_ranges))
    # Both sides are tables: a small one is broadcast, else the runtime can split a group with many rows.
    ranged = cut(df.join(points, groups).withColumn("_range", F.size(F.filter("_cuts", lambda c: c < F.col(key)))).drop("_cuts"))
    drop_cut(df)
    range_sums = ranged.groupBy(*groups, "_range").agg(*[F.sum(c).alias(f"_sum_{c}") for c in totals])
    above = W.partitionBy(*groups).orderBy(F.desc("_range")).rowsBetween(W.unboundedPreceding, -1)
    offsets = range_sums.select(
        *groups, "_range", *[F.coalesce(F.sum(f"_sum_{c}").over(above), F.lit(0)).alias(f"_from_{c}") for c in totals]
    )
    inside = W.partitionBy(*groups, "_range").orderBy(F.desc(key)).rowsBetween(W.unboundedPreceding, 0)
    return (
        ranged.join(offsets, [*groups, "_range"])
        .select(*columns, *[(F.col(f"_from_{c}") + F.sum(c).over(inside)).alias(name) for c, name in totals.items()])
    )


def running_count(df: DataFrame, by: str, order_by: list[str], bucket: Column, name: str) -> DataFrame:
    """1, 2, 3, ... within each `by` group in the given order.

    `bucket` must not decrease along the order (a month of the ordering date, say). Groups are
    numbered inside (by, bucket) and shifted by the counts of earlier buckets, so one very large
    group is spread over its buckets.
    """
    rows = df.withColumn("_bucket", bucket)
    counts = rows.groupBy(by, "_bucket").agg(F.count("*").alias("_n"))
    before = W.partitionBy(by).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(by, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = W.partitionBy(by, "_bucket").orderBy(*order_by)
    return (
        rows.withColumn("_rank", F.row_number().over(inside))
        .join(starts, [by, "_bucket"])
        .withColumn(name, F.col("_start") + F.col("_rank"))
        .drop("_bucket", "_rank", "_start")
    )
