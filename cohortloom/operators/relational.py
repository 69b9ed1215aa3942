"""Relational building blocks: joins, set operations, samples and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.columns import hash_unit, hash_unit_for
from cohortloom.functions.ordered import dense_index


def keep_codes(rows: DataFrame, column: str, codes: DataFrame) -> DataFrame:
    """Rows whose lower-cased `column` is in the one-column frame `codes`.

    No broadcast hint: the list's size is the caller's, so the planner decides from its statistics.
    """
    listed = codes.select(F.lower(codes.columns[0]).alias("_code"))
    return rows.join(listed, F.lower(rows[column]) == F.col("_code"), "left_semi")


def spread_lookup(rows: DataFrame, dim: DataFrame, on: str, how: str = "inner", ways: int = 4) -> DataFrame:
    """Join rows to `dim`, which has one row per `on`, without tying a key to one task.

    A lookup table that was aggregated by the same key is already partitioned by it, and the join
    would then run in place: neither the planner nor the runtime could split a key that holds a
    large share of the rows. Here each key has `ways` slots, the rows' slot follows from their
    content and the lookup row is repeated per slot. Both sides get a shuffle of their own, so the
    runtime can split them further; a small enough `dim` is broadcast as usual.
    """
    slot = F.pmod(F.xxhash64(*rows.columns), F.lit(ways)).cast("int")
    slots = F.explode(F.sequence(F.lit(0), F.lit(ways - 1)))
    joined = rows.withColumn("_slot", slot).join(dim.withColumn("_slot", slots), [on, "_slot"], how)
    return joined.drop("_slot")


def full_outer(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Full outer join as left outer plus the unmatched right rows.

    A hot key can be split at run time in the left outer and the anti join, but not in a full outer
    join. A null key matches nothing and is kept on either side.
    """
    both = left.join(right, on, "left")
    right_only = right.join(left.select(*on), on, "left_anti")
    return both.unionByName(right_only, allowMissingColumns=True)


def with_group_max(rows: DataFrame, by: str, value: str, name: str) -> DataFrame:
    """Each row with its group's maximum; the maximum is combined before the shuffle."""
    largest = rows.groupBy(by).agg(F.max(value).alias(name))
    return spread_lookup(rows, largest, by)


def subtract(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Left rows whose `on` is absent on the right; left duplicates stay."""
    return left.join(right.select(on), on, "left_anti")


def split_random(rows: DataFrame, key: str, test_share: float = 0.20) -> DataFrame:
    """Add `part` = 'testing' | 'training', drawn from a hash of the key."""
    return rows.withColumn("part", F.when(hash_unit(key) <= test_share, "testing").otherwise("training"))


def sample_per_model(rows: DataFrame, key: str, n_models: int, ratio: float) -> DataFrame:
    """Emit each row to every model independently with probability `ratio`; adds `model_id` 1..n."""
    models = F.sequence(F.lit(1), F.lit(n_models))
    chosen = F.filter(models, lambda m: hash_unit_for(key, m) < ratio)
    return rows.withColumn("model_id", F.explode(chosen))


def contiguous_folds(rows: DataFrame, key: str, k: int = 5) -> DataFrame:
    """Add `fold` 0..k-1: k contiguous blocks in key order, the first n % k of them one row longer."""
    indexed = dense_index(rows, [key], "_i")
    n = indexed.agg(F.count("*")).scalar()
    sized = indexed.withColumn("_base", F.floor(n / k)).withColumn("_long", n % k)
    in_long = F.col("_long") * (F.col("_base") + 1)
    fold = F.when(F.col("_i") < in_long, F.floor(F.col("_i") / (F.col("_base") + 1))).otherwise(
        F.col("_long") + F.floor((F.col("_i") - in_long) / F.col("_base"))
    )
    return sized.withColumn("fold", fold.cast("int")).drop("_i", "_base", "_long")


def shuffle_splits(rows: DataFrame, key: str, n_splits: int = 5, test_share: float = 0.2) -> DataFrame:
    """Every row once per iteration 1..n, with `is_test` drawn anew each time."""
    repeated = rows.withColumn("iteration", F.explode(F.sequence(F.lit(1), F.lit(n_splits))))
    return repeated.withColumn("is_test", (hash_unit_for(key, "iteration") < test_share).cast("int"))


def split_by_ids(rows: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Rows whose key is in the id table, with repeated ids counted once."""
    return rows.join(ids.select(on), on, "left_semi")


def one_hot(rows: DataFrame, key: str, column: str, categories: list[str], sep: str = ",") -> DataFrame:
    """(key, one 0/1 column per category) from a `sep`-separated string column."""
    parts = F.split(F.coalesce(F.col(column), F.lit("")), sep)
    flags: list[Column] = [F.array_contains(parts, c).cast("int").alias(c) for c in categories]
    return rows.select(key, *flags)


def one_hot_long(rows: DataFrame, key: str, column: str, sep: str = ",") -> DataFrame:
    """(key, category) pairs, for category sets too wide to be columns."""
    return rows.select(key, F.explode(F.array_distinct(F.split(column, sep))).alias("category")).filter(
        F.col("category") != ""
    )
