"""Matrix operations on (row, col, value) frames.

A factor with k columns is one row per index with columns w0..w{k-1}: k is a small model parameter,
so sums over it are plain column expressions that combine on the map side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.relational import spread_lookup

GUARD = 2e-15


def factor_columns(k: int) -> list[str]:
    return [f"w{i}" for i in range(k)]


def start_factor(keys: DataFrame, key: str, k: int) -> DataFrame:
    """Positive starting values from a formula of (key, component): the same on every run."""
    cols = [(((F.col(key) * 7 + i * 13) % 17 + 1) / F.lit(17.0)).alias(f"w{i}") for i in range(k)]
    return keys.select(key, *cols)


def times_small(entries: DataFrame, small: DataFrame) -> DataFrame:
    """(row, j, value): entries (row, col, value) times a small matrix (col, j, b)."""
    return (
        entries.join(small, "col").groupBy("row", "j").agg(F.sum(F.col("value") * F.col("b")).alias("value"))
    )


def gram(left: DataFrame, right: DataFrame) -> DataFrame:
    """(i, j, value): transpose(left) times right, both as (row, col, value), combined over rows."""
    a = left.select("row", F.col("col").alias("i"), F.col("value").alias("a"))
    b = right.select("row", F.col("col").alias("j"), F.col("value").alias("b"))
    return a.join(b, "row").groupBy("i", "j").agg(F.sum(F.col("a") * F.col("b")).alias("value"))


def elementwise(left: DataFrame, right: DataFrame, op: str) -> DataFrame:
    """(row, col, value): product, or division with a guard against a zero divisor."""
    both = left.withColumnRenamed("value", "a").join(right.withColumnRenamed("value", "b"), ["row", "col"])
    if op == "product":
        value = F.col("a") * F.col("b")
    elif op == "quotient":
        value = F.col("a") / (F.col("b") + GUARD)
    else:
        raise ValueError(f"unknown op {op!r}")
    return both.select("row", "col", value.alias("value"))


def factor_gram(factor: DataFrame, k: int) -> list[list[float]]:
    """transpose(F) F as k x k numbers on the driver: one aggregate row, whatever the factor's length."""
    names = factor_columns(k)
    sums = [F.sum(F.col(a) * F.col(b)) for a in names for b in names]
    flat = factor.agg(*sums).first()
    return [[flat[i * k + j] for j in range(k)] for i in range(k)]


def project(entries: DataFrame, factor: DataFrame, on: str, to: str, k: int) -> DataFrame:
    """(to, n0..n{k-1}): sum over `on` of value times the factor's row."""
    joined = entries.join(factor, on)
    sums = [F.sum(F.col("value") * F.col(c)).alias(f"n{i}") for i, c in enumerate(factor_columns(k))]
    return joined.groupBy(to).agg(*sums)


def standard_scale(entries: DataFrame, sample: bool = True) -> DataFrame:
    """(row, col, value): (x - mean) / standard deviation per column; a constant column becomes 0."""
    spread = F.stddev_samp("value") if sample else F.stddev_pop("value")
    stats = entries.groupBy("col").agg(F.avg("value").alias("mean"), spread.alias("sd"))
    scaled = F.when(F.col("sd") > 0, (F.col("value") - F.col("mean")) / F.col("sd")).otherwise(0.0)
    return spread_lookup(entries, stats, "col").select("row", "col", scaled.alias("value"))
