"""Small helpers shared by the text operators: Arrow strings inside tasks, free column names, row keys."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.session import cut

#: `[^\x20\x09-\x0D]+`, the words of most contracts, for Spark's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"


def utf8(column: pa.Array) -> list[bytes | None]:
    """The values as UTF-8 bytes, None for null."""
    return column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()


def strings(column: pa.Array) -> list[str]:
    """The values as text: null is empty, bytes that are not UTF-8 become U+FFFD."""
    return [b.decode("utf-8", "replace") if b else "" for b in utf8(column)]


def pieces(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most `most` in size together; a larger row is a range of its own."""
    at, total = 0, 0
    for i, n in enumerate(sizes):
        if i > at and total + n > most:
            yield at, i
            at, total = i, 0
        total += n
    if at < len(sizes):
        yield at, len(sizes)


def decoded(column: pa.Array, most: int) -> Iterator[list[str]]:
    """The texts of a column, in lists of about `most` bytes together."""
    sizes = [n or 0 for n in pc.binary_length(column).to_pylist()]
    for a, b in pieces(sizes, most):
        yield strings(column.slice(a, b - a))


def free(df: DataFrame, name: str) -> str:
    """`name`, or that with underscores before it until `df` has no such column in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """`docs` written once with a number for each row, and the name of that column.

    Ids may repeat or be null; the number may not. It is stored, so a retried task meets the same one.
    """
    key = free(docs, "row")
    return cut(docs.withColumn(key, F.monotonically_increasing_id())), key


def words(text: str | Column) -> Column:
    """array<string>: the words of the contracts, natively; null has none."""
    return F.filter(F.split(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


@contextlib.contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for a block, dots written as two underscores; what was set before comes back."""
    keys = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
