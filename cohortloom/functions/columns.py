"""Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_unit(key: ColumnLike) -> Column:
    """Uniform number in [0, 1) that depends on the key only, so every run draws the same sample."""
    digest = F.substring(F.md5(_col(key).cast("string")), 1, 8)
    return F.conv(digest, 16, 10).cast("bigint") / F.lit(4294967296.0)


def hash_unit_for(key: ColumnLike, tag: ColumnLike) -> Column:
    """As `hash_unit`, drawn independently for every tag (model number, iteration)."""
    return hash_unit(F.concat(_col(key).cast("string"), F.lit("-"), _col(tag).cast("string")))


def number_or_null(c: ColumnLike) -> Column:
    """String to double; blank, non-numeric and NaN all become NULL."""
    x = _col(c).try_cast("double")
    return F.when(~F.isnan(x), x)


def present(c: ColumnLike) -> Column:
    """True for a value that is neither NULL nor the empty string."""
    return _col(c).isNotNull() & (_col(c) != "")


def fill(c: ColumnLike, sentinel: float) -> Column:
    """NULL and NaN replaced by `sentinel`."""
    return F.coalesce(F.nanvl(_col(c), F.lit(None).cast("double")), F.lit(float(sentinel)))


def code_class(event_id: ColumnLike) -> Column:
    """Leading letters of an event code."""
    return F.regexp_extract(_col(event_id), "([a-zA-Z]+)", 1)


def is_abnormal(test: ColumnLike, value: ColumnLike, rules: list[tuple[str, str, float]]) -> Column:
    """Threshold rules per lower-cased test name as one CASE expression."""
    name, x = F.lower(_col(test)), _col(value)
    out = None
    for rule_test, op, limit in rules:
        hit = x >= limit if op == ">=" else x > limit
        branch = name == rule_test
        out = F.when(branch, hit) if out is None else out.when(branch, hit)
    return F.coalesce(out.otherwise(F.lit(False)), F.lit(False))


def sparse_text(pairs: ColumnLike, digits: int = 6) -> Column:
    """array<struct<idx,value>> to `idx:value idx:value`, in array order."""
    fmt = f"%d:%.{digits}f"
    return F.array_join(F.transform(_col(pairs), lambda p: F.format_string(fmt, p["idx"], p["value"])), " ")


def argmax_index(values: ColumnLike) -> Column:
    """Zero-based position of the largest array element; the first one on ties."""
    return (F.array_position(_col(values), F.array_max(_col(values))) - 1).cast("int")


def sigmoid(z: ColumnLike) -> Column:
    return 1.0 / (1.0 + F.exp(-_col(z)))


def file_folder(level: int = 1) -> Column:
    """Name of the folder `level` steps above the file a row came from, without a `key=` prefix."""
    parts = F.split(F.col("_metadata.file_path"), "/")
    return F.regexp_extract(F.element_at(parts, -1 - level), "([^=]+)$", 1)


def table_name(path: ColumnLike) -> Column:
    """Table name for a file path: its last word without `.csv`, or the path where none is found."""
    found = F.regexp_extract(_col(path), r"(\w+)(\.csv)?$", 1)
    return F.when(found != "", found).otherwise(_col(path))
