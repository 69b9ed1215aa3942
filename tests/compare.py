"""Comparison of a Spark result with the oracle's, as multisets of rows."""

from __future__ import annotations

import glob
import math
import os
import tempfile
from datetime import date, datetime
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession


def local_session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .appName("cohortloom")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute(f"SET temp_directory = '{tempfile.mkdtemp(prefix='oracle-')}'")
    con.execute("SET max_temp_directory_size = '5GB'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, float(v))
    if isinstance(v, (int, float, Decimal)):
        x = float(v)
        return (0, "nan") if math.isnan(x) else (1, float(f"{x:.9g}") + 0.0)
    if isinstance(v, datetime):
        v = v.date() if (v.hour, v.minute, v.second) == (0, 0, 0) else v
    if isinstance(v, date):
        return (2, v.isoformat())
    if isinstance(v, (list, tuple)):
        return (4, str([_cell(x) for x in v]))
    return (3, str(v))


def normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(columns, rows, con, sql) -> str | None:
    cur = con.execute(sql)
    want_cols = [c[0] for c in cur.description]
    want = cur.fetchall()
    if sorted(columns) != sorted(want_cols):
        return f"columns {sorted(columns)} against {sorted(want_cols)}"
    a, b = normal(columns, rows), normal(want_cols, want)
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}; first got {a[:1]} want {b[:1]}"
    for x, y in zip(a, b):
        if x != y:
            return f"first difference: got {x} want {y}"
    return None
