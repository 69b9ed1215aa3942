"""Name -> (Spark query, oracle SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortloom.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; `sql` is the DuckDB text it must agree with, where one exists."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
