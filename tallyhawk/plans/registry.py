"""Query registry: key -> Spark builder, key -> DuckDB oracle SQL."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession


QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a builder ``fn(spark, sf_dir)`` under ``name`` with its oracle."""

    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # no session settings are changed: every timestamp is
            # timestamp_ntz and handled as wall-clock time
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return deco
