"""Query catalog: key -> Spark job on the test tables, and key -> the same
statement in DuckDB SQL (the correctness oracle)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.readers import Tables

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a job under ``name``; ``sql`` is its oracle statement (omit
    it for jobs without a SQL form)."""

    def deco(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from ..session import configure

            configure(spark)
            return fn(Tables(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco
