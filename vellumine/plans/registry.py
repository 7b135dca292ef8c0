"""Where queries of the core and their SQL are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vellumine.session import ensure_shipped, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function of t, which gives the tables by name."""

    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_shipped(spark)
            return f(lambda t: table(spark, sf_dir, t))

        assert name not in QUERIES, name
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return f

    return register
