"""The catalogue of the core's queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vellumine.plans import ingest_queries, lifecycle_queries, pipeline_queries, reference_queries, retrieval_queries, statistics_queries, text_queries  # noqa: F401
from vellumine.plans.registry import QUERIES, SQL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
