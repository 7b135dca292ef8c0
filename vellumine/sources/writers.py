"""Sinks: NDJSON, CSV, JSON reports and Markdown tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_ndjson(df: DataFrame, path: str) -> None:
    """One object per line, fields in the order of their names; nulls are left out."""
    df.select(*sorted(df.columns)).write.mode("overwrite").option("ignoreNullFields", "true").json(path)


def write_csv(df: DataFrame, path: str, *order: str) -> None:
    """Sorted CSV with a header; the parts, one after another, are in order."""
    df.orderBy(*order).write.mode("overwrite").option("header", "true").csv(path)


def write_partitioned(df: DataFrame, path: str, *by: str) -> None:
    """Parquet in folders by column, rows of a folder brought together first so that files stay few."""
    df.repartition(*by).write.mode("overwrite").partitionBy(*by).parquet(path)


def markdown_table(df: DataFrame, most: int = 100) -> str:
    """A small result as a Markdown table; says so if it was cut at `most` rows."""
    rows = df.limit(most + 1).collect()
    head = "| " + " | ".join(df.columns) + " |\n|" + " --- |" * len(df.columns)
    body = "\n".join("| " + " | ".join("" if v is None else str(v).replace("|", "\\|").replace("\n", " ") for v in r) + " |" for r in rows[:most])
    return head + ("\n" + body if body else "") + ("\n\n(further rows left out)" if len(rows) > most else "")


def json_report(df: DataFrame) -> str:
    """The one row of an aggregate as JSON."""
    row = df.limit(1).select(F.to_json(F.struct(*df.columns)).alias("j")).first()
    return row[0] if row else "{}"
