"""A paged record service as a Spark data source: each space is a partition, pages are followed by their 'next' links.

The transport is a function from a URL to a JSON text; offline it reads files of a folder, as in the tests.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Iterator
from urllib.parse import quote, urlparse

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, InputPartition

SCHEMA = "id string, title string, space_id string, updated_at string, version int, url string, body_storage string, body_adf string, raw string"


def fetch_file(folder: str, url: str) -> str:
    """The stored answer to a URL: its path and query, with / and other signs escaped, as a file name."""
    with open(os.path.join(folder, quote(url, safe="") + ".json")) as f:
        return f.read()


def fetch_http(base: str, url: str, tries: int = 5) -> str:
    """The answer of a live service; tries again with doubling pauses."""
    import urllib.request

    for n in range(tries):
        try:
            with urllib.request.urlopen(base.rstrip("/") + url, timeout=30) as r:
                return r.read().decode()
        except OSError:
            if n + 1 == tries:
                raise
            time.sleep(2**n)
    raise AssertionError


def follow(get, url: str) -> Iterator[dict]:
    """All results from a URL on; a next link may be absolute or relative, and an answer may name itself as next."""
    seen: set[str] = set()
    while url and url not in seen:
        seen.add(url)
        page = json.loads(get(url))
        yield from page.get("results") or []
        after = (page.get("_links") or {}).get("next") or ""
        parts = urlparse(after)
        url = (parts.path + (f"?{parts.query}" if parts.query else "")) if after else ""


class _Space(InputPartition):
    def __init__(self, space: str):
        super().__init__(space)
        self.space = space


class PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options
        self.spaces = [s for s in options.get("spaces", "").split(",") if s]
        self.since: str | None = options.get("since")

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """space_id = x picks partitions; updated_at > t is asked of the service and checked again by Spark."""
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("space_id",):
                self.spaces = [s for s in self.spaces if s == f.value]
            else:
                if isinstance(f, GreaterThan) and f.attribute == ("updated_at",):
                    self.since = max(self.since or "", f.value)
                yield f

    def partitions(self) -> list[InputPartition]:
        return [_Space(s) for s in self.spaces]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        folder, base = self.options.get("folder"), self.options.get("base")
        get = (lambda u: fetch_file(folder, u)) if folder else (lambda u: fetch_http(base, u))
        for p in follow(get, f"/pages?space-id={partition.space}&limit={self.options.get('limit', '100')}"):
            v = p.get("version") or {}
            at = v.get("createdAt") or p.get("updatedAt")
            if self.since and (at or "") <= self.since:
                continue
            body = p.get("body") or {}
            yield (
                str(p.get("id")), p.get("title"), str(p.get("spaceId") or partition.space), at, v.get("number"), (p.get("_links") or {}).get("webui"),
                (body.get("storage") or {}).get("value"), _text((body.get("atlas_doc_format") or {}).get("value")), json.dumps(p, sort_keys=True),
            )


def _text(x: object) -> str | None:
    return x if x is None or isinstance(x, str) else json.dumps(x)


class PagedSource(DataSource):
    """spark.read.format("paged").option("folder", ...).option("spaces", "A,B").load()"""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedSource)
